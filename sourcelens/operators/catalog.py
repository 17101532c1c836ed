"""Topic catalog and request planning."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcelens.functions.urls import strip_ws
from sourcelens.operators.brand_index import catalog_mentions
from sourcelens.operators.dedupe import keep_first, last_by_key
from sourcelens.schemas import TOPIC, landing_order


def topics_frame(spark: SparkSession, topics: list[dict]) -> DataFrame:
    """A catalog given as configuration (list of {id, intent, query}); ``seq`` = list order."""
    rows = [(t.get("id", ""), t.get("intent", ""), t.get("query"), i) for i, t in enumerate(topics)]
    return spark.createDataFrame(rows, "id string, intent string, query string, seq bigint")


def read_topics(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """A JSON array (or JSON lines) of topics; topics without a query are dropped.
    ``seq`` is the landing order (file time, path, place in the file), for last-wins lookups."""
    df = spark.read.schema(TOPIC).option("multiLine", str(multiline).lower()).json(path)
    return df.withColumn("seq", landing_order()).where(F.col("query").isNotNull() & (F.col("query") != ""))


def tag_topics(df: DataFrame, topics: DataFrame, query: str = "query", broadcast: bool = False) -> DataFrame:
    """Query text -> (intent, topic_id); unmatched -> ('unknown', '').  A repeated query
    in the catalog resolves to its last entry.  Pass ``broadcast=True`` only for a catalog
    built from configuration (``topics_frame``: its size is the config list); otherwise the
    planner decides from the catalog's size statistics (and AQE at run time)."""
    cat = last_by_key(topics.where(F.col("query").isNotNull()), "query", "seq") \
        .select(F.col("query").alias("_tq"), F.col("intent").alias("_ti"), F.col("id").alias("_tid"))
    cat = F.broadcast(cat) if broadcast else cat
    j = df.join(cat, df[query] == cat["_tq"], "left")
    return (j.withColumn("intent", F.coalesce(F.col("_ti"), F.lit("unknown")))
             .withColumn("topic_id", F.coalesce(F.col("_tid"), F.lit("")))
             .drop("_tq", "_ti", "_tid"))


def request_manifest(prompts: DataFrame, surfaces: list[str], num_runs: int) -> DataFrame:
    """Surface x run 1..N x prompt, as two explodes of configuration arrays (no join)."""
    if num_runs < 1:
        raise ValueError("num_runs must be >= 1")
    if not surfaces:
        raise ValueError("no surfaces selected")
    return (prompts.withColumn("surface", F.explode(F.array(*[F.lit(s) for s in surfaces])))
                   .withColumn("run", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(num_runs).cast("bigint")))))


def _tokens(tokens: list[str] | None) -> list[tuple[int, str]] | None:
    """(place, token) of a typed selector list; None selects everything (no list, blanks only, ``all`` or ``*`` alone)."""
    kept = [(i, t.strip()) for i, t in enumerate(tokens or []) if t is not None and t.strip()]
    return None if not kept or len(kept) == 1 and kept[0][1].lower() in ("all", "*") else kept


def _matches(tokens: list[tuple[int, str]], label: str, pos: str) -> Column:
    """Places of the tokens that select a row, as an array.  The typed list is one literal, whatever its length: digits
    are a position, any other token is a part of the label."""
    numbers = [{"o": i, "n": int(t)} for i, t in tokens if re.fullmatch("[0-9]+", t) and int(t) < 2**63]
    names = [{"o": i, "t": t.lower()} for i, t in tokens if not re.fullmatch("[0-9]+", t)]
    by_number = F.filter(F.from_json(F.lit(json.dumps(numbers)), "array<struct<o:bigint,n:bigint>>"), lambda x: x["n"] == F.col(pos))
    by_name = F.filter(F.from_json(F.lit(json.dumps(names)), "array<struct<o:bigint,t:string>>"),
                       lambda x: F.lower(F.col(label)).contains(x["t"]))
    return F.concat(F.transform(by_number, lambda x: x["o"]), F.transform(by_name, lambda x: x["o"]))


def select_catalog(catalog: DataFrame, tokens: list[str] | None, label: str = "label", pos: str = "pos") -> DataFrame:
    """Keep catalog rows chosen by the typed ``tokens``.

    A token of ASCII digits is a 1-based catalog position; any other token selects every row whose label contains
    it (case-insensitive).  No tokens, or ``all``/``*`` as the only one, select everything.  Result order key:
    (``sel_ord``, ``pos``); each label is kept once, at its first selection.  Planning runs no job, and the catalog
    streams through without a join; ``unmatched_selectors`` tells what selected nothing."""
    kept = _tokens(tokens)
    if kept is None:
        return catalog.withColumn("sel_ord", F.lit(0).cast("bigint"))
    matched = catalog.withColumn("sel_ord", F.array_min(_matches(kept, label, pos))).where(F.col("sel_ord").isNotNull())
    return keep_first(matched, label, ["sel_ord", pos])


def unmatched_selectors(catalog: DataFrame, tokens: list[str] | None, label: str = "label", pos: str = "pos") -> DataFrame:
    """(ord, token) of the typed tokens that select no catalog row."""
    kept = _tokens(tokens) or []
    typed = catalog.sparkSession.createDataFrame(kept, "ord bigint, token string")
    hit = catalog.select(F.explode(_matches(kept, label, pos)).alias("ord")).distinct() if kept else typed.select("ord").limit(0)
    return typed.join(hit, "ord", "left_anti")


def _typed(selectors: DataFrame) -> DataFrame:
    """(ord, token, number) of the selectors that aren't blank; ``number`` is the position that ASCII digits name."""
    t = strip_ws(F.col("token"))
    digits = F.col("token").rlike("^[0-9]+$")
    return (selectors.where("token IS NOT NULL").select("ord", t.alias("token")).where(F.col("token") != "")
            .select("ord", "token", digits.alias("digits"), F.when(digits, F.expr("try_cast(token AS BIGINT)")).alias("number")))


def _named(catalog: DataFrame, typed: DataFrame, label: str) -> DataFrame:
    """(label, token, ord): every different label and lower-cased token that is a part of it; ``ord`` is the token's first."""
    names = typed.where("NOT digits").groupBy(F.lower("token").alias("brand")).agg(F.min("ord").alias("brand_pos"))
    found = catalog_mentions(catalog.select(F.col(label).alias("_label")).distinct(), names, "_label", "_label")
    return found.select("_label", F.col("brand").alias("_token"), F.col("brand_pos").alias("ord"))


def _by_number(catalog: DataFrame, typed: DataFrame, pos: str) -> DataFrame:
    """(pos, ord): catalog rows that a selector names by position."""
    numbers = typed.where("number IS NOT NULL").select("ord", F.col("number").alias("_n"))
    return catalog.select(pos).join(numbers, F.col(pos) == F.col("_n")).select(pos, "ord")


def select_by_table(catalog: DataFrame, selectors: DataFrame, label: str = "label", pos: str = "pos") -> DataFrame:
    """J12 for a table of selectors (ord, token), of any length, over a catalog of any length: the same rows as ``select_catalog`` gives for a list.

    No label is compared with every selector: different tokens are looked up in different labels (see ``brand_index``), and only a label's first
    selector comes back to its rows.  A position names one catalog row.  Planning looks at two selectors, to tell ``all`` alone, and at the index's size."""
    typed = _typed(selectors)
    first = typed.limit(2).collect()
    if not first or len(first) == 1 and first[0].token.lower() in ("all", "*"):
        return catalog.withColumn("sel_ord", F.lit(0).cast("bigint"))
    labels = _named(catalog, typed, label).groupBy("_label").agg(F.min("ord").alias("ord"))
    by_name = catalog.join(labels, F.col(label) == F.col("_label")).select(pos, "ord")
    chosen = (_by_number(catalog, typed, pos).unionByName(by_name)
              .groupBy(F.col(pos).alias("_pos")).agg(F.min("ord").cast("bigint").alias("sel_ord")))
    matched = catalog.join(chosen, F.col(pos) == F.col("_pos")).drop("_pos")
    return keep_first(matched, label, ["sel_ord", pos])


def unmatched_by_table(catalog: DataFrame, selectors: DataFrame, label: str = "label", pos: str = "pos") -> DataFrame:
    """(ord, token) of the selectors of a table that select no catalog row."""
    typed = _typed(selectors)
    tokens = _named(catalog, typed, label).select("_token").distinct()
    by_name = typed.where("NOT digits").join(tokens, F.lower("token") == F.col("_token"), "left_semi").select("ord")
    hit = _by_number(catalog, typed, pos).select("ord").unionByName(by_name).distinct()
    return typed.select("ord", "token").join(hit, "ord", "left_anti")


def require_matched(catalog: DataFrame, tokens: list[str] | None, label: str = "label", pos: str = "pos") -> None:
    """Raise ``ValueError`` if a typed token selects nothing."""
    bad = [r.token for r in unmatched_selectors(catalog, tokens, label, pos).orderBy("ord").collect()]  # at most the typed list
    if bad:
        raise ValueError(f"no match for selection: {bad}")


def add_adhoc(selected: DataFrame, extra: DataFrame, prompt: str = "prompt") -> DataFrame:
    """Ad-hoc prompt rows (text, intent, ord): blank text dropped, intent defaults to
    ``adhoc``, first of equal texts kept, prompts already selected removed."""
    e = (extra.select(strip_ws(F.col("text")).alias("prompt"),
                      F.coalesce(strip_ws(F.col("intent")), F.lit("")).alias("intent"), "ord")
              .where(F.col("prompt") != ""))
    e = keep_first(e, "prompt", ["ord"])
    e = e.withColumn("intent", F.when(F.col("intent") == "", F.lit("adhoc")).otherwise(F.col("intent")))
    sel = selected.select(F.col(prompt).alias("prompt")).distinct()
    return e.join(sel, "prompt", "left_anti").withColumn("topic_id", F.lit(""))
