"""Reports (A4, A5, R1-R5) and the price table (F6 long form).

All roll-ups are ``groupBy`` aggregations with map-side partial aggregation, so a hot key
(one host cited by a third of all answers) is pre-aggregated per task before the shuffle.
Totals used for shares are scalar subqueries (computed once, broadcast as a value), not
single-partition windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sourcelens.functions.text import spark_price_regex
from sourcelens.functions.urls import host_of
from sourcelens.operators.dedupe import keep_first
from sourcelens.rules import BrandRules


def nonprod_report(df: DataFrame, url: str = "url", flag: str = "nonprod_url", top: int | None = None) -> DataFrame:
    """A4: the distinct non-production URLs, each once.  With ``top``, the first ones: in sheet order when the frame
    carries ``first_seen`` (the web sheet), else in string order; that plans as a distributed top-k."""
    hits = df.where(F.col(flag))
    if top is None:
        return hits.select(F.col(url).alias("url")).distinct()
    if "first_seen" in df.columns:
        first = hits.groupBy(F.col(url).alias("url")).agg(F.min("first_seen").alias("_o"))
        return first.orderBy("_o", "url").limit(top).select("url")
    return hits.select(F.col(url).alias("url")).distinct().orderBy("url").limit(top)


def nonprod_cited(answers: DataFrame, rules: BrandRules, sources: str = "sources_cited", top: int | None = None) -> DataFrame:
    """A4 for the answer sheet: cited sources (an array) that are non-production URLs."""
    from sourcelens.functions.urls import is_nonprod_url
    s = answers.select(F.explode(sources).alias("url"))
    return nonprod_report(s.withColumn("nonprod_url", is_nonprod_url(F.col("url"), rules)), top=top)


# The sources that this library reads; anything else is counted as other.
SOURCES = ("web", "ai_overview", "chatgpt_search", "perplexity_search", "news", "ads", "reddit")


def _counter_exprs(cols: list[str], distinct: bool = True) -> list:
    exprs = [F.count(F.lit(1)).alias("rows")]
    if "source" in cols:
        for s in SOURCES:
            exprs.append(F.count_if(F.col("source") == s).alias(f"source_{s}"))
        exprs.append(F.count_if(~F.coalesce(F.col("source").isin(*SOURCES), F.lit(False))).alias("source_other"))
    if "url" in cols and distinct:  # observed metrics allow no distinct aggregates
        exprs.append(F.count_distinct(F.col("url")).alias("unique_urls"))
    if "status" in cols:
        for s in ("ok", "empty", "error"):
            exprs.append(F.count_if(F.col("status") == s).alias(f"status_{s}"))
    if "nonprod_url" in cols:
        exprs.append(F.count_if(F.col("nonprod_url")).alias("nonprod"))
    if "verdict_source" in cols:
        exprs.append(F.count_if(F.col("verdict_source") == "fallback").alias("fallback_verdicts"))
    if "fetch_status" in cols:
        for s in ("cache", "crawl", "missing"):
            exprs.append(F.count_if(F.col("fetch_status") == s).alias(f"fetch_{s}"))
    return exprs


def run_metrics(df: DataFrame, name: str = "run") -> tuple[DataFrame, Observation]:
    """A5: counters gathered while the sink runs (no second pass): rows, unique URLs are the
    rows of a deduped frame, records per source/status, non-production rows."""
    obs = Observation(name)
    exprs = _counter_exprs(df.columns, distinct=False)
    return df.observe(obs, *exprs), obs


def run_counters(df: DataFrame) -> DataFrame:
    """A5 as a one-row table (the same counters ``run_metrics`` observes during a write)."""
    return df.agg(*_counter_exprs(df.columns))


def price_table(df: DataFrame, rules: BrandRules, key: str, text: str = "text", top: int | None = None) -> DataFrame:
    """F6 long form: per ``key``, the distinct price strings with their place in string order (the first ``top`` if given).
    Distinct (key, price) is a partial aggregate; the per-key top-k is a WindowGroupLimit."""
    prices = (df.select(key, F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")),
                                                            F.lit(spark_price_regex(rules.price_pattern)), 0))
                        .alias("price"))
                .distinct())
    w = Window.partitionBy(key).orderBy("price")
    ranked = prices.withColumn("price_rank", F.row_number().over(w))
    return ((ranked if top is None else ranked.where(F.col("price_rank") <= top))
                  .withColumn("price_rank", F.col("price_rank").cast("bigint")))


def visibility_rollup(answers: DataFrame) -> DataFrame:
    """Per (surface, prompt): runs, ok runs, mentions, recommendations, old-product runs
    and the mention rate over ok runs."""
    ok = F.col("status") == "ok"
    g = answers.groupBy("surface", "prompt").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(ok).alias("ok_runs"),
        F.count_if(ok & F.col("mentioned")).alias("mentioned_runs"),
        F.count_if(ok & F.col("recommended")).alias("recommended_runs"),
        F.count_if(ok & F.coalesce(F.col("stale"), F.lit(False))).alias("stale_runs"))
    return g.withColumn("mention_rate", F.when(F.col("ok_runs") > 0,
                                               F.round(F.col("mentioned_runs") / F.col("ok_runs"), 4)))


def ownership_rollup(web: DataFrame) -> DataFrame:
    """R2: portrayal by ownership class, with an intent breakdown (ROLLUP(ownership, intent))."""
    return web.rollup("ownership", "intent").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("mentions_competition")).alias("competition_rows"),
        F.count_if(F.col("nonprod_url")).alias("nonprod_rows"),
        F.count_if(F.col("price").isNotNull()).alias("priced_rows"),
        F.count_if(F.col("verdict_source") == "model").alias("model_rows"))


def citation_rollup(answers: DataFrame, sources: str = "sources_cited") -> DataFrame:
    """Citations per host and their share of all citations (ok rows).  The answers are aggregated once; the
    total is a sum over that small aggregate, whose exchange Spark reuses."""
    per = (answers.where(F.col("status") == "ok").select(F.explode(sources).alias("src"))
                  .groupBy(host_of(F.col("src")).alias("host")).agg(F.count(F.lit(1)).alias("citations")))
    total = per.select(F.sum("citations")).scalar()
    return per.withColumn("share", F.round(F.col("citations") / total, 4))


def competitor_share(answers: DataFrame, names: str = "competitors_named") -> DataFrame:
    """Per surface and competitor brand, the ok answers naming it and their share of all ok answers on that
    surface.  One aggregate counts both: every answer also counts under the null brand, which is the surface's total."""
    brands = F.array_union(F.filter(F.col(names), lambda b: b.isNotNull() & (b != "")), F.array(F.lit(None).cast("string")))
    counts = (answers.where(F.col("status") == "ok").select("surface", F.explode(brands).alias("brand"))
                     .groupBy("surface", "brand").agg(F.count(F.lit(1)).alias("answers")))
    totals = counts.where(F.col("brand").isNull()).select("surface", F.col("answers").alias("ok_answers"))
    return (counts.where(F.col("brand").isNotNull()).join(totals, "surface")
                  .withColumn("share", F.round(F.col("answers") / F.col("ok_answers"), 4)))


# of null in the row hash; any number that xxhash64 is unlikely to give
_NULL_HASH = -0x61C8864680B583EB
# column hashes are summed in two halves of 31 bits, so that no sum of fewer than 2^32 rows overflows
_HALF = 0x7FFFFFFF


def _value_hash(name: str, kind: T.DataType, seed: int) -> Column:
    """64-bit hash of one value.  Null counts as a value of its own; 0.0 equals -0.0; nested values are hashed as JSON, where nulls
    keep their place."""
    c = F.col(name)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        v = F.to_json(F.struct(c), {"ignoreNullFields": "false"})
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        v = c + F.lit(0.0)
    else:
        v = c
    return F.when(c.isNull(), F.lit(_NULL_HASH)).otherwise(F.xxhash64(F.lit(seed), v))


def snapshot_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Compare two snapshots on ``keys`` as multisets of rows.  One row for each key of either side (null keys equal each other):

    ``change``: ``added`` (no row in ``a``), ``removed`` (no row in ``b``), ``same`` (equal rows, equally often) or ``changed``;
    ``changed_columns``: for a changed key, the columns whose values differ as multisets, in the order of ``a``, comma-joined; it is empty where the same
    values of all columns are only combined differently;
    ``rows_before``, ``rows_after``, ``rows_same``: rows of the key in ``a``, in ``b``, and those that pair off.

    Both sides are stacked and cut down to hashes of the row (128 bits) and of each column before anything moves.  Signed counts per (key, row hash)
    are a partial aggregate, so a key that holds a third of all rows leaves each task as its distinct rows; the second aggregate has one row for each key
    and task.  Nothing is joined, so repeated keys make no product."""
    kinds = {f.name: f.dataType for f in a.schema.fields}
    cols = [c for c in a.columns if c not in keys and c in b.columns]
    hashed = [_value_hash(c, kinds[c], i) for i, c in enumerate(cols)]

    def side(df: DataFrame, in_a: int) -> DataFrame:
        h = df.select(*keys, F.lit(in_a).alias("_a"), F.lit(1 - in_a).alias("_b"), *[x.alias(f"_h{i}") for i, x in enumerate(hashed)])
        both = [F.xxhash64(F.lit(seed), *[f"_h{i}" for i in range(len(cols))]).alias(f"_row{seed}") for seed in (1, 2)]
        return h.select("*", *both)

    rows = side(a, 1).unionByName(side(b, 0))
    per_row = rows.groupBy(*keys, "_row1", "_row2").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"), *[F.first(f"_h{i}").alias(f"_h{i}") for i in range(len(cols))])
    more = F.col("_b") - F.col("_a")
    halves = [(i, k, F.shiftrightunsigned(f"_h{i}", 33 * k).bitwiseAND(F.lit(_HALF))) for i in range(len(cols)) for k in (0, 1)]
    per_key = per_row.groupBy(*keys).agg(
        F.sum("_a").alias("rows_before"), F.sum("_b").alias("rows_after"), F.sum(F.least("_a", "_b")).alias("rows_same"),
        *[F.sum(more * h).alias(f"_s{i}_{k}") for i, k, h in halves])
    before, after = F.col("rows_before"), F.col("rows_after")
    change = (F.when(before == 0, F.lit("added")).when(after == 0, F.lit("removed"))
               .when((F.col("rows_same") == before) & (before == after), F.lit("same")).otherwise(F.lit("changed")))
    names = F.array_compact(F.array(*[F.when((F.col(f"_s{i}_0") != 0) | (F.col(f"_s{i}_1") != 0), F.lit(c)) for i, c in enumerate(cols)])) \
        if cols else F.array().cast("array<string>")
    return per_key.select(*keys, change.alias("change"), F.when(change == "changed", F.array_join(names, ",")).otherwise(F.lit("")).alias("changed_columns"),
                          "rows_before", "rows_after", "rows_same")


def _one_gold(gold: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A gold row for each key; one of several is that of the greatest values, so that a re-run picks the same."""
    return keep_first(gold.select(key, *fields), key, [F.to_json(F.struct(*fields)).desc()])


def score_against_gold(pred: DataFrame, gold: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Per boolean field, the confusion counts of predictions against a labelled set (inner join on ``key``, where a key labelled twice counts once;
    one aggregation pass for all fields).  A null on either side is no vote: it counts neither as true nor as false (see ``gold_agreement``)."""
    p = pred.select(key, *[F.col(f).alias(f"p_{f}") for f in fields])
    g = _one_gold(gold, key, fields).select(key, *[F.col(f).alias(f"g_{f}") for f in fields])
    j = p.join(g, key, "inner")
    aggs = []
    for f in fields:
        pp, gg = F.col(f"p_{f}"), F.col(f"g_{f}")
        aggs += [F.count_if(pp & gg).alias(f"{f}__tp"), F.count_if(pp & ~gg).alias(f"{f}__fp"),
                 F.count_if(~pp & gg).alias(f"{f}__fn"), F.count_if(~pp & ~gg).alias(f"{f}__tn")]
    wide = j.agg(*aggs)
    stack = ", ".join(f"'{f}', `{f}__tp`, `{f}__fp`, `{f}__fn`, `{f}__tn`" for f in fields)
    return wide.selectExpr(f"stack({len(fields)}, {stack}) as (field, tp, fp, fn, tn)")


def gold_agreement(pred: DataFrame, gold: DataFrame, key: str, flags: list[str], numbers: list[str] = ()) -> DataFrame:
    """R4 with abstentions: one row for each field, from one join and one aggregate.

    For a flag the nine counts ``<gold>_<predicted>`` of ``yes``, ``no`` and ``none`` (null), ``rated`` (both sides voted), ``accuracy`` and Cohen's
    ``kappa`` over the rated, and ``coverage``: the share of labelled rows with a vote.  For a number (rank, sentiment) ``rated``, ``coverage``, the mean absolute error ``mae``
    and the mean ``bias`` of prediction less gold.  Counts that a kind of field doesn't have are 0, its rates null, as are rates over nothing; kappa is null where chance alone
    agrees always.  A key labelled twice counts once; predictions count as often as they come, and a labelled row without prediction as ``none``."""
    p = pred.select(key, *[F.col(f).alias(f"p_{f}") for f in (*flags, *numbers)])
    g = _one_gold(gold, key, [*flags, *numbers]).select(key, *[F.col(f).alias(f"g_{f}") for f in (*flags, *numbers)])
    j = g.join(p, key, "left")
    votes = ("yes", "no", "none")

    def is_(col: str, vote: str) -> Column:
        return {"yes": F.coalesce(F.col(col), F.lit(False)), "no": F.coalesce(~F.col(col), F.lit(False)), "none": F.col(col).isNull()}[vote]

    aggs = [F.count_if(is_(f"g_{f}", x) & is_(f"p_{f}", y)).alias(f"{f}__{x}_{y}") for f in flags for x in votes for y in votes]
    for f in numbers:
        off = F.col(f"p_{f}").cast("double") - F.col(f"g_{f}").cast("double")
        aggs += [F.count(off).alias(f"{f}__rated"), F.count(F.col(f"g_{f}")).alias(f"{f}__labelled"), F.avg(F.abs(off)).alias(f"{f}__mae"), F.avg(off).alias(f"{f}__bias")]
    wide = j.agg(*aggs)

    def ratio(x: Column, y: Column) -> Column:
        return F.when(y > 0, x / y)

    out = []
    for f in flags:
        n = {(x, y): F.col(f"{f}__{x}_{y}") for x in votes for y in votes}
        rated = n["yes", "yes"] + n["yes", "no"] + n["no", "yes"] + n["no", "no"]
        agree = ratio(n["yes", "yes"] + n["no", "no"], rated)
        gold_yes, pred_yes = ratio(n["yes", "yes"] + n["yes", "no"], rated), ratio(n["yes", "yes"] + n["no", "yes"], rated)
        chance = gold_yes * pred_yes + (1 - gold_yes) * (1 - pred_yes)
        out.append(F.struct(F.lit(f).alias("field"), *[n[k].alias("_".join(k)) for k in n], rated.alias("rated"), F.round(agree, 6).alias("accuracy"),
                            F.round(F.when(chance < 1, (agree - chance) / (1 - chance)), 6).alias("kappa"),
                            F.round(ratio(rated, rated + n["yes", "none"] + n["no", "none"]), 6).alias("coverage"),
                            F.lit(None).cast("double").alias("mae"), F.lit(None).cast("double").alias("bias")))
    none = F.lit(0).cast("bigint")
    for f in numbers:
        out.append(F.struct(F.lit(f).alias("field"), *[none.alias(f"{x}_{y}") for x in votes for y in votes], F.col(f"{f}__rated").alias("rated"),
                            F.lit(None).cast("double").alias("accuracy"), F.lit(None).cast("double").alias("kappa"),
                            F.round(ratio(F.col(f"{f}__rated"), F.col(f"{f}__labelled")), 6).alias("coverage"),
                            F.round(f"{f}__mae", 6).alias("mae"), F.round(f"{f}__bias", 6).alias("bias")))
    return wide.select(F.inline(F.array(*out)))
