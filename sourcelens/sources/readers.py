"""Readers for landed scraper output (S1-S9) and the discovery union.

Every reader takes a path of JSON (one item per line, or ``multiLine`` arrays) read with an explicit schema, so nothing is
inferred.  An unreadable line doesn't fail the job: it is counted (``Source.corrupt``) and dropped.  Each reader
returns rows of the ``discovery`` shape (or the answer shape), with ``seq`` giving a total order within the source: by file
time, path and place in the file, then by kind and place within an item.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sourcelens.functions.text import ad_copy, first_nonempty
from sourcelens.functions.urls import canonical_url
from sourcelens.operators.catalog import tag_topics
from sourcelens.operators.dedupe import last_by_key
from sourcelens.operators.ownership import label_ad_ownership
from sourcelens.rules import BrandRules
from sourcelens.schemas import (AD_ITEM, ANSWER_API_ITEM, ANSWER_ITEM, CONTENT_ITEM, DISCOVERY, FORUM_ITEM,
                                PLACE, SERP_ITEM, landing_order)

# Position of each source in the discovery union (a fixed total order for ties).
SOURCE_ORDER = {"serp": 0, "news": 1, "ads": 2, "reddit": 3}


CORRUPT = "_corrupt_record"


def _parsed(spark: SparkSession, path, schema: T.StructType, multiline: bool, observe: Observation | None) -> DataFrame:
    """Landed JSON with its landing order; an unreadable line has nulls and its text in ``CORRUPT``."""
    df = (spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
          .option("multiLine", str(multiline).lower()).json(path).withColumn("item_seq", landing_order()))
    return df if observe is None else df.observe(observe, F.count(F.lit(1)).alias("lines"), F.count(CORRUPT).alias("corrupt"))


def read_items(spark: SparkSession, path, schema: T.StructType, multiline: bool = False,
               observe: Observation | None = None) -> DataFrame:
    """Landed JSON with an explicit schema; ``item_seq`` is the landing order.  Unreadable lines are dropped; ``observe``
    counts them, and all lines, while the items are first used (``stage_items`` keeps them)."""
    return _parsed(spark, path, schema, multiline, observe).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_lines(df: DataFrame, source: str) -> DataFrame:
    """(source, file, block, row, line, reason) of the unreadable lines of a parsed frame, with their whole text."""
    line = F.col(CORRUPT)
    value = F.try_parse_json(line)
    reason = (F.when(F.trim(line) == "", F.lit("blank")).when(value.isNull(), F.lit("no JSON"))
               .when(~F.schema_of_variant(value).startswith("OBJECT"), F.lit("no object")).otherwise(F.lit("a field of another type")))
    return df.where(line.isNotNull()).select(F.lit(source).alias("source"), "item_seq.file", "item_seq.block", "item_seq.row", line.alias("line"), reason.alias("reason"))


def stage_items(spark: SparkSession, path, schema: T.StructType, staged: str, source: str,
                observe: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse landed JSON once into Parquet at ``staged``, readable and unreadable lines in a partition each.  Gives the items, as ``read_items`` does,
    and the quarantine (``rejected_lines``); together they are every landed line."""
    parsed = _parsed(spark, path, schema, False, observe).withColumn("rejected", F.col(CORRUPT).isNotNull())
    parsed.write.mode("overwrite").partitionBy("rejected").parquet(staged)
    back = spark.read.schema(parsed.schema).parquet(staged)
    return back.where("NOT rejected").drop(CORRUPT, "rejected"), rejected_lines(back.where("rejected"), source)


def _text_of(v: Column) -> Column:
    """A value that may be text or an object: text as it is, an object or list as JSON, null as null."""
    kind = F.schema_of_variant(v)
    return (F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.to_json(v))
             .when(kind != "VOID", F.try_variant_get(v, "$", "string")))


def _search_query(v: Column) -> Column:
    """``searchQuery`` is an object ``{"term": ...}`` (without a term: no query) or a plain string."""
    term = F.when(F.schema_of_variant(v).startswith("OBJECT"), F.try_variant_get(v, "$.term", "string")).otherwise(_text_of(v))
    return F.coalesce(term, F.lit(""))


def _conform(df: DataFrame) -> DataFrame:
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in DISCOVERY.fields])


_REC = ("struct<url:string,platform:string,query:string,rank:bigint,title:string,snippet:string,"
        f"seq:{PLACE.simpleString()}>")


def place(kind: int, pos) -> Column:
    """Order of a record: its item, then its kind (0 hits, 1 overview, 2 and 3 panels), then its place."""
    pos = F.lit(pos) if isinstance(pos, int) else pos
    return F.struct(F.col("item_seq").alias("item"), F.lit(kind).alias("kind"), pos.cast("int").alias("pos"))


def serp_records(items: DataFrame, topics: DataFrame | None, platform: str = "web",
                 overviews: bool = True, broadcast_topics: bool = False) -> DataFrame:
    """S1-S3 (S4 with ``platform='news', overviews=False``): organic hits with 1-based rank
    (hits without a URL count for rank, then are dropped), the AI overview as a rank-0
    pseudo-URL row, and the assistant panels as rank-0 pseudo-URL rows.

    One pass over the items: every item builds one array of its candidate records
    (organic, overview, panels), which is filtered and ``inline``d - the landing files are
    scanned once, not once per record kind.  ``broadcast_topics``: as in ``tag_topics``, the records are
    then not shuffled."""
    q = _search_query(F.col("searchQuery"))
    base = items.withColumn("query", q)
    qc = F.col("query")

    def rec(url, plat, rank, title, snippet, seq):
        return F.struct(url.alias("url"), F.lit(plat).alias("platform"), qc.alias("query"),
                        F.lit(rank).cast("bigint").alias("rank") if isinstance(rank, int) else rank.cast("bigint")
                        .alias("rank"), title.alias("title"), snippet.alias("snippet"), seq.alias("seq"))

    def arr(c):
        return F.coalesce(c, F.array().cast(f"array<{_REC}>"))

    organic = F.filter(
        F.transform(F.col("organicResults"), lambda r, i: rec(
            r["url"], platform, i + 1, F.coalesce(r["title"], F.lit("")), F.coalesce(r["description"], F.lit("")),
            place(0, i))),
        lambda x: x["url"].isNotNull() & (x["url"] != ""))
    parts = [arr(organic)]
    if overviews:
        ai = first_nonempty(_text_of(F.col("aiOverview")), F.col("aiOverviewText"))
        ov = F.when(ai.isNotNull(), F.array(rec(F.concat(F.lit("aioverview::"), qc), "ai_overview", 0,
                                                F.lit("Google AI Overview"), ai, place(1, 0))))
        parts.append(arr(ov))
        for kind, col, prefix, plat, title in (
                (2, "chatGptSearchResults", "chatgptsearch::", "chatgpt_search", "ChatGPT Search Panel"),
                (3, "perplexitySearchResults", "perplexitysearch::", "perplexity_search", "Perplexity Search Panel")):
            def panel(kind=kind, prefix=prefix, plat=plat, title=title):
                return lambda p, i: rec(F.concat(F.lit(prefix), qc), plat, 0, F.lit(title),
                                        F.coalesce(first_nonempty(p["text"], p["answer"]), F.lit("")), place(kind, i))
            panels = F.filter(F.transform(F.col(col), panel()), lambda x: x["snippet"] != "")
            parts.append(arr(panels))
    out = base.select(F.inline(F.concat(*parts)))
    if topics is not None:
        out = tag_topics(out, topics, "query", broadcast=broadcast_topics)
    else:
        out = out.withColumn("intent", F.lit("unknown")).withColumn("topic_id", F.lit(""))
    return _conform(out.withColumn("source_ord", F.lit(SOURCE_ORDER["news" if platform == "news" else "serp"])))


def read_serp(spark: SparkSession, path, topics: DataFrame | None = None, observe: Observation | None = None,
              broadcast_topics: bool = False) -> DataFrame:
    return serp_records(read_items(spark, path, SERP_ITEM, observe=observe), topics, "web", True, broadcast_topics)


def read_news(spark: SparkSession, path, topics: DataFrame | None = None, observe: Observation | None = None,
              broadcast_topics: bool = False) -> DataFrame:
    return serp_records(read_items(spark, path, SERP_ITEM, observe=observe), topics, "news", False, broadcast_topics)


def ad_records(items: DataFrame, rules: BrandRules) -> DataFrame:
    """S5 + F12 + J8: advertiser = name or id; url = url or previewUrl or ``ad::<creative or
    advertiser>``; dropped when both url and copy are empty; ownership set here."""
    adv = F.coalesce(first_nonempty(F.col("advertiserName"), F.col("advertiserId")), F.lit(""))
    raw_url = F.coalesce(first_nonempty(F.col("url"), F.col("previewUrl")), F.lit(""))
    df = (items.select(adv.alias("advertiser"), raw_url.alias("_raw_url"), ad_copy(F.col("variants")).alias("_copy"),
                       F.coalesce(F.col("creativeId"), adv).alias("_creative"), "item_seq")
               .where((F.col("_raw_url") != "") | (F.col("_copy") != "")))
    df = label_ad_ownership(df, rules, "advertiser", "_raw_url")
    out = df.select(F.when(F.col("_raw_url") != "", F.col("_raw_url"))
                     .otherwise(F.concat(F.lit("ad::"), F.col("_creative"))).alias("url"),
                    F.lit("ads").alias("platform"), F.lit("ads").alias("query"), F.lit("ads").alias("intent"),
                    F.lit("").alias("topic_id"), F.lit(0).cast("bigint").alias("rank"),
                    F.col("advertiser").alias("title"), F.col("_copy").alias("snippet"),
                    "advertiser", "ownership", F.lit(SOURCE_ORDER["ads"]).alias("source_ord"),
                    place(0, 0).alias("seq"))
    return _conform(out)


def read_ads(spark: SparkSession, path, rules: BrandRules, observe: Observation | None = None) -> DataFrame:
    return ad_records(read_items(spark, path, AD_ITEM, observe=observe), rules)


def forum_records(items: DataFrame) -> DataFrame:
    """url = url or link; text = body or text; query ``reddit``, intent ``community``."""
    url = first_nonempty(F.col("url"), F.col("link"))
    out = (items.where(url.isNotNull())
                .select(url.alias("url"), F.lit("reddit").alias("platform"), F.lit("reddit").alias("query"),
                        F.lit("community").alias("intent"), F.lit("").alias("topic_id"),
                        F.lit(0).cast("bigint").alias("rank"), F.coalesce(F.col("title"), F.lit("")).alias("title"),
                        F.coalesce(first_nonempty(F.col("body"), F.col("text")), F.lit("")).alias("snippet"),
                        F.lit(SOURCE_ORDER["reddit"]).alias("source_ord"), place(0, 0).alias("seq")))
    return _conform(out)


def read_forum(spark: SparkSession, path, observe: Observation | None = None) -> DataFrame:
    return forum_records(read_items(spark, path, FORUM_ITEM, observe=observe))


def page_bodies(items: DataFrame) -> DataFrame:
    """Crawled bodies keyed by canonical URL; markdown preferred over plain text (it keeps
    the links); the last landed item per URL wins.  A crawler that reports the URL it
    was asked for (``requested_url``) is keyed by that, so redirects still find their record."""
    key = first_nonempty(F.col("requested_url"), F.col("url"))
    df = (items.where(key.isNotNull())
               .select(canonical_url(key).alias("url"),
                       F.coalesce(first_nonempty(F.col("markdown"), F.col("text")), F.lit("")).alias("text"),
                       F.col("item_seq").alias("seq")))
    return last_by_key(df, "url", "seq").drop("seq")


def read_pages(spark: SparkSession, path, observe: Observation | None = None) -> DataFrame:
    return page_bodies(read_items(spark, path, CONTENT_ITEM, observe=observe))


def answer_items(items: DataFrame) -> DataFrame:
    """Answers with citations; items without a prompt dropped; non-empty citation URLs kept.

    A raw item names neither surface nor run: the landing folder does (``answers/surface=chatgpt/run=2/...``), and
    partition columns fill these fields.  An item that has neither keeps a null surface, which the snapshot
    (E4) reports as an error row."""
    return (items.where(F.col("prompt").isNotNull() & (F.col("prompt") != ""))
                 .select("surface", F.col("run").cast("bigint").alias("run"), "prompt",
                         F.coalesce(F.col("response"), F.lit("")).alias("response"),
                         F.filter(F.coalesce(F.col("citations.url"), F.array().cast("array<string>")),
                                  lambda u: u.isNotNull() & (u != "")).alias("citations"),
                         "error", F.col("item_seq").alias("seq")))


def read_answers(spark: SparkSession, path, observe: Observation | None = None) -> DataFrame:
    return answer_items(read_items(spark, path, ANSWER_ITEM, observe=observe))


def answer_api_items(items: DataFrame) -> DataFrame:
    """Answer-API payloads: the first choice's content; sources = ``citations``, else
    ``search_results[].url``; empty values removed."""
    content = F.coalesce(F.get(F.col("choices"), 0)["message"]["content"], F.lit(""))
    srcs = F.when(F.size(F.coalesce(F.col("citations"), F.array().cast("array<string>"))) > 0, F.col("citations")) \
        .otherwise(F.coalesce(F.col("search_results.url"), F.array().cast("array<string>")))
    return items.select("surface", F.col("run").cast("bigint").alias("run"), "prompt",
                        content.alias("response"),
                        F.filter(srcs, lambda u: u.isNotNull() & (u != "")).alias("citations"),
                        "error", F.col("item_seq").alias("seq"))


def read_answer_api(spark: SparkSession, path, observe: Observation | None = None) -> DataFrame:
    return answer_api_items(read_items(spark, path, ANSWER_API_ITEM, observe=observe))


@dataclass
class Source:
    """One landed source of a run: its rows (None if nothing is there) and what became of them."""
    name: str
    rows: DataFrame | None
    seen: Observation | None = None
    rejected: DataFrame | None = None

    def report(self) -> dict[str, str]:
        """Status for ``run_meta``, once the rows have been used: missing, or ok with line counts."""
        if self.rows is None:
            return {f"source.{self.name}": "missing"}
        out = {f"source.{self.name}": "ok"}
        if self.seen is not None:
            out |= {f"source.{self.name}.{k}": str(v) for k, v in self.seen.get.items()}
        return out


def try_source(name: str, read, *args) -> Source:
    """U1 failure isolation: a source whose landing folder is missing contributes nothing, and its report says so.  Any other
    error is one of ours and fails the run."""
    from pyspark.errors import AnalysisException
    seen = Observation(f"source_{name}")
    try:
        return Source(name, read(*args, observe=seen), seen)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return Source(name, None)


def staged_source(name: str, spark: SparkSession, path: str, schema: T.StructType, staged: str, make) -> Source:
    """As ``try_source``, by way of ``stage_items``: ``make(items)`` gives the source's rows, and its unreadable lines are kept."""
    from pyspark.errors import AnalysisException
    seen = Observation(f"source_{name}")
    try:
        items, rejected = stage_items(spark, path, schema, staged, name, seen)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return Source(name, None)
    return Source(name, make(items), seen, rejected)


def write_quarantine(sources: list[Source], path: str) -> None:
    """The unreadable lines of all sources as one table; nothing is written if no source is staged."""
    found = [s.rejected for s in sources if s.rejected is not None]
    if found:
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        out.write.mode("overwrite").partitionBy("source").parquet(path)


def union_discovery(*sources: DataFrame) -> DataFrame:
    """All discovery sources in one frame; a missing (None) source contributes nothing."""
    frames = [s for s in sources if s is not None]
    if not frames:
        raise ValueError("no discovery source")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_failures(spark: SparkSession, path, observe: Observation | None = None) -> DataFrame:
    """Failed calls: surface, run, prompt (null: the whole call), note."""
    schema = T._parse_datatype_string("surface string, run bigint, prompt string, note string")
    return read_items(spark, path, schema, observe=observe).drop("item_seq")


def read_verdicts(spark: SparkSession, path, kind: str = "web", brand: str | None = None,
                  observe: Observation | None = None) -> DataFrame:
    """Model verdicts landed as JSON lines (one object per key), for the merge.

    ``kind`` is ``web`` or ``answer``.  Verdicts written with brand-named fields, as a tool
    schema for one brand would name them (``says_about_<brand>``, ``sentiment_<brand>``,
    ``<brand>_mentioned``, ``<brand>_rank``, ``<brand>_recommended``), are mapped onto the
    generic columns when ``brand`` is given.  ``seq`` is the landing order: the last verdict of a key counts."""
    from sourcelens.schemas import ANSWER_VERDICT, WEB_VERDICT
    target = WEB_VERDICT if kind == "web" else ANSWER_VERDICT
    if not brand:
        return read_items(spark, path, target, observe=observe).withColumnRenamed("item_seq", "seq")
    b = brand.lower()
    renames = {f"says_about_{b}": "says_about_brand", f"sentiment_{b}": "sentiment", f"{b}_mentioned": "mentioned",
               f"{b}_rank": "rank", f"{b}_recommended": "recommended"}
    back = {v: k for k, v in renames.items()}
    fields = list(target.fields) + [T.StructField(back[f.name], f.dataType, True)
                                    for f in target.fields if f.name in back]
    df = read_items(spark, path, T.StructType(fields), observe=observe)
    # either naming is accepted: the brand-named field wins when both are present
    return df.select(*[(F.coalesce(F.col(back[f.name]), F.col(f.name)) if f.name in back else F.col(f.name))
                       .alias(f.name) for f in target.fields], F.col("item_seq").alias("seq"))
