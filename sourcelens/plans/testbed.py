"""Inputs of the registered queries, derived by Spark from the driver's tables.

The driver's tables carry no scraper output, so each query derives its inputs from them
(pages as search hits and as a page cache, documents as page bodies, labels as model
verdicts, conversations as assistant answers, part as a catalog).  Every derivation is a
plain DataFrame plan over the whole table; the same derivation is written in SQL in
``__spark_entry__.oracle_sql``.  Ids are used only to vary the shape of each derived record
(object or string fields, missing URLs, empty copy, ranks, fetch dates) - never to pick a
subset: every row of every table read contributes a record, with its whole text.  A document, label or
conversation stands beside page ``id % number of pages``, so none is left over, and rows leave only by the
operators' own rules (a hit without URL, an ad without URL or copy, an item without prompt).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcelens.functions.urls import canonical_url, host_of
from sourcelens.rules import BrandRules
from sourcelens.schemas import given_order

AS_OF = "2024-01-20"
SURFACES = ["chatgpt", "perplexity", "gemini"]   # gemini has no runner: it fails as an unknown surface
KNOWN_SURFACES = ["chatgpt", "perplexity"]
NUM_RUNS = 3
# topic catalog over the language segment of page paths; 'es' is missing on purpose,
# 'click' style duplicates resolve to the last entry
LANG_TOPICS = [
    {"id": "t_en", "intent": "brand_entity", "query": "en"},
    {"id": "t_fr", "intent": "comparison", "query": "fr"},
    {"id": "t_de_old", "intent": "category", "query": "de"},
    {"id": "t_de", "intent": "purchase", "query": "de"},
]
EVENT_TOPICS = [
    {"id": "t_view", "intent": "browse", "query": "view"},
    {"id": "t_click", "intent": "engage", "query": "click"},
    {"id": "t_buy", "intent": "purchase", "query": "purchase"},
    {"id": "t_click2", "intent": "engage_again", "query": "click"},
]
SELECTORS = ["3", "ring", "1", "BLUE BOLT", "small"]
FAILURES = [("perplexity", 2, None, "api 500"), ("chatgpt", 1, "NATION_3", "timeout")]


def rules() -> BrandRules:
    """The test brand of the driver's synthetic tables."""
    return BrandRules(
        brand="license",
        owned_domains=("example.net",),
        competitor_domains=("example.org",),
        competitor_brands=("Token", "There", "example.com"),
        claim_patterns=(
            ("only_the", ("only.{0,20}the",)),
            ("the_only", ("the.{0,12}only",)),
            ("license_the", ("license.{0,20}the",)),
        ),
        current_signal_patterns=("that the",),
        nonprod_prefixes=("m", "blog"),
        owned_app_ids=("id7", "net.example.reader"),
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def beside_page(df: DataFrame, pages: DataFrame, id_col: str, plus: int = 0) -> DataFrame:
    """``df`` with the columns of page ``(id + plus) % number of pages``."""
    n = pages.select(F.count(F.lit(1))).scalar()
    return df.withColumn("_page", (F.col(id_col) + plus) % n).join(pages, F.col("_page") == F.col("page_id")).drop("_page")


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three discovery sources: every document as a web hit for a page, every page as a news hit, every conversation
    turn as a forum post on a page."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1).alias("query"))
    web = beside_page(table(spark, sf_dir, "documents").select("doc_id", "text"), pages, "doc_id").select(
        "url", F.lit("web").alias("platform"), "query", (F.col("doc_id") % 20 + 1).alias("rank"), "title",
        F.coalesce("text", F.lit("")).alias("snippet"), F.lit(0).cast("bigint").alias("source_ord"), F.col("doc_id").alias("seq"))
    news = pages.select("url", F.lit("news").alias("platform"), "query", (F.col("page_id") % 7 + 1).alias("rank"), "title",
                        F.col("title").alias("snippet"), F.lit(1).cast("bigint").alias("source_ord"), F.col("page_id").alias("seq"))
    forum = beside_page(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), pages, "conv_id").select(
        "url", F.lit("reddit").alias("platform"), F.lit("reddit").alias("query"), F.lit(0).cast("bigint").alias("rank"), "title",
        F.coalesce("text", F.lit("")).alias("snippet"), F.lit(3).cast("bigint").alias("source_ord"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"))
    return web.unionByName(news).unionByName(forum)


def page_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a page cache: canonical URL, html as text, fetched 0-19 days before AS_OF."""
    return (table(spark, sf_dir, "pages")
            .select(canonical_url("url").alias("url"), F.col("html").alias("text"),
                    F.date_sub(F.lit(AS_OF).cast("date"), (F.col("page_id") % 20).cast("int")).alias("fetch_date"),
                    F.col("page_id").alias("seq")))


def crawled_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed crawl: every document is a body of its page's URL (the last document wins)."""
    from sourcelens.operators.dedupe import last_by_key
    pages = table(spark, sf_dir, "pages").select("page_id", canonical_url("url").alias("url"))
    docs = beside_page(table(spark, sf_dir, "documents").select("doc_id", "text"), pages, "doc_id")
    return last_by_key(docs.select("url", "text", F.col("doc_id").alias("seq")), "url", "seq").drop("seq")


def label_verdicts_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as model verdicts keyed by canonical page URL, several for a key; ``seq`` orders them."""
    pages = table(spark, sf_dir, "pages").select("page_id", canonical_url("url").alias("key"))
    lab = beside_page(table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), pages, "doc_id")
    return label_verdict_columns(lab).withColumnRenamed("doc_id", "seq").drop("page_id")


def label_verdict_columns(df: DataFrame) -> DataFrame:
    return df.select(
        *[c for c in ("key", "page_id", "doc_id") if c in df.columns],
        F.when(F.col("quality") == 1, F.lit("Good page.")).otherwise(F.lit("Weak page.")).alias("says_about_brand"),
        (F.col("toxic") == 1).alias("mentions_competition"),
        F.lit(None).cast("string").alias("competition_summary"),
        F.when(F.col("toxic") == 1, F.array(F.lit("There"))).otherwise(F.array().cast("array<string>"))
        .alias("competitors_named"),
        (F.col("quality") - F.col("toxic")).cast("double").alias("sentiment"),
        F.lit(None).cast("string").alias("price_mentioned"))


def conversation_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User and system turns as a prompt catalog (first turn of equal texts kept)."""
    from sourcelens.operators.dedupe import keep_first
    u = (table(spark, sf_dir, "conversations").where(F.col("role") != "assistant")
         .select(F.col("text").alias("prompt"), F.lit("conv").alias("intent"),
                 F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"))
                 .alias("topic_id"), "conv_id", "turn"))
    return keep_first(u, "prompt", ["conv_id", "turn"]).drop("conv_id", "turn")


def conversation_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user or system turn answered by the next assistant turn ('' when none), with two page URLs
    appended to the text and one page URL as a citation."""
    conv = table(spark, sf_dir, "conversations")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    u = conv.where(F.col("role") != "assistant").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = conv.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                                        F.col("text").alias("answer"))
    j = u.join(a, ["conv_id", "turn"], "left")
    p1 = pages.select(F.col("page_id").alias("_p1"), F.col("url").alias("u1"))
    p2 = pages.select(F.col("page_id").alias("_p2"), F.col("url").alias("u2"))
    p3 = pages.select(F.col("page_id").alias("_p3"), F.col("url").alias("u3"))
    j = (j.join(p1, j.conv_id == p1._p1, "left")
          .join(p2, (j.conv_id + 100 + j.turn) == p2._p2, "left")
          .join(p3, (j.conv_id * 2 + j.turn) == p3._p3, "left"))
    response = F.when(F.col("answer").isNull(), F.lit("")).otherwise(
        F.concat_ws(" ", F.col("answer"), F.lit("See"), F.col("u1"), F.lit("and ("),
                    F.col("u2"), F.lit(").")))
    return j.select(
        "conv_id", "turn",
        F.when(F.col("conv_id") % 2 == 0, F.lit("chatgpt")).otherwise(F.lit("perplexity")).alias("surface"),
        F.lit(1).cast("bigint").alias("run"), "prompt", response.alias("response"),
        F.when(F.col("u3").isNull(), F.array().cast("array<string>"))
        .otherwise(F.array(F.col("u3"), F.col("u1"))).alias("citations"),
        F.lit(None).cast("string").alias("error"))


def link_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page bodies made of other pages' URLs (ids +1, +2, +5), an asset, a tracker and a same-host link."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    q = {k: pages.select(F.col("page_id").alias(f"_q{k}"), F.col("url").alias(f"u{k}")) for k in (1, 2, 5)}
    j = pages
    for k, qk in q.items():
        j = j.join(qk, j.page_id + k == qk[f"_q{k}"], "left")
    own = F.concat(F.lit("https://"), host_of("url"), F.lit("/about"))
    body = F.concat_ws(
        " ", F.lit("Read"), F.col("u1"), F.lit("and"), F.concat(F.lit("("), F.col("u2"), F.lit(")")),
        F.lit("logo"), F.concat(F.lit("https://cdn.example.com/img/"), F.col("page_id").cast("string"), F.lit(".PNG")),
        F.lit("px"), F.concat(F.lit("https://stats.doubleclick.net/p/"), F.col("page_id").cast("string")),
        F.lit("tag"), F.concat(F.lit("https://www.googletagmanager.com/gtm.js?id="), F.col("page_id").cast("string")),
        F.lit("home"), own, F.lit("more"), F.concat(F.col("u5"), F.lit(".")), F.lit("again"), F.col("u1"))
    return j.select("page_id", "url", body.alias("text"))


# ---------------------------------------------------------------------------
# Landed scraper output, rebuilt from the tables as JSON lines and parsed back with the
# readers' declared schemas (one item per source row; nothing is sampled).
# ---------------------------------------------------------------------------
def _json_str(c):
    """A JSON string literal for a column (to_json of a one-element array, brackets cut)."""
    j = F.to_json(F.array(c))
    return F.substr(j, F.lit(2), F.length(j) - 2)


def _page_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per document: its text, its page, the next page, and all turns of the conversation of its id.

    Ids meet the pages first, without texts; the texts of documents and turns are shuffled once, by id."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", "html", F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1).alias("lang"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item"), F.col("text").alias("doc"))
    turns = (table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("item"))
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("turns")))
    ids = docs.select("item").distinct()
    b = beside_page(ids, pages.select("page_id", F.col("url").alias("next_url")), "item", plus=1).drop("page_id")
    b = beside_page(b, pages, "item").drop("page_id")
    return docs.join(b, "item").join(turns, "item", "left").withColumn("page_id", F.col("item"))


def serp_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search-result item per document: searchQuery as an object (even ids; every tenth without a term) or a string,
    three organic hits (its page, a hit without URL, the next page), an overview that is an object, a string or absent,
    and assistant panels (one for each turn of a conversation)."""
    b = _page_base(spark, sf_dir)
    pid = F.col("page_id")
    sq = (F.when(pid % 10 == 4, F.lit('{"other": 1}'))
           .when(pid % 2 == 0, F.to_json(F.struct(F.col("lang").alias("term")))).otherwise(_json_str(F.col("lang"))))
    organic = F.to_json(F.array(
        F.struct(F.col("url").alias("url"), F.col("title").alias("title"), F.coalesce("doc", F.lit("")).alias("description")),
        F.struct(F.lit(None).cast("string").alias("url"), F.lit("ad slot").alias("title"),
                 F.lit(None).cast("string").alias("description")),
        F.struct(F.col("next_url").alias("url"), F.lit("next").alias("title"),
                 F.lit(None).cast("string").alias("description"))))
    ai = (F.when(pid % 3 == 0, F.to_json(F.struct(pid.alias("n"))))
           .when(pid % 3 == 1, _json_str(F.concat(F.lit("[1] "), F.col("title")))).otherwise(F.lit("null")))
    ai_text = F.when(pid % 3 == 2, _json_str(F.coalesce("doc", F.lit("")))).otherwise(F.lit("null"))
    panel = "array<struct<text:string,answer:string>>"
    chat = F.to_json(F.concat(
        F.transform(F.coalesce("turns", F.array().cast("array<string>")),
                    lambda t: F.struct(F.lit(None).cast("string").alias("text"), t.alias("answer"))).cast(panel),
        F.array(F.struct(F.lit("").alias("text"), F.lit("").alias("answer"))).cast(panel)))
    px = F.when(pid % 2 == 0, F.to_json(F.array(F.struct(F.concat(F.lit("px "), F.col("title")).alias("text")))))\
        .otherwise(F.lit("null"))
    line = F.concat(F.lit('{"searchQuery": '), sq, F.lit(', "organicResults": '), organic,
                    F.lit(', "aiOverview": '), ai, F.lit(', "aiOverviewText": '), ai_text,
                    F.lit(', "chatGptSearchResults": '), chat, F.lit(', "perplexitySearchResults": '), px, F.lit("}"))
    return b.select(F.col("page_id").alias("item_seq"), line.alias("line"))


def ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ad item per document: own / competitor / id-only / other advertisers, landing URL or preview URL or neither, and
    variants whose copy may be empty."""
    b = _page_base(spark, sf_dir)
    pid = F.col("page_id")
    name = (F.when(pid % 4 == 0, F.lit("License Corp")).when(pid % 4 == 1, F.lit("Example Ads"))
             .when(pid % 4 == 2, F.lit(None)).otherwise(F.concat(F.lit("Shop "), pid.cast("string"))))
    item = F.struct(
        name.alias("advertiserName"), F.concat(F.lit("AR"), pid.cast("string")).alias("advertiserId"),
        F.when(pid % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("CR"), pid.cast("string"))).alias("creativeId"),
        F.lit("TEXT").alias("format"),
        F.when(pid % 3 == 0, F.col("url")).when(pid % 3 == 1, F.lit(None)).otherwise(F.lit("")).alias("url"),
        F.when(pid % 6 == 1, F.col("next_url")).alias("previewUrl"),
        F.when(pid % 7 == 0, F.array().cast("array<struct<text:string,headline:string,description:string>>"))
         .otherwise(F.array(
             F.struct(F.col("title").alias("text"), F.lit(None).cast("string").alias("headline"),
                      F.lit(None).cast("string").alias("description")),
             F.struct(F.lit(None).cast("string").alias("text"), F.lit("").alias("headline"),
                      F.coalesce("doc", F.lit("")).alias("description")))).alias("variants"))
    return b.select(F.col("page_id").alias("item_seq"), F.to_json(item).alias("line"))


def forum_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forum post per conversation turn: url (even conversations) or link, body or text."""
    c = table(spark, sf_dir, "conversations")
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("purl"))
    j = beside_page(c, pages, "conv_id")
    item = F.struct(
        F.when(F.col("conv_id") % 2 == 0, F.col("purl")).alias("url"),
        F.when(F.col("role") != "system", F.concat(F.lit("https://forum.test/p/"), F.col("conv_id").cast("string"),
                                                   F.lit("/"), F.col("turn").cast("string"))).alias("link"),
        F.concat(F.lit("Thread "), F.col("conv_id").cast("string")).alias("title"),
        F.when(F.col("role") == "user", F.col("text")).alias("body"),
        F.col("text").alias("text"))
    return j.select((F.col("conv_id") * 1000 + F.col("turn")).alias("item_seq"), F.to_json(item).alias("line"))


def content_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One crawled page per document: redirected URLs report the requested URL, markdown
    (the document) on even ids, html as plain text."""
    b = _page_base(spark, sf_dir)
    pid = F.col("page_id")
    item = F.struct(
        F.when(pid % 5 == 0, F.concat(F.lit("https://redirect.test/"), pid.cast("string"))).otherwise(F.col("url"))
        .alias("url"),
        F.when(pid % 5 == 0, F.col("url")).alias("requested_url"),
        F.when(pid % 2 == 0, F.col("doc")).otherwise(F.lit("")).alias("markdown"),
        F.col("html").alias("text"))
    return b.select(F.col("page_id").alias("item_seq"), F.to_json(item).alias("line"))


def answer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer item per user turn (conversation_answers), citations as structs, plus one
    item per system turn: system messages carry no prompt, so the reader drops them."""
    a = conversation_answers(spark, sf_dir)
    cites = F.transform(F.col("citations"), lambda u: F.struct(u.alias("url"), F.lit("src").alias("title")))
    cites = F.concat(cites, F.array(F.struct(F.lit("").alias("url"), F.lit("empty").alias("title"))))
    item = F.struct("surface", "run", "prompt", "response", cites.alias("citations"))
    system = (table(spark, sf_dir, "conversations").where(F.col("role") == "system")
              .select((F.col("conv_id") * 1000 + F.col("turn")).alias("item_seq"),
                      F.to_json(F.struct(F.lit("chatgpt").alias("surface"), F.lit(1).alias("run"),
                                         F.lit("").alias("prompt"), F.col("text").alias("response")))
                      .alias("line")))
    users = a.select((F.col("conv_id") * 1000 + F.col("turn")).alias("item_seq"), F.to_json(item).alias("line"))
    return users.unionByName(system)


def answer_api_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer-API payload per user turn: the answer as the first choice; citations on
    even conversations, else search results."""
    a = conversation_answers(spark, sf_dir)
    even = F.col("conv_id") % 2 == 0
    item = F.struct(
        F.lit("perplexity").alias("surface"), F.col("run"), F.col("prompt"),
        F.when(F.col("response") == "", F.array().cast("array<struct<message:struct<content:string>>>"))
         .otherwise(F.array(F.struct(F.struct(F.col("response").alias("content")).alias("message"))))
        .alias("choices"),
        F.when(even, F.concat(F.col("citations"), F.array(F.lit("")))).alias("citations"),
        F.concat(F.transform(F.col("citations"), lambda u: F.struct(u.alias("url"))),
                 F.array(F.struct(F.lit("").alias("url")))).alias("search_results"))
    return a.select((F.col("conv_id") * 1000 + F.col("turn")).alias("item_seq"), F.to_json(item).alias("line"))


def parse_lines(lines: DataFrame, schema) -> DataFrame:
    """Parse landed JSON lines with a reader schema; ``item_seq`` keeps the given order."""
    return lines.select(F.from_json("line", schema).alias("i"), given_order(F.col("item_seq")).alias("item_seq")).select("i.*", "item_seq")


def land(lines: DataFrame, name: str) -> str:
    """Write lines as a landing folder of compressed JSON files, for queries that go through a ``read_*`` function."""
    from sourcelens.session import shared_scratch
    path = f"{shared_scratch(lines.sparkSession)}/landing-{uuid.uuid4().hex}/{name}"
    lines.select("line").write.option("compression", "gzip").text(path)
    return path


def landed(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a landing folder, to land them elsewhere without making them again."""
    return spark.read.text(path).select(F.col("value").alias("line"))


def app_and_market_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs, two fifths of them turned into app-store links and one into marketplace links."""
    pid, url = F.col("page_id"), F.col("url")
    s = pid.cast("string")
    u = (F.when(pid % 5 == 0, F.concat(F.lit(" https://Apps.Apple.com/us/app/reader/id"), s, F.lit("?mt=8")))
          .when(pid % 5 == 1, F.concat(F.lit("https://play.google.com/store/apps/details?id=net.example.r"),
                                       F.when(pid % 2 == 0, F.lit("eader")).otherwise(s)))
          .when(pid % 10 == 2, F.concat(F.lit("https://www.amazon.com/x/dp/B"), s))
          .when(pid % 10 == 7, F.concat(F.lit("https://www.amazon.com/s?k=/dp"), s))
          .otherwise(url))
    return table(spark, sf_dir, "pages").select("page_id", u.alias("url"))
