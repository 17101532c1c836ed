"""

Every query reads the driver's tables (whole tables, no subsets) and runs the library's
operators on them; inputs the tables lack (search hits, a page cache, crawled bodies,
verdicts, answers) are derived from them in ``sourcelens.plans.testbed``.  Each oracle
computes the same result in DuckDB SQL from the same tables.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pandas as pd  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from sourcelens.functions.text import any_claim, brands_in, claim_flags, lowered, mentions_brand, prices_seen  # noqa: E402
from sourcelens.functions.urls import canonical_url, host_of, path_of, strip_ws  # noqa: E402
from sourcelens.operators.answers import error_rows, with_sources, with_status  # noqa: E402
from sourcelens.operators.brand_index import catalog_mentions, with_catalog_brands  # noqa: E402
from sourcelens.operators.catalog import (add_adhoc, read_topics, request_manifest, select_by_table,  # noqa: E402
                                          select_catalog, tag_topics, topics_frame)
from sourcelens.operators.dedupe import dedupe_best  # noqa: E402
from sourcelens.operators.fetch import enrich, merge_bodies, plan_fetch  # noqa: E402
from sourcelens.operators.links import brand_mentions, link_table, with_outbound_links  # noqa: E402
from sourcelens.operators.ownership import (label_ownership, label_ownership_domains, label_ownership_join,  # noqa: E402
                                            with_nonprod)
from sourcelens.operators.verdicts import (answer_fallback, merge_verdicts, score_batches,  # noqa: E402
                                           web_fallback, with_text_labels)
from sourcelens.plans import reports, testbed as tb  # noqa: E402
from sourcelens.plans.answers import answer_sheet, answer_snapshot  # noqa: E402
from sourcelens.plans.web import web_sheet, web_snapshot  # noqa: E402
from sourcelens.schemas import (AD_ITEM, ANSWER_API_ITEM, ANSWER_ITEM, CONTENT_ITEM, FORUM_ITEM,  # noqa: E402
                                LLM_SCHEMA, SERP_ITEM, WEB_SCHEMA, WEB_VERDICT)
from sourcelens.sources import readers  # noqa: E402
from sourcelens.session import shared_scratch  # noqa: E402
from sourcelens.sources.cache import cache_fresh, cache_upsert  # noqa: E402
from sourcelens.sources.ledger import read_ledger, score_with_ledger  # noqa: E402
from sourcelens.sources.sinks import conform, new_run_id, read_sheet, write_answers, write_snapshot, write_web  # noqa: E402

R = tb.rules()
REC = ["url", "platform", "query", "intent", "topic_id", "rank", "title", "snippet"]


def _t(spark, sf, name):
    return tb.table(spark, sf, name)


# ---------------------------------------------------------------------------
# Spark queries
# ---------------------------------------------------------------------------
def q_canonical_urls(spark, sf):
    p = _t(spark, sf, "pages")
    return p.select("page_id", "url", canonical_url("url").alias("canon_url"), host_of("url").alias("host"),
                    path_of(canonical_url("url")).alias("path"))


def q_dedupe_best(spark, sf):
    recs = tb.page_records(spark, sf).withColumn("url", canonical_url("url"))
    return dedupe_best(recs, "url").select("url", "platform", "rank", F.col("seq").alias("page_id"))


def _pages_parts(spark, sf):
    p = _t(spark, sf, "pages").select("page_id", "url")
    return p.withColumn("canon_url", canonical_url("url")).withColumn("host", host_of("canon_url"))


def q_ownership_labels(spark, sf):
    return label_ownership(_pages_parts(spark, sf), R, "url", "host").select("page_id", "canon_url", "host",
                                                                              "ownership")


def q_ownership_suffix_join(spark, sf):
    return label_ownership_join(_pages_parts(spark, sf), R, "url", "host").select("page_id", "canon_url", "host",
                                                                                   "ownership")


def q_ownership_domain_table(spark, sf):
    """J7 and P6 against a table of domains that grows with the data: suppliers are competitors, some nations are owned."""
    name = F.concat(F.col("c_custkey").cast("string"), F.lit(".n"), F.col("c_nationkey").cast("string"), F.lit(".shop.test"))
    first = F.when(F.col("c_custkey") % 3 == 0, F.lit("m.c")).when(F.col("c_custkey") % 3 == 1, F.lit("blog.www.c")).otherwise(F.lit("c"))
    urls = _t(spark, sf, "customer").select("c_custkey", F.concat(first, name).alias("host"))
    s, n = _t(spark, sf, "supplier"), _t(spark, sf, "nation")
    rivals = s.select(F.concat(F.lit("C"), F.col("s_suppkey").cast("string"), F.lit(".n"), F.col("s_nationkey").cast("string"), F.lit(".shop.test")).alias("domain"),
                      F.lit("competitor").alias("kind"))
    owned = n.where("n_regionkey < 3").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit(".shop.test")).alias("domain"), F.lit("owned").alias("kind"))
    return label_ownership_domains(urls.withColumn("url", F.concat(F.lit("https://"), "host", F.lit("/p"))), R, domains=rivals.unionByName(owned),
                                   nonprod="nonprod_url").select("c_custkey", "host", "ownership", "nonprod_url")


def q_nonprod_flags(spark, sf):
    return with_nonprod(_pages_parts(spark, sf), R).select("page_id", "canon_url", "host", "nonprod_url")


def q_nonprod_report(spark, sf):
    return reports.nonprod_report(with_nonprod(_pages_parts(spark, sf), R).select(
        F.col("canon_url").alias("url"), "nonprod_url"))


def q_claim_flags(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text", lowered(F.col("text")).alias("_lt"))
    flags = claim_flags(F.col("text"), R, lower_text=F.col("_lt"))
    out = d.select("doc_id", *[c.alias(n) for n, c in flags.items()])
    return out.withColumn("stale", any_claim(R.stale_claim_names))


def q_brands_in(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text", lowered(F.col("text")).alias("_lt"))
    lt = F.col("_lt")
    d = d.select("doc_id", brands_in(F.col("text"), list(R.competitor_brands), lower_text=lt).alias("comps"),
                 mentions_brand(F.col("text"), R, lower_text=lt).alias("mentions_brand"))
    return d.select("doc_id", F.array_join("comps", "; ").alias("competitors_named"),
                    (F.size("comps") > 0).alias("mentions_competition"), "mentions_brand")


def q_brand_mentions_long(spark, sf):
    return brand_mentions(_t(spark, sf, "documents"), R.competitor_brands, "doc_id", "text")


def _brand_catalog(spark, sf):
    """The first two words of every conversation turn as a brand name; the first turn that has a name gives its place."""
    c = _t(spark, sf, "conversations")
    name = F.array_join(F.slice(F.split("text", " "), 1, 2), " ")
    return c.groupBy(name.alias("brand")).agg(F.min(F.col("conv_id") * 1000 + F.col("turn")).cast("bigint").alias("brand_pos"))


def q_catalog_mentions(spark, sf):
    """J11 with a catalog that grows with the data."""
    return catalog_mentions(_t(spark, sf, "documents").select("doc_id", "text"), _brand_catalog(spark, sf))


def q_catalog_brands(spark, sf):
    """F8 with a catalog that grows with the data, whole words only."""
    d = with_catalog_brands(_t(spark, sf, "documents").select("doc_id", "text"), _brand_catalog(spark, sf), word_boundary=True)
    return d.select("doc_id", F.array_join("comps", "; ").alias("competitors_named"), F.size("comps").cast("bigint").alias("n_brands"))


def _price_text(spark, sf):
    p = _t(spark, sf, "part")
    fl = F.floor("p_retailprice").cast("bigint").cast("string")
    text = F.concat(F.col("p_name"), F.lit(" now $"), fl, F.lit(" (was $ "),
                    (F.floor("p_retailprice").cast("bigint") + F.col("p_size")).cast("string"), F.lit("), ships $"),
                    F.col("p_size").cast("string"), F.lit(", code $"), F.col("p_partkey").cast("string"))
    return p.select("p_partkey", "p_brand", text.alias("text"))


def q_price_mentions(spark, sf):
    ps = prices_seen(F.col("text"), R)
    return _price_text(spark, sf).select("p_partkey", F.array_join(ps, ", ").alias("prices_seen"),
                                         F.get(ps, 0).alias("price_first"), F.size(ps).cast("bigint").alias("n_prices"))


def q_price_brand_top5(spark, sf):
    return reports.price_table(_price_text(spark, sf), R, key="p_brand", text="text")


def q_outbound_links(spark, sf):
    b = with_outbound_links(tb.link_bodies(spark, sf), R, "text", "url", "links")
    return b.select("page_id", F.array_join("links", ", ").alias("links_on_source"),
                    F.size("links").cast("bigint").alias("n_links"))


def q_link_table(spark, sf):
    return link_table(tb.link_bodies(spark, sf), R, "page_id", "text", "url").select(
        "page_id", F.col("link_pos").cast("bigint").alias("link_pos"), "link_url", "link_host")


def q_richer_text(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text")
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    c = _t(spark, sf, "conversations").groupBy(F.col("conv_id").alias("url")).agg(F.array_join(turns, " ").alias("text"))
    recs = d.select(F.col("doc_id").alias("url"), F.col("text").alias("snippet"))
    out = enrich(recs, c, "url", "snippet", "best")
    return out.select(F.col("url").alias("doc_id"),
                      F.when(F.col("best") == F.coalesce(F.col("snippet"), F.lit("")), F.lit("snippet"))
                      .otherwise(F.lit("body")).alias("best_from"), "best")


def q_cache_fresh(spark, sf):
    f = cache_fresh(tb.page_cache(spark, sf), tb.AS_OF, seq="seq")
    return f.select("url", F.date_format("fetch_date", "yyyy-MM-dd").alias("fetch_date"),
                    F.length("text").cast("bigint").alias("text_chars"))


def _requests(spark, sf):
    return _t(spark, sf, "pages").select(canonical_url("url").alias("url")).distinct()


def q_cache_split(spark, sf):
    plan = plan_fetch(_requests(spark, sf), tb.page_cache(spark, sf), tb.AS_OF, seq="seq")
    return (plan.hits.select("url", F.lit("hit").alias("status"))
            .unionByName(plan.misses.select("url", F.lit("miss").alias("status"))))


def q_cache_upsert(spark, sf):
    cache = tb.page_cache(spark, sf)
    plan = plan_fetch(_requests(spark, sf), cache, tb.AS_OF, seq="seq")
    crawled = tb.crawled_bodies(spark, sf).join(plan.misses, "url", "left_semi")
    nxt = cache_upsert(cache.drop("seq"), crawled, tb.AS_OF)
    return nxt.select("url", F.date_format("fetch_date", "yyyy-MM-dd").alias("fetch_date"),
                      F.length("text").cast("bigint").alias("text_chars"))


def q_topic_tag(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", F.col("event_type").alias("query"))
    return tag_topics(ev, topics_frame(spark, tb.EVENT_TOPICS), "query", broadcast=True).select(
        "event_id", "query", "intent", "topic_id")


def q_props_json(spark, sf):
    ev = _t(spark, sf, "events")
    raw = F.col("props")
    return ev.select("event_id", F.get_json_object(raw, "$.k").try_cast("bigint").alias("k"),
                     F.coalesce(F.get_json_object(raw, "$.term"), raw).alias("query"))


def _manifest(spark, sf):
    n = _t(spark, sf, "nation")
    r = _t(spark, sf, "region")
    prompts = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("prompt"), F.lower("r_name").alias("intent"),
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("topic_id"))
    return request_manifest(prompts, tb.SURFACES, tb.NUM_RUNS)


def q_request_manifest(spark, sf):
    return _manifest(spark, sf).select("surface", "run", "prompt", "intent", "topic_id")


def q_error_rows(spark, sf):
    fails = spark.createDataFrame(tb.FAILURES, "surface string, run bigint, prompt string, note string")
    return error_rows(_manifest(spark, sf), fails, tb.KNOWN_SURFACES).select(
        "surface", "run", "prompt", "intent", "topic_id", "status", "error_note")


def q_answer_status(spark, sf):
    a = tb.conversation_answers(spark, sf)
    return with_status(a, "response", "error").select("conv_id", "turn", "surface", "run", "status")


def q_verdict_merge(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text")
    lab = tb.label_verdict_columns(_t(spark, sf, "labels").withColumn("key", F.col("doc_id").cast("string")))
    df = with_text_labels(d.withColumn("key", F.col("doc_id").cast("string")), R, "text")
    m = merge_verdicts(df, lab, "key", web_fallback("text", R), use_verdict=(F.col("text") != ""))
    return m.select("doc_id", "verdict_source", F.coalesce("says_about_brand", F.lit("")).alias("says_about_brand"),
                    F.coalesce("mentions_competition", F.lit(False)).alias("mentions_competition"),
                    F.coalesce("competition_summary", F.lit("")).alias("competition_summary"),
                    F.coalesce(F.array_join("competitors_named", "; "), F.lit("")).alias("competitors_named"),
                    F.coalesce("sentiment", F.lit(0.0)).alias("sentiment"),
                    F.coalesce(F.when(F.col("price_mentioned") != "", F.col("price_mentioned")),
                               F.get("prices_seen", 0)).alias("price"))


def q_citations_merge(spark, sf):
    a = tb.conversation_answers(spark, sf).where(F.col("response") != "")
    fb = answer_fallback("response", R)
    a = a.withColumn("fb_sources", fb["sources_cited"])
    s = with_sources(a, R, "fb_sources", "citations", "response", "sources")
    return s.select("conv_id", "turn", F.array_join("sources", ", ").alias("sources_cited"), "nonprod_url",
                    F.size("sources").cast("bigint").alias("n_sources"))


def _catalog(spark, sf):
    p = _t(spark, sf, "part")
    return p.select((F.col("p_partkey") + 1).alias("pos"), F.col("p_name").alias("label"))


def q_catalog_select(spark, sf):
    sel = select_catalog(_catalog(spark, sf), tb.SELECTORS, "label", "pos")
    return sel.select("label", "sel_ord", "pos")


def q_catalog_select_table(spark, sf):
    """J12 with selectors that grow with the data: positions, and parts of labels that cross words."""
    parts = _t(spark, sf, "part").select("p_partkey", "p_name")
    s = _t(spark, sf, "supplier").join(parts, F.col("s_suppkey") == F.col("p_partkey"))
    token = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit(" "), (F.col("s_suppkey") * 7).cast("string"))).otherwise(
        F.upper(F.substring("p_name", F.lit(3), (4 + F.col("s_suppkey") % 9).cast("int"))))
    return select_by_table(_catalog(spark, sf), s.select(F.col("s_suppkey").alias("ord"), token.alias("token"))).select("label", "sel_ord", "pos")


def q_adhoc_prompts(spark, sf):
    sel = select_catalog(_catalog(spark, sf), tb.SELECTORS, "label", "pos")
    p = _t(spark, sf, "part")
    text = (F.when(F.col("p_size") <= 3, F.col("p_name"))
             .when(F.col("p_size") >= 48, F.lit("  "))
             .otherwise(F.concat(F.col("p_type"), F.lit(" vs "), F.col("p_brand"))))
    intent = F.when(F.col("p_size") % 2 == 0, F.lit(" ")).otherwise(F.lit("comparison"))
    extra = p.select(text.alias("text"), intent.alias("intent"), F.col("p_partkey").alias("ord"))
    return add_adhoc(sel.select(F.col("label").alias("prompt")), extra).select("prompt", "intent", "topic_id")


def _web(spark, sf, as_of=tb.AS_OF):
    recs = tag_topics(tb.page_records(spark, sf), topics_frame(spark, tb.LANG_TOPICS), "query", broadcast=True)
    forum = F.col("platform") == "reddit"
    recs = (recs.withColumn("intent", F.when(forum, F.lit("community")).otherwise(F.col("intent")))
                .withColumn("topic_id", F.when(forum, F.lit("")).otherwise(F.col("topic_id"))))
    return web_snapshot(recs, tb.page_cache(spark, sf), tb.crawled_bodies(spark, sf), R, as_of,
                        verdicts=tb.label_verdicts_by_url(spark, sf), cache_seq="seq")


def q_web_snapshot(spark, sf):
    snap = _web(spark, sf)
    return conform(snap.sheet, T.StructType([*WEB_SCHEMA.fields, T.StructField("verdict_source", T.StringType())]))


def _answers(spark, sf):
    prompts = tb.conversation_prompts(spark, sf)
    manifest = request_manifest(prompts, tb.SURFACES, 2)
    ans = tb.conversation_answers(spark, sf)
    fails = spark.createDataFrame([("perplexity", 2, None, "api 500")],
                                  "surface string, run bigint, prompt string, note string")
    return answer_snapshot(manifest, ans, R, tb.KNOWN_SURFACES, failures=fails)


RUN_COLUMNS = ("status", "mentioned", "competitors_named", "sentiment", "sources_cited", "response_text")
NULLABLE_FLAGS = ("mentioned", "rank", "recommended", "mentions_competition")


def q_answer_snapshot(spark, sf):
    """The 19-column answer sheet; the four columns that are null on blank rows are rendered
    as text ('true'/'false'/'2', null stays null), as the CSV sheet shows them."""
    sheet = answer_sheet(_answers(spark, sf))
    return sheet.select(*[F.col(c).cast("string").alias(c) if c in NULLABLE_FLAGS else F.col(c)
                          for c in sheet.columns])


def q_visibility_rollup(spark, sf):
    return reports.visibility_rollup(_answers(spark, sf))


def q_ownership_rollup(spark, sf):
    return reports.ownership_rollup(_web(spark, sf).sheet)


def q_citation_rollup(spark, sf):
    return reports.citation_rollup(_answers(spark, sf))


def q_snapshot_diff(spark, sf):
    a, b = web_sheet(_web(spark, sf, "2024-01-20")), web_sheet(_web(spark, sf, "2024-01-24"))
    return reports.snapshot_diff(a, b, ["url"]).select("url", "change", "changed_columns")


def q_answer_runs_diff(spark, sf):
    """R3 on keys that repeat: what two assistants answered to the same prompts, each as often as it was asked."""
    sheet = answer_sheet(_answers(spark, sf)).select("surface", "prompt", *RUN_COLUMNS)
    one, other = (sheet.where(F.col("surface") == x).drop("surface") for x in ("chatgpt", "perplexity"))
    return reports.snapshot_diff(one, other, ["prompt"])


def q_score_against_gold(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text")
    pred = d.select("doc_id", (F.size(brands_in(F.col("text"), list(R.competitor_brands))) > 0)
                    .alias("mentions_competition"), mentions_brand(F.col("text"), R).alias("mentions_brand"))
    gold = _t(spark, sf, "labels").select("doc_id", (F.col("toxic") == 1).alias("mentions_competition"),
                                          (F.col("quality") == 1).alias("mentions_brand"))
    return reports.score_against_gold(pred, gold, "doc_id", ["mentions_competition", "mentions_brand"])


def q_gold_agreement(spark, sf):
    """R4 with abstentions: no vote on brand texts that name a competitor; the number of prices seen stands for a rank."""
    d = _t(spark, sf, "documents").select("doc_id", "text", F.size(prices_seen(F.col("text"), R)).cast("bigint").alias("rank"))
    comps, own = F.size(brands_in(F.col("text"), list(R.competitor_brands))) > 0, mentions_brand(F.col("text"), R)
    pred = d.select("doc_id", comps.alias("mentions_competition"), F.when(~comps, own).alias("mentions_brand"), F.when(own, F.col("rank")).alias("rank"))
    lab = _t(spark, sf, "labels")
    gold = lab.select("doc_id", (F.col("toxic") == 1).alias("mentions_competition"), (F.col("quality") == 1).alias("mentions_brand"),
                      F.col("quality").cast("bigint").alias("rank"))
    return reports.gold_agreement(pred, gold.unionByName(gold), "doc_id", ["mentions_competition", "mentions_brand"], ["rank"])


def _demo_scorer(batch: pd.DataFrame) -> pd.DataFrame:
    """A deterministic scorer standing in for a model: it reports a failure for texts containing 'zz' and
    leaves out the optional fields."""
    low = batch["text"].str.lower()
    return pd.DataFrame({
        "key": batch["key"],
        "says_about_brand": "Scored " + batch["text"].str.len().astype(str) + " chars.",
        "mentions_competition": low.str.contains("there", regex=False),
        "error": batch["text"].str.contains("zz", regex=False).map({True: "no answer", False: None}),
        "competitors_named": [["There"] if x else [] for x in low.str.contains("there", regex=False)],
        "sentiment": 0.5,
    })


def q_scored_verdicts(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text").withColumn("key", F.col("doc_id").cast("string"))
    v = score_batches(d.where(F.col("text") != ""), _demo_scorer, WEB_VERDICT, "key", "text")
    df = with_text_labels(d, R, "text")
    m = merge_verdicts(df, v, "key", web_fallback("text", R), use_verdict=(F.col("text") != ""))
    return m.select("doc_id", "verdict_source", "says_about_brand", "mentions_competition",
                    F.coalesce(F.array_join("competitors_named", "; "), F.lit("")).alias("competitors_named"),
                    "sentiment")


def _two_scored_runs(spark, sf):
    """A ledger after a run over the documents and one over documents and conversations, and the second run's verdicts."""
    docs = _t(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("key"), "text")
    turns = _t(spark, sf, "conversations").select(F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("key"), "text")
    path = f"{shared_scratch(spark)}/ledger-{new_run_id()}"
    score_with_ledger(docs, _demo_scorer, path, WEB_VERDICT, "demo-1")
    return path, score_with_ledger(docs.unionByName(turns), _demo_scorer, path, WEB_VERDICT, "demo-1", retry_failed=False)


def q_ledger_verdicts(spark, sf):
    """V1 by content: verdicts of a second run, which asks only for texts that the first did not."""
    return _two_scored_runs(spark, sf)[1].select("key", "score_status", "says_about_brand", "mentions_competition", "sentiment")


def q_ledger_entries(spark, sf):
    """What was paid for in two runs: one entry for each distinct text."""
    path, _ = _two_scored_runs(spark, sf)
    return read_ledger(spark, path, WEB_VERDICT).groupBy("score_status").agg(F.count(F.lit(1)).alias("entries"), F.count_distinct("fingerprint").alias("texts"))


def _topics(spark):
    return topics_frame(spark, tb.LANG_TOPICS)


def q_serp_records(spark, sf):
    items = tb.parse_lines(tb.serp_lines(spark, sf), SERP_ITEM)
    return readers.serp_records(items, _topics(spark), "web", True, broadcast_topics=True).select(
        *REC, F.col("seq.item.row").alias("item"), "seq.kind", "seq.pos")


def q_news_records(spark, sf):
    items = tb.parse_lines(tb.serp_lines(spark, sf), SERP_ITEM)
    return readers.serp_records(items, _topics(spark), "news", False, broadcast_topics=True).select(
        *REC, F.col("seq.item.row").alias("item"), "seq.kind", "seq.pos")


def q_ad_records(spark, sf):
    items = tb.parse_lines(tb.ad_lines(spark, sf), AD_ITEM)
    return readers.ad_records(items, R).select("url", "title", "snippet", "advertiser", "ownership", F.col("seq.item.row").alias("item"))


def q_forum_records(spark, sf):
    items = tb.parse_lines(tb.forum_lines(spark, sf), FORUM_ITEM)
    return readers.forum_records(items).select("url", "title", "snippet", F.col("seq.item.row").alias("item"))


def q_page_bodies(spark, sf):
    return readers.page_bodies(tb.parse_lines(tb.content_lines(spark, sf), CONTENT_ITEM)).select("url", "text")


def q_answer_items(spark, sf):
    a = readers.answer_items(tb.parse_lines(tb.answer_lines(spark, sf), ANSWER_ITEM))
    return a.select("surface", "run", "prompt", "response", F.array_join("citations", ", ").alias("citations"), F.col("seq.row").alias("item"))


def q_answer_api_items(spark, sf):
    a = readers.answer_api_items(tb.parse_lines(tb.answer_api_lines(spark, sf), ANSWER_API_ITEM))
    return a.select("surface", "run", "prompt", "response", F.array_join("citations", ", ").alias("citations"), F.col("seq.row").alias("item"))


def q_nonprod_cited(spark, sf):
    return reports.nonprod_cited(_answers(spark, sf), R)


def q_competitor_share(spark, sf):
    return reports.competitor_share(_answers(spark, sf))


def q_ownership_branches(spark, sf):
    """Padded app-store and marketplace links through the web classification's ownership rule."""
    u = tb.app_and_market_urls(spark, sf).withColumn("url", strip_ws("url"))
    return label_ownership(u, R, "url").select("page_id", "url", "ownership")


def q_topics_catalog(spark, sf):
    """A catalog landed as JSON lines (some without a query) and read back."""
    p = _t(spark, sf, "part")
    topic = F.struct(F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_type").alias("intent"),
                     F.when(F.col("p_size") % 7 != 0, F.col("p_name")).alias("query"))
    path = tb.land(p.select(F.to_json(topic).alias("line")), "topics")
    return read_topics(spark, path, multiline=False).select("id", "intent", "query")


def q_merged_bodies(spark, sf):
    """Cached bodies of the requests beside all crawled ones."""
    plan = plan_fetch(_requests(spark, sf), tb.page_cache(spark, sf), tb.AS_OF, seq="seq")
    return merge_bodies(plan.hits, tb.crawled_bodies(spark, sf))


def q_landed_discovery(spark, sf):
    """All discovery sources, landed as files, read by their readers and united."""
    serp = tb.land(tb.serp_lines(spark, sf), "serp")
    web = readers.read_serp(spark, serp, _topics(spark), broadcast_topics=True)
    news = readers.read_news(spark, tb.land(tb.landed(spark, serp), "news"), _topics(spark), broadcast_topics=True)
    ads = readers.read_ads(spark, tb.land(tb.ad_lines(spark, sf), "ads"), R)
    forum = readers.read_forum(spark, tb.land(tb.forum_lines(spark, sf), "reddit"))
    return readers.union_discovery(web, news, ads, forum).select(*REC, "ownership", "source_ord", "seq.kind", "seq.pos")


def q_landed_pages(spark, sf):
    """S7 through its reader, with a URL of its own for every item."""
    item = F.from_json("line", CONTENT_ITEM)
    own = F.concat(F.lit("https://crawl.test/"), F.col("item_seq").cast("string"))
    lines = tb.content_lines(spark, sf).select(F.to_json(F.struct(own.alias("url"), item["markdown"].alias("markdown"),
                                                                  item["text"].alias("text"))).alias("line"))
    return readers.read_pages(spark, tb.land(lines, "pages")).select("url", "text")


def q_landed_answers(spark, sf):
    """S8 and S9 through their readers."""
    a = readers.read_answers(spark, tb.land(tb.answer_lines(spark, sf), "answers"))
    b = readers.read_answer_api(spark, tb.land(tb.answer_api_lines(spark, sf), "answer_api"))
    return a.unionByName(b).select("surface", "run", "prompt", "response", F.array_join("citations", ", ").alias("citations"))


def q_web_csv(spark, sf):
    """The web sheet written as CSV and read back."""
    path = f"{shared_scratch(spark)}/web-{new_run_id()}"
    write_web(_web(spark, sf).sheet, path)
    return read_sheet(spark, path, WEB_SCHEMA)


def q_answers_csv(spark, sf):
    """The sorted answer sheet written as CSV and read back."""
    path = f"{shared_scratch(spark)}/answers-{new_run_id()}"
    write_answers(_answers(spark, sf), path)
    sheet = read_sheet(spark, path, LLM_SCHEMA)
    return sheet.select(*[F.col(c).cast("string").alias(c) if c in NULLABLE_FLAGS else F.col(c) for c in sheet.columns])


def q_run_written(spark, sf):
    """A run written with its counters; an empty run writes nothing."""
    out, rid = f"{shared_scratch(spark)}/runs-{new_run_id()}", new_run_id()
    sheet = _web(spark, sf).sheet
    empty = write_snapshot(sheet.limit(0), out, "web", "empty", guard=sheet.limit(0))
    write_snapshot(sheet, out, "web", rid, {"empty_written": str(empty).lower()}, guard=_t(spark, sf, "pages"))
    keys = ["count.rows", "count.source_web", "count.source_news", "count.source_reddit", "count.nonprod", "count.fetch_cache", "empty_written"]
    return spark.read.parquet(f"{out}/run_meta").where(F.col("key").isin(*keys)).select("key", "value")


def q_repeated_verdicts(spark, sf):
    """J5 with several landed verdicts for a key: the last counts, and no row is multiplied."""
    lab = _t(spark, sf, "labels").withColumn("key", (F.col("doc_id") % 50).cast("string"))
    v = tb.label_verdict_columns(lab).withColumnRenamed("doc_id", "seq")
    d = _t(spark, sf, "documents").select("doc_id", "text", (F.col("doc_id") % 100).cast("string").alias("key"))
    m = merge_verdicts(with_text_labels(d, R, "text"), v, "key", web_fallback("text", R))
    return m.select("doc_id", "verdict_source", "says_about_brand")


def q_run_counters(spark, sf):
    return reports.run_counters(_web(spark, sf).sheet)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: which pages, per canonical URL, belong to whom and on what host (sf0.001)."""
    sf = "/root/testdata/sf0.001"
    recs = tb.page_records(spark, sf).withColumn("raw_url", F.col("url")).withColumn("url", canonical_url("url"))
    best = dedupe_best(recs, "url").withColumn("host", host_of("url"))
    best = label_ownership(best, R, "raw_url", "host")
    return with_nonprod(best, R).select("url", "host", "platform", "rank", "ownership", "nonprod_url")


def _llm() -> tuple[dict, dict]:
    """Queries and oracles of the llm subpackage and its pipeline, as far as they can be imported."""
    try:
        from sourcelens.llm.queries import oracles, queries as llm_queries
    except ImportError:
        return {}, {}
    qs, sql = llm_queries(), oracles()
    try:
        import corpus_pipeline
    except ImportError:
        return qs, sql
    qs["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return qs, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | _llm()[0]


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "canonical_urls": q_canonical_urls,
        "dedupe_best": q_dedupe_best,
        "ownership_labels": q_ownership_labels,
        "ownership_suffix_join": q_ownership_suffix_join,
        "ownership_domain_table": q_ownership_domain_table,
        "nonprod_flags": q_nonprod_flags,
        "nonprod_report": q_nonprod_report,
        "claim_flags": q_claim_flags,
        "brands_in": q_brands_in,
        "brand_mentions_long": q_brand_mentions_long,
        "price_mentions": q_price_mentions,
        "price_brand_top5": q_price_brand_top5,
        "outbound_links": q_outbound_links,
        "link_table": q_link_table,
        "richer_text": q_richer_text,
        "cache_fresh": q_cache_fresh,
        "cache_split": q_cache_split,
        "cache_upsert": q_cache_upsert,
        "topic_tag": q_topic_tag,
        "props_json": q_props_json,
        "request_manifest": q_request_manifest,
        "error_rows": q_error_rows,
        "answer_status": q_answer_status,
        "verdict_merge": q_verdict_merge,
        "citations_merge": q_citations_merge,
        "catalog_select": q_catalog_select,
        "catalog_select_table": q_catalog_select_table,
        "adhoc_prompts": q_adhoc_prompts,
        "web_snapshot": q_web_snapshot,
        "answer_snapshot": q_answer_snapshot,
        "visibility_rollup": q_visibility_rollup,
        "ownership_rollup": q_ownership_rollup,
        "citation_rollup": q_citation_rollup,
        "snapshot_diff": q_snapshot_diff,
        "score_against_gold": q_score_against_gold,
        "scored_verdicts": q_scored_verdicts,
        "serp_records": q_serp_records,
        "news_records": q_news_records,
        "ad_records": q_ad_records,
        "forum_records": q_forum_records,
        "page_bodies": q_page_bodies,
        "answer_items": q_answer_items,
        "answer_api_items": q_answer_api_items,
        "run_counters": q_run_counters,
        "nonprod_cited": q_nonprod_cited,
        "competitor_share": q_competitor_share,
        "ownership_branches": q_ownership_branches,
        "topics_catalog": q_topics_catalog,
        "merged_bodies": q_merged_bodies,
        "landed_discovery": q_landed_discovery,
        "landed_pages": q_landed_pages,
        "landed_answers": q_landed_answers,
        "web_csv": q_web_csv,
        "answers_csv": q_answers_csv,
        "run_written": q_run_written,
        "repeated_verdicts": q_repeated_verdicts,
        "ledger_verdicts": q_ledger_verdicts,
        "ledger_entries": q_ledger_entries,
        "answer_runs_diff": q_answer_runs_diff,
        "catalog_mentions": q_catalog_mentions,
        "catalog_brands": q_catalog_brands,
        "gold_agreement": q_gold_agreement,
    }


def oracle_sql() -> dict[str, str]:
    from oracles import oracle_queries
    return oracle_queries() | _llm()[1]
