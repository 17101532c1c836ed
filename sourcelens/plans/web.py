"""Web track: classify records into sheet rows (E1) and the composed snapshot plan."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcelens.functions.text import best_text, nullif_empty
from sourcelens.functions.urls import canonical_url, host_of, is_nonprod, outbound_links, strip_ws
from sourcelens.operators.dedupe import dedupe_best
from sourcelens.operators.fetch import unique_bodies
from sourcelens.operators.ownership import (domain_table, long_lists, nonprod_of_match, ownership, ownership_of_match,
                                            with_domain_match)
from sourcelens.operators.verdicts import (merge_verdicts, persist_scores, score_batches, web_fallback,
                                           with_text_labels)
from sourcelens.rules import BrandRules
from sourcelens.schemas import WEB_SCHEMA, WEB_VERDICT
from sourcelens.session import cut_lineage
from sourcelens.sources.cache import EXPECTED_URLS, cache_fresh, cache_upsert, requested_only
from sourcelens.sources.ledger import score_with_ledger, scorer_name
from sourcelens.sources.sinks import conform

LABEL_COLUMNS = ("stale", "prices_seen", "comps")


def classify_web(records: DataFrame, verdicts: DataFrame | None, rules: BrandRules, body: str = "body",
                 raw_url: str | None = "raw_url", keep: tuple[str, ...] = ()) -> DataFrame:
    """One sheet row per record: claims, prices, brands, links, ownership, non-production
    flag and the verdict (model verdict by URL when the body is non-empty, else the
    whole rule-based fallback).  One join (verdicts); ownership and the non-production flag are expressions over a few
    domains, and broadcast look-ups where the rules list many.  Lists stay arrays: the sink joins them to text."""
    df = with_text_labels(records, rules, body)
    b = F.coalesce(F.col(body), F.lit(""))
    df = merge_verdicts(df, verdicts, "url", web_fallback(body, rules), use_verdict=(b != ""))
    label_url = F.coalesce(nullif_empty(strip_ws(F.col(raw_url))), F.col("url")) if raw_url and raw_url in records.columns \
        else F.col("url")
    preset = nullif_empty(F.col("ownership")) if "ownership" in records.columns else F.lit(None)
    if long_lists(rules):
        domains = domain_table(df.sparkSession, rules)
        df = df.withColumns({"_label_host": host_of(label_url), "_host": host_of(F.col("url"))})
        df = with_domain_match(with_domain_match(df, domains, "_label_host", "_l_"), domains, "_host", "_h_")
        owner, nonprod = ownership_of_match(label_url, F.col("_label_host"), rules, "_l_"), nonprod_of_match(F.col("_host"), rules, "_h_")
    else:
        owner, nonprod = ownership(label_url, host_of(label_url), rules), is_nonprod(host_of(F.col("url")), rules)
    out = df.select(
        F.col("platform").alias("source"), "url",
        F.coalesce(F.col("query"), F.lit("")).alias("query"),
        F.coalesce(F.col("intent"), F.lit("")).alias("intent"),
        F.coalesce(F.col("topic_id"), F.lit("")).alias("topic_id"),
        F.coalesce(preset, owner).alias("ownership"),
        F.coalesce(F.col("says_about_brand"), F.lit("")).alias("says_about_brand"),
        F.coalesce(F.col("mentions_competition"), F.lit(False)).alias("mentions_competition"),
        F.coalesce(F.col("competition_summary"), F.lit("")).alias("competition_summary"),
        F.coalesce(F.col("competitors_named"), F.array().cast("array<string>")).alias("competitors_named"),
        F.coalesce(F.col("sentiment"), F.lit(0.0)).alias("sentiment"),
        F.coalesce(nullif_empty(F.col("price_mentioned")), F.get(F.col("prices_seen"), 0)).alias("price"),
        outbound_links(b, F.col("url"), rules).alias("links_on_source"),
        nonprod.alias("nonprod_url"),
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        "verdict_source", *LABEL_COLUMNS, *keep)
    return out


@dataclass
class WebSnapshot:
    sheet: DataFrame          # 15 sheet columns + verdict_source, fetch_status (cache/crawl/missing/none), labels
    crawl_list: DataFrame     # url: records to crawl (cache misses)
    crawled: DataFrame | None  # url, text: landed bodies of the crawl list, to be stored (``append_cache``)
    scores: DataFrame | None  # the scorer's rows with their status, if a scorer ran
    _next_cache: Callable[[], DataFrame]

    @property
    def cache_next(self) -> DataFrame:
        """The cache after upserting the crawled bodies, as one frame; built on first use, so runs that only need
        the sheet do not plan it."""
        if not hasattr(self, "_cache_next_df"):
            self._cache_next_df = self._next_cache()
        return self._cache_next_df


def web_snapshot(discovery: DataFrame, cache: DataFrame, crawled: DataFrame | None, rules: BrandRules, as_of,
                 verdicts: DataFrame | None = None, scorer: Callable | None = None,
                 checkpoint: bool = False, cache_seq: str | None = None, label_from_raw: bool = True,
                 first_seen: bool = True, ledger: str | None = None, scorer_id: str | None = None,
                 expected_urls: int = EXPECTED_URLS) -> WebSnapshot:
    """Union of sources -> canonical URL -> best record per URL -> cache hits / crawl list
    -> bodies (crawled wins) -> richer of body and snippet -> E1.

    Ownership is labelled from the raw record URL (app-store ``?id=`` survives);
    ``label_from_raw=False`` labels from the canonical URL as the reference does.  With
    ``first_seen`` the sheet carries each URL's first appearance, the order the reference
    writes its sheet in (``write_web`` sorts by it).

    ``crawled`` is the landed crawl (``read_pages``); only its bodies for this run's crawl
    list (cache misses) are used and stored; ``cache_seq``
    orders cache rows of equal URL and date (last wins); when a
    ``scorer`` is given, verdicts come from V1 over the non-empty bodies: with a ``ledger`` folder equal texts are
    scored once and texts scored by an earlier or failed run not again.  Shuffles: the
    dedupe (by URL), the cache/body joins (by URL) and the verdict join (by URL) - all on
    the same key, so AQE can keep one partitioning.
    """
    recs = (discovery.withColumn("raw_url", F.col("url"))
                     .withColumn("url", canonical_url(F.col("url"))))
    best = dedupe_best(recs, "url", first_seen=first_seen)
    # E5 folded into the record plan: the fresh cache and the crawl join straight onto the
    # deduped records (both on url, the key the dedupe already partitioned by), so the
    # dedupe runs once for the sheet and the crawl list alike.
    asked = requested_only(cache, recs.select("url"), expected_urls=expected_urls)   # bodies that no record names stay unsorted
    fresh = cache_fresh(asked, as_of, seq=cache_seq).select("url", F.col("text").alias("_cached"))
    j = best.join(fresh, "url", "left")
    miss = F.col("url").startswith("http") & F.col("_cached").isNull()
    if crawled is not None:
        j = j.join(unique_bodies(crawled).select("url", F.col("text").alias("_crawled")), "url", "left")
        body = F.when(miss, F.col("_crawled")).otherwise(F.col("_cached"))
    else:
        body = F.col("_cached")
    crawled_body = F.col("_crawled").isNotNull() if crawled is not None else F.lit(False)
    fetch = (F.when(F.col("_cached").isNotNull(), F.lit("cache"))
              .when(miss & crawled_body, F.lit("crawl"))
              .when(miss, F.lit("missing"))
              .otherwise(F.lit("none")))
    j = j.withColumn("_miss", miss).withColumn("fetch_status", fetch)
    enriched = j.withColumn("body", best_text(body, F.col("snippet"))).drop("_cached", "_crawled")
    if checkpoint:  # once, for the sheet, the crawl list, the scorer and the cache
        enriched = cut_lineage(enriched)
    crawl_list = enriched.where(F.col("_miss")).select("url")
    enriched = enriched.drop("_miss")
    scores = None
    if scorer is not None and verdicts is None:
        labelled = with_text_labels(enriched.where(F.col("body") != ""), rules, "body")
        hints = tuple(rules.claim_names) + ("current_signal", "prices_seen")
        if ledger is not None:
            verdicts = scores = score_with_ledger(labelled, scorer, ledger, WEB_VERDICT, scorer_id or scorer_name(scorer), "url", "body", hints)
        else:
            verdicts = scores = persist_scores(score_batches(labelled.withColumnRenamed("url", "key"), scorer, WEB_VERDICT,
                                                             "key", "body", hints))
    keep = ("fetch_status", "first_seen") if first_seen else ("fetch_status",)
    sheet = classify_web(enriched, verdicts, rules, "body", raw_url="raw_url" if label_from_raw else None,
                         keep=keep)
    used = crawled.select("url", "text").join(crawl_list, "url", "left_semi") if crawled is not None else None

    def next_cache() -> DataFrame:
        return cache_upsert(cache, used, as_of)
    return WebSnapshot(sheet=sheet, crawl_list=crawl_list, crawled=used, scores=scores, _next_cache=next_cache)


def web_sheet(snapshot: WebSnapshot) -> DataFrame:
    """The 15 columns as written: lists joined to text."""
    return conform(snapshot.sheet, WEB_SCHEMA)
