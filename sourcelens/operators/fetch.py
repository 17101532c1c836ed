"""Fetch planning against the page cache."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcelens.functions.text import best_text
from sourcelens.operators.dedupe import last_by_key
from sourcelens.sources.cache import EXPECTED_URLS, cache_fresh, requested_only
from sourcelens.rules import CACHE_TTL_DAYS


def crawlable(df: DataFrame, url: str = "url") -> DataFrame:
    """Only http(s) URLs are fetched; pseudo-URLs (``aioverview::...``) never are."""
    return df.where(F.col(url).startswith("http"))


@dataclass
class FetchPlan:
    hits: DataFrame     # url, text       (J2: served from the fresh cache)
    misses: DataFrame   # url             (J3: the crawl list)


def split_cache(urls: DataFrame, fresh: DataFrame, url: str = "url") -> FetchPlan:
    """Requested URLs with a fresh cache entry (inner join) and without (left anti).
    Hits and misses partition the crawlable requests."""
    req = crawlable(urls.select(F.col(url).alias("url")).distinct())
    cache = fresh.select("url", "text")
    return FetchPlan(hits=req.join(cache, "url", "inner"), misses=req.join(cache, "url", "left_anti"))


def merge_bodies(hits: DataFrame, crawled: DataFrame | None) -> DataFrame:
    """Cached bodies plus crawled bodies; a crawled body wins for the same URL."""
    if crawled is None:
        return hits.select("url", "text")
    c = crawled.select("url", F.col("text").alias("_crawled"))
    return (hits.select("url", "text").join(c, "url", "full_outer")
                .select("url", F.coalesce(F.col("_crawled"), F.col("text")).alias("text")))


def plan_fetch(urls: DataFrame, cache: DataFrame, as_of, ttl: int = CACHE_TTL_DAYS,
               seq: str | None = None, expected_urls: int = EXPECTED_URLS) -> FetchPlan:
    """E5: fresh cache scan (partition-pruned on ``fetch_date``), cut down to the requested URLs before anything moves, then hit/miss split."""
    return split_cache(urls, cache_fresh(requested_only(cache, urls.select("url"), expected_urls=expected_urls), as_of, ttl, seq))


def unique_bodies(bodies: DataFrame, url: str = "url") -> DataFrame:
    """(url, text), one row for each URL: the last by ``seq`` where the frame has it, else the greatest text, so that a re-run picks the
    same.  Bodies that are already cut to one a URL (``read_pages``) keep their partitioning: this adds no shuffle to them."""
    order = F.col("seq") if "seq" in bodies.columns else F.coalesce(F.col("text"), F.lit(""))
    return last_by_key(bodies.select(F.col(url).alias("url"), "text", order.alias("_order")), "url", "_order").drop("_order")


def enrich(records: DataFrame, bodies: DataFrame, url: str = "url", snippet: str = "snippet",
           out: str = "body") -> DataFrame:
    """J4 + F7: attach the page body ('' when missing) and choose the richer of body and snippet.  A record stays one row however many
    bodies its URL has."""
    b = unique_bodies(bodies).select(F.col("url").alias("_burl"), F.col("text").alias("_body"))
    j = records.join(b, records[url] == b["_burl"], "left").drop("_burl")
    return j.withColumn(out, best_text(F.col("_body"), F.col(snippet))).drop("_body")
