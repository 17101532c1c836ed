"""Outbound links (F4, F5) in array form and long form, and brand mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcelens.functions.text import brand_hit
from sourcelens.functions.urls import host_of, outbound_links
from sourcelens.rules import BrandRules


def with_outbound_links(df: DataFrame, rules: BrandRules, text: str = "text", page_url: str = "url",
                        out: str = "links", cap: int | None = None) -> DataFrame:
    """F5 array form: one array column per page."""
    return df.withColumn(out, outbound_links(F.col(text), F.col(page_url), rules, cap))


def link_table(df: DataFrame, rules: BrandRules, key: str = "page_id", text: str = "text",
               page_url: str = "url", cap: int | None = None) -> DataFrame:
    """F5 long form: (key, link_pos, link_url, link_host) edges, one row per kept link.

    The ordered-distinct cut happens inside each row (all links of a body live in one
    row), so the long form is a narrow ``posexplode``: no shuffle, no window.
    """
    links = outbound_links(F.col(text), F.col(page_url), rules, cap)
    return (df.select(F.col(key), F.posexplode(links).alias("link_pos", "link_url"))
              .withColumn("link_pos", F.col("link_pos") + 1)
              .withColumn("link_host", host_of(F.col("link_url"))))


def brand_mentions(df: DataFrame, brands, key: str = "doc_id", text: str = "text",
                   word_boundary: bool = False) -> DataFrame:
    """J11 long form: one (key, brand_pos, brand) row per brand named in the text, where
    ``brand_pos`` is the brand's 1-based position in the brand list.

    Built as an explode of a fixed-size array of (position, brand-or-null) structs and a
    filter, rather than a join: no pairs are formed, and the brand list (configuration)
    is compiled into the projection."""
    lt = F.col("_lt")   # lower-cased once per row: the when branches share no subexpression
    hits = F.array(*[F.struct(F.lit(i + 1).alias("brand_pos"),
                              F.when(brand_hit(lt, b, word_boundary), F.lit(b)).alias("brand"))
                     for i, b in enumerate(brands)])
    return (df.select(key, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_lt"))
              .select(key, F.inline(hits))
              .where(F.col("brand").isNotNull()))
