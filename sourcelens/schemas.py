"""Declared schemas (section 1.3 of the survey) and the two sheet contracts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

S, B, L, D = T.StringType(), T.BooleanType(), T.LongType(), T.DoubleType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Names and order of the two sheets' columns.
WEB_COLUMNS = ["source", "url", "query", "intent", "topic_id", "ownership", "says_about_brand",
               "mentions_competition", "competition_summary", "competitors_named", "sentiment",
               "price", "links_on_source", "nonprod_url", "title"]
LLM_COLUMNS = ["surface", "run", "prompt", "intent", "topic_id", "mentioned", "rank", "recommended",
               "says_about_brand", "mentions_competition", "competition_summary", "competitors_named",
               "sentiment", "price", "sources_cited", "nonprod_url", "response_text",
               "status", "error_note"]

WEB_SCHEMA = _struct(("source", S), ("url", S), ("query", S), ("intent", S), ("topic_id", S),
                     ("ownership", S), ("says_about_brand", S), ("mentions_competition", B),
                     ("competition_summary", S), ("competitors_named", S), ("sentiment", D), ("price", S),
                     ("links_on_source", S), ("nonprod_url", B), ("title", S))
LLM_SCHEMA = _struct(("surface", S), ("run", L), ("prompt", S), ("intent", S), ("topic_id", S),
                     ("mentioned", B), ("rank", L), ("recommended", B), ("says_about_brand", S),
                     ("mentions_competition", B), ("competition_summary", S), ("competitors_named", S),
                     ("sentiment", D), ("price", S), ("sources_cited", S), ("nonprod_url", B),
                     ("response_text", S), ("status", S), ("error_note", S))

# Where a landed record stands: files by modification time, then path, then place in the file.
LANDING = _struct(("landed", T.TimestampType()), ("file", S), ("block", L), ("row", L))


def landing_order():
    """The landing order of a file scan's rows.  Within a block rows are read one after the other, so the row number only has
    to grow; nothing depends on how blocks are packed into tasks."""
    m = F.col("_metadata")
    return F.struct(m["file_modification_time"].alias("landed"), m["file_path"].alias("file"),
                    m["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row"))


def given_order(row):
    """A landing order for records that come from no file: by a number."""
    return F.struct(F.lit(None).cast("timestamp").alias("landed"), F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"),
                    row.cast("bigint").alias("row"))


# A record's place: its item, the kind of record within the item, and its place among those.
PLACE = _struct(("item", LANDING), ("kind", T.IntegerType()), ("pos", T.IntegerType()))

TOPIC = _struct(("id", S), ("intent", S), ("query", S))

ORGANIC = T.ArrayType(_struct(("url", S), ("title", S), ("description", S)))
PANEL = T.ArrayType(_struct(("text", S), ("answer", S)))
# searchQuery and aiOverview may be a string or an object.
SERP_ITEM = _struct(("searchQuery", T.VariantType()), ("organicResults", ORGANIC), ("aiOverview", T.VariantType()), ("aiOverviewText", S),
                    ("chatGptSearchResults", PANEL), ("perplexitySearchResults", PANEL))
AD_ITEM = _struct(("advertiserName", S), ("advertiserId", S), ("creativeId", S), ("format", S), ("url", S),
                  ("previewUrl", S),
                  ("variants", T.ArrayType(_struct(("text", S), ("headline", S), ("description", S), ("body", S)))))
FORUM_ITEM = _struct(("url", S), ("link", S), ("title", S), ("body", S), ("text", S))
CONTENT_ITEM = _struct(("url", S), ("requested_url", S), ("markdown", S), ("text", S))
CITATION = _struct(("url", S), ("title", S), ("source", S), ("snippet", S))
ANSWER_ITEM = _struct(("surface", S), ("run", L), ("prompt", S), ("response", S),
                      ("citations", T.ArrayType(CITATION)), ("error", S))
ANSWER_API_ITEM = _struct(("surface", S), ("run", L), ("prompt", S),
                          ("choices", T.ArrayType(_struct(("message", _struct(("content", S),))))),
                          ("citations", T.ArrayType(S)),
                          ("search_results", T.ArrayType(_struct(("url", S),))),
                          ("error", S))

# Records after discovery (one row per candidate source), before dedupe.
DISCOVERY = _struct(("url", S), ("platform", S), ("query", S), ("intent", S), ("topic_id", S), ("rank", L),
                    ("title", S), ("snippet", S), ("advertiser", S), ("ownership", S), ("source_ord", L),
                    ("seq", PLACE))

PAGE_CACHE = _struct(("url", S), ("text", S), ("fetch_date", T.DateType()))

WEB_VERDICT = _struct(("key", S), ("says_about_brand", S), ("mentions_competition", B),
                      ("competition_summary", S), ("competitors_named", T.ArrayType(S)), ("sentiment", D),
                      ("price_mentioned", S))
ANSWER_VERDICT = _struct(("key", S), ("mentioned", B), ("rank", L), ("recommended", B), ("says_about_brand", S),
                         ("mentions_competition", B), ("competition_summary", S),
                         ("competitors_named", T.ArrayType(S)), ("sentiment", D), ("price_mentioned", S),
                         ("sources_cited", T.ArrayType(S)))
