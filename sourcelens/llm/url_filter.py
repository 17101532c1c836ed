"""URL filter: a blocked Bloom filter of listed keys lets possible hits through to an exact hash join.

What is listed: rules (a host with its subdomains and the start of a path, with a verdict) and
canonical URLs to block.  Both become strings in one filter.  A URL probes the filter with each
``host suffix + path start`` that a rule could have, and with its canonical form; what
passes is joined exactly, so false positives of the filter change nothing.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule and is
allowed; repeated URLs are judged once and joined back to every row; of several rules that fit, the
longest string wins and, at equal length, the greater string; a rule given twice with different
verdicts blocks; empty lists allow everything; columns of the input stay as they are, so its
names must not include ``host``, ``path``, ``rule``, ``verdict``, ``listed`` (these are replaced).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
#: A block has 8 words of 64 bits.  At most so many blocks (16 MB) are broadcast; a longer list
#: makes the filter less selective and the join after it larger, never the result wrong.
MAX_BLOCKS = 1 << 18
#: Rules are configuration; up to so many are broadcast to the exact join, more are shuffled.
MAX_BROADCAST_RULES = 100_000
WORDS = [f"w{j}" for j in range(8)]


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host and path without trailing slashes; scheme, query and fragment don't count."""
    return F.concat(host, F.regexp_replace(path, "/+$", ""))


def _hashed(keys: DataFrame, blocks: int) -> DataFrame:
    return keys.withColumns({"block": F.pmod(F.xxhash64("key"), F.lit(blocks)),
                             "bits": F.xxhash64("key", F.lit(1))})


def _bit(j: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"),
                           F.shiftright("bits", 6 * j).bitwiseAND(F.lit(63)).cast("int"))


def bloom_blocks(keys: DataFrame, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """Column ``key`` -> rows (block, w0..w7) of the filter, one bit per word and key, and the number of blocks."""
    need = max(1, keys.count() * BITS_PER_KEY // 512)
    blocks = min(max_blocks, 1 << (need - 1).bit_length())
    return _hashed(keys, blocks).groupBy("block").agg(*[F.bit_or(_bit(j)).alias(w) for j, w in enumerate(WORDS)]), blocks


def bloom_pass(probes: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """The probes that the filter may hold.  The filter's size is bounded by ``MAX_BLOCKS``, so it is broadcast."""
    hit = F.lit(True)
    for j, w in enumerate(WORDS):
        hit = hit & (F.col(w).bitwiseAND(_bit(j)) != 0)
    return (_hashed(probes, blocks).join(F.broadcast(filter_), "block").where(hit)
            .drop("block", "bits", *WORDS))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: DataFrame | None = None,
               url: str = "url", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``pages`` plus host, path, rule, verdict, listed.  ``rules``: (verdict, host, path) triples;
    ``listed``: a frame whose column ``canon`` holds canonical URLs to block where no rule fits."""
    spark = pages.sparkSession
    pages = pages.drop(*({"host", "path", "rule", "verdict", "listed"} - {url}))
    urls = (pages.select(F.col(url).alias("_u")).where(F.col("_u").isNotNull()).distinct()
            .withColumns({"host": url_host(F.col("_u")), "path": url_path(F.col("_u"))}))
    rule_rows = spark.createDataFrame([(f"r:{h}{p}", f"{h}{p}", v) for v, h, p in rules],
                                      "key string, rule string, verdict string")
    rule_rows = rule_rows.groupBy("key", "rule").agg(F.max("verdict").alias("verdict"))
    exact = rule_rows.withColumn("listed", F.lit(False))
    if listed is not None:
        exact = exact.unionByName(listed.where(F.col("canon") != "").select(F.concat(F.lit("u:"), "canon").alias("key")).distinct()
                                  .withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("block"), "listed": F.lit(True)}))
    filter_, blocks = bloom_blocks(exact.select("key"), max_blocks)

    starts = sorted({len(p) for _, _, p in rules})  # every rule's path is a start of one of these lengths
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))

    def rule_keys(n: int) -> Column:
        return F.transform("suffixes", lambda s: F.when(F.length("path") >= n, F.concat(F.lit("r:"), s, F.left("path", F.lit(n)))))

    keys = [rule_keys(n) for n in starts]
    keys.append(F.array(F.concat(F.lit("u:"), canonical(F.col("host"), F.col("path")))))
    probes = (urls.where(F.col("host") != "").withColumn("suffixes", suffixes)
              .select("_u", F.explode(F.concat(*keys)).alias("key")).where(F.col("key").isNotNull()))
    hits = bloom_pass(probes, filter_, blocks)

    # exact: the few rules as a broadcast of checked size, listed URLs by a shuffled join
    rule_side = F.broadcast(rule_rows) if len(rules) <= MAX_BROADCAST_RULES else rule_rows
    found = hits.where(F.col("key").startswith("r:")).join(rule_side, "key").select("_u", "rule", "verdict", F.lit(False).alias("listed"))
    if listed is not None:
        found = found.unionByName(hits.where(F.col("key").startswith("u:")).join(exact.where("listed"), "key")
                                  .select("_u", "rule", "verdict", "listed"))
    best = (found.groupBy("_u").agg(
        F.max_by(F.struct("rule", "verdict"),
                 F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("n"), F.col("rule")))).alias("r"),
        F.max("listed").alias("listed")))
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("listed"), F.lit("block")), F.lit("allow"))
    judged = urls.join(best, "_u", "left").select("_u", F.col("r.rule").alias("rule"), verdict.alias("verdict"),
                                                  F.coalesce("listed", F.lit(False)).alias("listed"))
    out = pages.join(judged, pages[url] == judged["_u"], "left").drop("_u")
    return out.withColumns({"host": F.coalesce(url_host(F.col(url)), F.lit("")), "path": url_path(F.col(url)),
                            "verdict": F.coalesce("verdict", F.lit("allow")), "listed": F.coalesce("listed", F.lit(False))})
