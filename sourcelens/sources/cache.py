"""Page cache (S11, S12, J6): a Parquet table ``url, text, fetch_date`` partitioned by
``fetch_date`` so the TTL filter prunes whole partitions at the scan.

A run appends the pages it crawled to its day's partition; the newest entry of a URL wins at read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sourcelens.operators.dedupe import last_by_key
from sourcelens.rules import CACHE_TTL_DAYS
from sourcelens.schemas import LANDING, PAGE_CACHE, landing_order


def _as_date(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, (dt.date, dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(as_of).cast("date")


def cache_fresh(cache: DataFrame, as_of, ttl: int = CACHE_TTL_DAYS, seq: str | None = None) -> DataFrame:
    """Entries fetched within ``ttl`` days of ``as_of``; null text -> ''; one row per URL
    (the newest; among equal dates the last by ``seq``)."""
    fresh = (cache.where(F.col("fetch_date") >= F.date_sub(_as_date(as_of), ttl))
                  .withColumn("text", F.coalesce(F.col("text"), F.lit(""))))
    order = fresh.withColumn("_ord", F.struct(F.col("fetch_date"), F.col(seq) if seq else F.lit(0)))
    return last_by_key(order, "url", "_ord").drop("_ord")


def cache_upsert(cache: DataFrame, new: DataFrame | None, as_of, ttl: int = CACHE_TTL_DAYS) -> DataFrame:
    """S12 + J6: rows of ``cache`` whose URL is in ``new`` are replaced by ``new`` (stamped
    ``as_of``); rows older than ``2 * ttl`` days are evicted.  An empty (or None) batch only evicts."""
    day = _as_date(as_of)
    if new is None:
        return cache.select("url", "text", "fetch_date").where(F.col("fetch_date") >= F.date_sub(day, 2 * ttl))
    batch = new.select("url", F.coalesce(F.col("text"), F.lit("")).alias("text"), day.alias("fetch_date"))
    kept = cache.select("url", "text", "fetch_date").join(batch.select("url"), "url", "left_anti")
    return (kept.unionByName(batch)
                .where(F.col("fetch_date") >= F.date_sub(day, 2 * ttl)))


# ---------------------------------------------------------------------------
# reduction: only what a run asks for is sorted and moved
# ---------------------------------------------------------------------------
#: Requested URLs for which the filter is made (16 bits each), and the most: 4 million words, some 64 MB when broadcast.
EXPECTED_URLS = 1_000_000
MAX_EXPECTED_URLS = 16_000_000
_WORD_BITS, _BITS_PER_URL = 64, 16


def _word_and_bits(url: str, words: int) -> tuple[Column, Column]:
    """A URL's word of the filter and its three bits there, all taken from one hash."""
    h = F.xxhash64(F.lit("cache"), F.col(url))
    bit = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(3)]
    return F.pmod(F.shiftrightunsigned(h, 18), F.lit(words)), bit[0].bitwiseOR(bit[1]).bitwiseOR(bit[2])


def requested_only(cache: DataFrame, urls: DataFrame, url: str = "url", expected_urls: int = EXPECTED_URLS) -> DataFrame:
    """The rows of ``cache`` whose URL may be among ``urls``: all that are, and about one in two hundred others.

    A Bloom filter of the URLs is put together by a partial aggregate (64-bit words, three bits a URL in one of them) and broadcast; its size is fixed by
    ``expected_urls``, not by the data.  The cache meets it in the scan's stage, so bodies that no request names are neither sorted nor shuffled.  More URLs than
    expected only let more rows pass."""
    words = max(1, min(expected_urls, MAX_EXPECTED_URLS) * _BITS_PER_URL // _WORD_BITS)
    word, bits = _word_and_bits(url, words)
    filter_ = urls.groupBy(word.alias("_word")).agg(F.bit_or(bits).alias("_bits"))
    own_word, own_bits = _word_and_bits("url", words)
    kept = cache.join(F.broadcast(filter_), own_word == F.col("_word")).where(F.col("_bits").bitwiseAND(own_bits) == own_bits)
    return kept.select(*cache.columns)


# ---------------------------------------------------------------------------
# storage: one append-only Parquet table, a partition per day
# ---------------------------------------------------------------------------
def read_cache(spark: SparkSession, base: str, as_of=None, ttl: int = CACHE_TTL_DAYS) -> DataFrame:
    """The stored entries with their write order ``seq``; an empty table if nothing has been stored.  With ``as_of`` partitions
    older than ``2 * ttl`` days (evicted entries) are not read."""
    from pyspark.errors import AnalysisException
    try:
        df = spark.read.schema(PAGE_CACHE).parquet(base)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType([*PAGE_CACHE.fields, T.StructField("seq", LANDING)]))
    df = df.withColumn("seq", landing_order())
    return df if as_of is None else df.where(F.col("fetch_date") >= F.date_sub(_as_date(as_of), 2 * ttl))


def append_cache(new: DataFrame, base: str, as_of) -> None:
    """Add crawled bodies as entries of the day ``as_of``.  Nothing stored is rewritten: of several entries for a URL the newest wins when
    the cache is read (``cache_fresh``), so a repeated run does no harm.  ``maintain_cache`` evicts old days and compacts closed ones."""
    rows = new.select("url", F.coalesce(F.col("text"), F.lit("")).alias("text"), _as_date(as_of).alias("fetch_date"))
    rows.write.mode("append").partitionBy("fetch_date").parquet(base)


#: Files of a compacted day have about this size.
TARGET_BYTES = 128 << 20
#: Compacted days wait here until they are swapped in; readers skip folders with a leading underscore.
_STAGED = "_compacted"


def _folders(spark: SparkSession, path: str) -> tuple[object, dict[str, object]]:
    """The storage of ``path`` and its sub-folders by name."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    return fs, {s.getPath().getName(): s.getPath() for s in fs.listStatus(at) if s.isDirectory()} if fs.exists(at) else {}


def evict_cache(spark: SparkSession, base: str, as_of, ttl: int = CACHE_TTL_DAYS) -> list[str]:
    """S12's eviction in storage: remove the folders of days more than ``2 * ttl`` days before ``as_of``.  Gives the removed days.  A day is one folder, so a run
    that ends half way leaves whole days, and the next run removes the rest."""
    first = dt.date.fromisoformat(str(as_of)[:10]) - dt.timedelta(days=2 * ttl)
    fs, folders = _folders(spark, base)
    gone = []
    for name, path in sorted(folders.items()):
        day = name.removeprefix("fetch_date=")
        if name.startswith("fetch_date=") and day != "__HIVE_DEFAULT_PARTITION__" and dt.date.fromisoformat(day) < first:
            fs.delete(path, True)
            gone.append(day)
    return gone


def _swap_in(spark: SparkSession, base: str) -> list[str]:
    """Put staged days that were written whole in the place of the stored ones.  A day's copy leaves the staging folder only when it is in
    place, so this can be repeated after a crash at any point."""
    fs, staged = _folders(spark, f"{base}/{_STAGED}")
    done = []
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name, path in sorted(staged.items()):
        if fs.exists(path_of(path, "_SUCCESS")):
            day = name.removeprefix("fetch_date=")
            rows = spark.read.schema("url string, text string").parquet(path.toString()).withColumn("fetch_date", F.lit(day).cast("date"))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fetch_date").parquet(base)
            done.append(day)
        fs.delete(path, True)
    return done


def compact_cache(spark: SparkSession, base: str, as_of, target_bytes: int = TARGET_BYTES) -> list[str]:
    """Rewrite closed days (before ``as_of``) that hold a URL twice or many small files: the newest entry of each URL stays, in files of about
    ``target_bytes``.  Gives the rewritten days.

    A day is first written whole to a staging folder inside ``base`` that readers skip, then put in place by a dynamic partition overwrite.  After a crash the next call
    finishes what was staged whole and starts anew what was not; a reader meanwhile sees the old day, the new one, or takes its URLs as not cached.  Run it when no
    run writes to the cache."""
    done = _swap_in(spark, base)
    stored = read_cache(spark, base).where(F.col("fetch_date") < _as_date(as_of))
    file = F.col("seq.file") if "file" in stored.schema["seq"].dataType.names else F.col("seq").cast("string")
    per_file = stored.groupBy("fetch_date", file.alias("file")).agg(F.sum(F.octet_length("url") + F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    per_day = per_file.groupBy("fetch_date").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    urls = stored.groupBy("fetch_date", "url").agg(F.lit(1).alias("one")).groupBy("fetch_date").agg(F.count(F.lit(1)).alias("urls"))
    for r in per_day.join(urls, "fetch_date").orderBy("fetch_date").collect():  # a row for each stored day
        parts = max(1, -(-(r["bytes"] or 0) // target_bytes))
        if r["rows"] > r["urls"] or r["files"] > 2 * parts:
            day = stored.where(F.col("fetch_date") == F.lit(r["fetch_date"]))
            newest = last_by_key(day.repartition(parts, "url"), "url", "seq")  # the window needs no further shuffle
            newest.select("url", "text").write.mode("overwrite").parquet(f"{base}/{_STAGED}/fetch_date={r['fetch_date']}")
    return sorted({*done, *_swap_in(spark, base)})


def maintain_cache(spark: SparkSession, base: str, as_of, ttl: int = CACHE_TTL_DAYS, target_bytes: int = TARGET_BYTES) -> dict[str, list[str]]:
    """Eviction, then compaction of what is left."""
    return {"evicted": evict_cache(spark, base, as_of, ttl), "compacted": compact_cache(spark, base, as_of, target_bytes)}
