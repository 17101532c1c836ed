"""Stateless labelling of landed records as they arrive (Structured Streaming).

The reference runs one-shot snapshots; it has no streaming operator.  The projection-only
steps (canonical URL, host, ownership as an expression, non-production flag, claim flags,
prices, brands, outbound links) hold no state, so the same column expressions run
unchanged on a ``readStream`` DataFrame: records landed into a folder are labelled
incrementally, and the keep-best / last-wins steps (which aggregate) stay in the batch
snapshot jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sourcelens.functions.text import brands_in, claim_flags, lowered, prices_seen
from sourcelens.functions.urls import canonical_url, host_of, is_nonprod, outbound_links
from sourcelens.operators.ownership import ownership
from sourcelens.rules import BrandRules


def label_records(df: DataFrame, rules: BrandRules, url: str = "url", text: str = "text") -> DataFrame:
    """The stateless labels of one record; works on batch and streaming frames alike."""
    canon = canonical_url(F.col(url))
    host = host_of(canon)
    out = df.withColumn("canon_url", canon).withColumn("host", host)
    out = (out.withColumn("ownership", ownership(F.col(url), F.col("host"), rules))
              .withColumn("nonprod_url", is_nonprod(F.col("host"), rules)))
    if text in df.columns:
        out = out.withColumn("_lt", lowered(F.col(text)))
        for name, c in claim_flags(F.col(text), rules, lower_text=F.col("_lt")).items():
            out = out.withColumn(name, c)
        out = (out.withColumn("prices_seen", F.array_join(prices_seen(F.col(text), rules), ", "))
                  .withColumn("competitors_named",
                              F.array_join(brands_in(F.col(text), list(rules.competitor_brands),
                                                     rules.word_boundary, lower_text=F.col("_lt")), "; "))
                  .drop("_lt")
                  .withColumn("links_on_source",
                              F.array_join(outbound_links(F.col(text), F.col("canon_url"), rules), ", ")))
    return out


def stream_labels(spark: SparkSession, landing: str, schema: T.StructType, rules: BrandRules,
                  fmt: str = "parquet", url: str = "url", text: str = "text",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of labelled records from files landing in ``landing``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return label_records(reader.load(landing), rules, url, text)


def start_label_stream(spark: SparkSession, landing: str, schema: T.StructType, rules: BrandRules, out: str,
                       checkpoint: str | None = None, fmt: str = "parquet", trigger_seconds: int | None = None,
                       available_now: bool = False):
    """Label records as files land and append them to ``out`` (Parquet).

    The file sink plus a checkpoint location gives exactly-once output across restarts and
    lost executors.  The checkpoint goes under the cluster's ``spark.checkpoint.dir``
    unless one is given.  ``available_now`` processes what has landed and stops."""
    from sourcelens.session import checkpoint_dir
    chk = checkpoint or (f"{checkpoint_dir(spark).rstrip('/')}/label_stream" if checkpoint_dir(spark) else None)
    if chk is None:
        raise RuntimeError("no checkpoint location: pass one or set spark.checkpoint.dir")
    w = (stream_labels(spark, landing, schema, rules, fmt).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", chk).outputMode("append"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
