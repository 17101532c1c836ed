"""Score ledger (V1): what a scorer said about a text, kept by content, so that nothing is paid for twice.

A ledger is an append-only Parquet table of ``fingerprint``, the verdict's fields, ``score_status``, ``score_error`` and ``scored_at``.  The fingerprint
is the SHA-256 of scorer name, text and hints.  Each task's verdicts become part of the table when the task ends, not when the job does:
a job that fails leaves what it has paid for, and the next run pays for the rest.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sourcelens.operators.dedupe import keep_first
from sourcelens.operators.verdicts import score_batches

#: Texts that a task scores, so what a lost task can cost; and the most tasks of a run.
TEXTS_PER_TASK = 500
MAX_TASKS = 100_000


def scorer_name(scorer: Callable) -> str:
    """The name a scorer has if its user gives none: it doesn't change when the scorer's code does."""
    return f"{getattr(scorer, '__module__', '')}.{getattr(scorer, '__qualname__', type(scorer).__qualname__)}"


def fingerprint(scorer_id: str, text: str = "text", hints: tuple[str, ...] = ()) -> Column:
    """SHA-256 (hex) of the scorer's name, the text and the hints; null differs from the empty string."""
    parts = F.struct(F.lit(scorer_id).alias("scorer"), F.col(text).alias("text"), *[F.col(h).alias(f"hint_{i}") for i, h in enumerate(hints)])
    return F.sha2(F.to_json(parts, {"ignoreNullFields": "false"}), 256)


def ledger_schema(schema: T.StructType) -> T.StructType:
    fields = [f for f in schema.fields if f.name != "key"]
    return T.StructType([T.StructField("fingerprint", T.StringType()), *fields, T.StructField("score_status", T.StringType()),
                         T.StructField("score_error", T.StringType()), T.StructField("scored_at", T.TimestampType())])


def read_ledger(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All entries; an empty table where nothing has been scored."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(ledger_schema(schema)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ledger_schema(schema))


def latest_scores(ledger: DataFrame) -> DataFrame:
    """One entry for each fingerprint: an ``ok`` one if there is any, of these the first paid; else the last failure."""
    at = F.unix_micros("scored_at")
    ok = F.col("score_status") == "ok"
    order = [ok.desc(), F.when(ok, at).otherwise(-at).asc_nulls_last(), F.to_json(F.struct(*[c for c in ledger.columns if c != "fingerprint"]))]
    return keep_first(ledger, "fingerprint", order)


def _append(df: DataFrame, path: str) -> None:
    """Add rows task by task: the committer's second algorithm moves a task's files into the table when the task is committed."""
    df.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)


def score_with_ledger(df: DataFrame, scorer: Callable, path: str, schema: T.StructType, scorer_id: str, key: str = "key", text: str = "text",
                      hints: tuple[str, ...] = (), texts_per_task: int = TEXTS_PER_TASK, retry_failed: bool = True) -> DataFrame:
    """V1 by content: ``key``, the verdict's fields, ``score_status`` and ``score_error`` for every row of ``df``.

    Texts without an ``ok`` entry are scored, each distinct (text, hints) once, in tasks of ``texts_per_task`` texts, and appended to the
    ledger at ``path``; with ``retry_failed`` off, texts whose scoring failed before are left as they are.  The scorer gets the fingerprint as
    ``key``.  ``scorer_id`` names the model and its instructions: another name scores anew.  The join of all rows with their scores carries
    fingerprints, not texts, and a hot text (one answer given a million times) is cut to one row per task before the shuffle.
    """
    spark = df.sparkSession
    wanted = df.withColumn("fingerprint", fingerprint(scorer_id, text, hints))
    known = read_ledger(spark, path, schema)
    if retry_failed:
        known = known.where(F.col("score_status") == "ok")
    names = [f"_hint_{i}" for i in range(len(hints))]
    texts = wanted.select("fingerprint", F.col(text).alias("_text"), *[F.col(h).alias(n) for h, n in zip(hints, names)])
    pending = keep_first(texts, "fingerprint", [F.lit(0)]).join(known.select("fingerprint"), "fingerprint", "left_anti")
    todo = pending.agg(F.count(F.lit(1))).first()[0]
    if todo:
        asked = pending.select("fingerprint", F.col("_text").alias("_scored_text"), *[F.col(n).alias(h) for h, n in zip(hints, names)])
        scored = score_batches(asked, scorer, schema, "fingerprint", "_scored_text", hints, parallelism=min(MAX_TASKS, -(-todo // texts_per_task)))
        _append(scored.withColumnRenamed("key", "fingerprint").withColumn("scored_at", F.current_timestamp())
                .select(*ledger_schema(schema).names), path)
    scores = latest_scores(read_ledger(spark, path, schema)).drop("scored_at")
    return wanted.select(F.col(key).cast("string").alias("key"), "fingerprint").join(scores, "fingerprint", "left").drop("fingerprint")


def compact_ledger(spark: SparkSession, path: str, target: str, schema: T.StructType) -> None:
    """Write the ledger anew to ``target`` with one entry per fingerprint; the old folder stays until its user removes it."""
    latest_scores(read_ledger(spark, path, schema)).write.mode("errorifexists").parquet(target)
