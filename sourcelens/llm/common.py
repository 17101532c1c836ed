"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import os
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import sourcelens
from sourcelens.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Only a session that names none (tests) gets one of its own."""
    if checkpoint_dir(spark) is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return checkpoint_dir(spark).rstrip("/")


def cut(df: DataFrame, rows: int | None = None, per_part: int = 25_000) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the copy, so a lost executor rereads it and later
    jobs don't compute it again.  With a bound of its ``rows``, a small table becomes few files, and the shuffles
    after it few pieces, however many partitions the session uses."""
    shared_folder(df.sparkSession)
    return (df if rows is None else few(df, rows, per_part)).checkpoint(eager=True)


def few(df: DataFrame, rows: int, per_part: int = 25_000) -> DataFrame:
    """``df``, of at most so many rows, in as many tasks as these need: a small table that comes from a shuffle and goes to
    the next one else runs a task, and leaves a shuffle file, for every partition of the session."""
    return df.coalesce(max(4, -(-rows // per_part)))


def release(spark: SparkSession) -> None:
    """Let the driver forget plans that nothing refers to any more.  Spark's cleaner then removes their shuffle files, and their checkpoints if it is set
    to; otherwise these stay on the executors' disks until the driver's memory happens to run full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver found it; on a cluster without
    that path install the package or pass it with ``--py-files``."""
    env = df.sparkSession.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.abspath(sourcelens.__file__)))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df.mapInArrow(fn, schema)


def map_rows(df: DataFrame, fn, schema: str, rows: int = 256) -> DataFrame:
    """``fn(columns: dict of lists) -> dict of lists`` over small slices of Arrow batches, so a
    Python worker holds at most ``rows`` texts with their intermediate results."""
    arrow = arrow_schema(df.sparkSession, schema)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows).to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return map_arrow(df, run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(schema))
