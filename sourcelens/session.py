"""Session helpers: local sessions for tests and bench, checkpoint folder lookup."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sourcelens",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench: UI off, AQE on, UTC, ANSI as shipped."""
    b = SparkSession.builder
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    return (b
            .master(f"local[{cores}]")
            .appName(app)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", os.environ.get("SOURCELENS_DRIVER_MEMORY", "8g"))
            .config("spark.sql.execution.arrow.pyspark.enabled", "true")
            .getOrCreate())


# Settings for a large cluster run (hundreds of executors, tens of TB).  Applied only where
# the session leaves them unset, so a cluster's own configuration always wins.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # start wide and let AQE coalesce: no reducer sees more than ~256 MB
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # broadcast only what is measured small at run time
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Arrow batches for the scorer (V1): bounded memory per Python worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> dict:
    """Set ``CLUSTER_CONF`` (plus ``overrides``) on the session for every key the cluster's
    own configuration (spark-defaults, ``--conf``) does not name.  Returns what was set."""
    given = spark.sparkContext.getConf()
    set_now = {}
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        if not given.contains(k):
            spark.conf.set(k, v)
            set_now[k] = v
    return set_now


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the cluster's checkpoint folder; set ``fallback`` only where none is configured (tests)."""
    d = checkpoint_dir(spark)
    if d:
        return d
    spark.sparkContext.setCheckpointDir(fallback)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def shared_scratch(spark: SparkSession) -> str:
    """The checkpoint folder.  A local session that names none gets a folder of its own; on a cluster that is an error, since executors
    don't share a machine's folders."""
    d = checkpoint_dir(spark)
    if d is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    return (d or ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="sourcelens-"))).rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a local checkpoint), so a
    lost executor re-reads the checkpoint instead of recomputing a long lineage."""
    if checkpoint_dir(df.sparkSession) is None:
        raise RuntimeError("spark.checkpoint.dir is not set; call ensure_checkpoint_dir first")
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint(eager=True)
