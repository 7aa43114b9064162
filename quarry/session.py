"""Session helpers: a local session for tests and the bench, and the few
settings every operator reads from the session instead of hard-coding."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Byte budget for anything this library broadcasts itself (query blocks,
# centroids, codebooks).  Operators compute the size of what they would
# broadcast and fall back to a shuffle / more blocks beyond it.
DEFAULT_BROADCAST_BUDGET = 64 * 1024 * 1024
BUDGET_CONF = "quarry.broadcast.budget.bytes"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quarry", extra: dict | None = None) -> SparkSession:
    """A local[*] session configured like the tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir``
    (or ``SparkContext.setCheckpointDir``) names it.  Raises when none is
    named: a folder of one machine would lose rows on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    return path.rstrip("/")


def broadcast_budget(spark: SparkSession) -> int:
    value = spark.conf.get(BUDGET_CONF, None)
    return int(value) if value else DEFAULT_BROADCAST_BUDGET


def materialize(df, name: str):
    """Write ``df`` once as a parquet table under the session's checkpoint
    folder (shared on a cluster) and return it read back: lineage is cut
    and the plan runs exactly once, even when several consumers read it."""
    import uuid
    root = ensure_checkpoint_dir(df.sparkSession)
    path = f"{root.rstrip('/')}/quarry-{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)
