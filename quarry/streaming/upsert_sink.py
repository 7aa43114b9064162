"""Streaming upsert into a versioned document table (SNK-2 in ``foreachBatch``).

Each micro-batch is deduplicated by key (highest ``seq`` wins, D7), applied
to the current version with :func:`quarry.sources.versions.upsert_table`,
and written as the next version.  The version marker records the micro-batch
id, so a batch replayed after a failure (Structured Streaming re-runs the
last uncommitted batch) is recognised and skipped: the sink is idempotent
and the table never shows half a batch.

A table that keeps the ``seq`` column orders changes across batches as well:
a change that arrives after a higher ``seq`` of its key was stored is left
out.  The order lives in the table, so it needs no state store, has no time
limit and outlives the stream's checkpoint; a deleted key's order is gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..sources.versions import upsert_table


def _already_applied(spark: SparkSession, root: str, batch_id: int) -> bool:
    """Whether a committed version records ``batch_id`` (a filtered probe,
    not a list of every batch ever applied)."""
    try:
        markers = spark.read.json(f"{root}/_versions")
    except AnalysisException:
        return False
    if "batch_id" not in markers.columns:
        return False
    return markers.where(F.col("batch_id") == F.lit(int(batch_id))).limit(1).count() > 0


def apply_batch(batch: DataFrame, batch_id: int, root: str, seq_col: str | None = "seq") -> int | None:
    """Upsert one micro-batch into the table at ``root``; returns the new
    version, or None when the batch was already applied or is empty."""
    spark = batch.sparkSession
    if _already_applied(spark, root, batch_id):
        return None
    return upsert_table(spark, root, batch, seq_col=seq_col, batch_id=batch_id)


def upsert_stream(stream: DataFrame, root: str, checkpoint_location: str, seq_col: str | None = "seq",
                  trigger: dict | None = None):
    """Start a streaming query that upserts every micro-batch into ``root``.

    ``root`` must already hold a committed version (the base table).
    ``trigger`` defaults to ``{"availableNow": True}``.
    """
    writer = (stream.writeStream.option("checkpointLocation", checkpoint_location)
              .foreachBatch(lambda df, bid: apply_batch(df, bid, root, seq_col)))
    return writer.trigger(**(trigger or {"availableNow": True})).start()
