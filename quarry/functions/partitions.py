"""Partition names from knowledge ids and back (FN-5, FN-6, SURVEY D10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prefix and the character rule of partition names.
PARTITION_PREFIX = "partition_"
DEFAULT_PARTITION = "_default"
UNSAFE_CHARS = "[^a-zA-Z0-9]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def partition_name(knowledge_id) -> Column:
    """``partition_`` + id with every character outside [a-zA-Z0-9] as ``_``."""
    return F.concat(F.lit(PARTITION_PREFIX), F.regexp_replace(_col(knowledge_id), UNSAFE_CHARS, "_"))


def knowledge_id(partition) -> Column:
    """Strip the prefix when present, else return the name unchanged."""
    p = _col(partition)
    return F.when(p.startswith(PARTITION_PREFIX), F.substring(p, len(PARTITION_PREFIX) + 1, 1 << 30)).otherwise(p)


def partition_or_default(partition) -> Column:
    p = _col(partition)
    return F.when(p.isNull() | (F.trim(p) == ""), F.lit(DEFAULT_PARTITION)).otherwise(p)


def partition_collisions(ids: DataFrame, id_col: str = "knowledge_id") -> DataFrame:
    """Knowledge ids that map to the same partition name (``kb-1``/``kb_1``).

    One row per clashing id: ``partition_name, knowledge_id, n_ids`` (the
    number of distinct ids sharing that name).  Counts are a ``groupBy`` with
    partial aggregation joined back, so no group is ever collected.
    """
    distinct = (ids.select(F.col(id_col).alias("knowledge_id")).where(F.col("knowledge_id").isNotNull())
                .distinct().withColumn("partition_name", partition_name("knowledge_id")))
    clashes = (distinct.groupBy("partition_name").agg(F.count(F.lit(1)).alias("n_ids"))
               .where(F.col("n_ids") > 1))
    return distinct.join(clashes, "partition_name").select("partition_name", "knowledge_id", "n_ids")
