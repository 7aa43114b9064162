"""Versioned table writes and compaction (SNK-6).

Plain parquet cannot be overwritten in place by a plan that reads it, so
a version is written into a new folder and then named current with a marker
``root/_versions/v=<n>/``.  A crashed writer leaves an unnamed folder, never
a half-visible table.  The marker keeps the schema, so partition names come
back as they were written (``001`` stays text).

A version is a whole table, ``root/v=<n>/`` (partitioned by
``partition_name``), or the rows that an upsert put in,
``root/changes=<base>/_change=<n>/``, on the whole table ``v=<base>``; the
newest row of a key counts.  An upsert writes its rows only, until the rows
written since the last whole table outnumber that table's: then it writes the
whole table again, so that all writing together stays in proportion to the
table and the changes, however many upserts bring them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ..functions.partitions import partition_or_default
from ..operators.tables import (add, compact, delete_by_filter, delete_by_ids, drop_partition, replaced, settled_changes,
                                upsert)

MARKER = "version long, batch_id long, schema string, base long"


def _markers(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(MARKER).json(f"{root}/_versions")
    except AnalysisException:
        return None


def _current(spark: SparkSession, root: str):
    """The newest marker (version, schema, base: the whole table it stands on), or None."""
    m = _markers(spark, root)
    return None if m is None else m.orderBy(F.desc("version")).select(
        "version", "schema", F.coalesce("base", "version").alias("base")).head()


def current_version(spark: SparkSession, root: str) -> int | None:
    row = _current(spark, root)
    return None if row is None else int(row["version"])


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The current table."""
    row = _current(spark, root)
    if row is None:
        raise FileNotFoundError(f"no committed version under {root}")
    import json
    schema = StructType.fromJson(json.loads(row["schema"]))
    whole = spark.read.schema(schema).parquet(f"{root}/v={row['base']}").select(*schema.names)
    if row["base"] == row["version"]:
        return whole
    named = _markers(spark, root).where((F.col("base") == row["base"]) & (F.col("version") <= row["version"])).select(
        F.col("version").alias("_change"))
    changes = (spark.read.schema(StructType([*schema.fields, StructField("_change", LongType())]))
               .parquet(f"{root}/changes={row['base']}").join(F.broadcast(named), "_change", "left_semi"))
    newest = changes.groupBy(F.col("partition_name").alias("_p"), F.col("id").alias("_i")).agg(
        F.max("_change").alias("_newest"))
    same = F.col("partition_name").eqNullSafe(F.col("_p")) & F.col("id").eqNullSafe(F.col("_i"))
    changes = changes.join(newest, same & (F.col("_change") == F.col("_newest")), "left_semi")
    return replaced(whole, changes.select(*schema.names))


def write_version(df: DataFrame, root: str, partition_by: str | None = "partition_name",
                  batch_id: int | None = None) -> int:
    """Write ``df`` as the next version and name it current; returns the
    version.  A NULL or empty partition is the default partition."""
    spark = df.sparkSession
    if partition_by:
        df = df.withColumn(partition_by, partition_or_default(F.col(partition_by).cast("string")))
    v = (current_version(spark, root) or 0) + 1
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{root}/v={v}")
    return _name_current(spark, root, v, v, df.schema, batch_id)


def _name_current(spark: SparkSession, root: str, v: int, base: int, schema: StructType, batch_id: int | None) -> int:
    marker = spark.range(1).select(F.lit(v).cast("long").alias("version"), F.lit(batch_id).cast("long").alias("batch_id"),
                                   F.lit(schema.json()).alias("schema"), F.lit(base).cast("long").alias("base"))
    marker.coalesce(1).write.mode("error").json(f"{root}/_versions/v={v}")
    return v


def _changed_rows(spark: SparkSession, root: str, base: int) -> int:
    """Rows written since the whole table ``base`` (file footers only)."""
    try:
        return spark.read.parquet(f"{root}/changes={base}").count()
    except AnalysisException:
        return 0


def _some(df: DataFrame) -> bool:
    return df.limit(1).count() > 0


def _fitting(df: DataFrame, current: DataFrame, *more: str) -> DataFrame:
    """``df``, if the stored table has all its columns: what it lacks would be
    lost, so it is refused (``pack_dynamic_fields`` puts undeclared fields in one column)."""
    unknown = [c for c in df.columns if c not in current.columns and c not in more]
    if unknown:
        raise ValueError(f"the stored table has no column {', '.join(unknown)}; pack or drop it first")
    return df


def upsert_table(spark: SparkSession, root: str, changes: DataFrame, seq_col: str | None = "seq",
                 batch_id: int | None = None) -> int | None:
    """SNK-2 on a stored table.  Returns the new version, or None for an
    empty change set."""
    current = read_current(spark, root)
    changes = _fitting(changes, current, seq_col)
    if not _some(changes):
        return None
    row = _current(spark, root)
    settled = settled_changes(current, changes, seq_col=seq_col)
    put = spark.createDataFrame([], current.schema).unionByName(settled, allowMissingColumns=True)
    other = [c for c, kind in put.dtypes if kind != current.schema[c].dataType.simpleString()]
    if other or _changed_rows(spark, root, row["base"]) > spark.read.parquet(f"{root}/v={row['base']}").count():
        return write_version(upsert(current, changes, seq_col=seq_col), root, batch_id=batch_id)
    v = row["version"] + 1
    put.write.mode("error").parquet(f"{root}/changes={row['base']}/_change={v}")
    return _name_current(spark, root, v, row["base"], current.schema, batch_id)


def delete_from_table(spark: SparkSession, root: str, *, ids: DataFrame | None = None, pred=None,
                      partition: str | None = None) -> int | None:
    """SNK-3 / SNK-4 on a stored table.  Returns the new version, or None
    when nothing matched."""
    current = read_current(spark, root)
    if ids is not None:
        keep = delete_by_ids(current, ids, partition)
        hit = current.join(ids.select(F.col(ids.columns[0]).cast("string").alias("id")), "id", "left_semi")
    else:
        if pred is None or (isinstance(pred, str) and not pred.strip()):
            return None
        keep = delete_by_filter(current, pred, partition)
        hit = current.where(F.expr(pred) if isinstance(pred, str) else pred)
    if partition:
        hit = hit.where(F.col("partition_name") == F.lit(partition))
    return write_version(keep, root) if _some(hit) else None


def add_to_table(spark: SparkSession, root: str, docs: DataFrame, batch_id: int | None = None) -> int | None:
    """SNK-1 on a stored table (no key check, as ``add``); None for no rows."""
    current = read_current(spark, root)
    docs = _fitting(docs, current)
    return write_version(add(current, docs), root, batch_id=batch_id) if _some(docs) else None


def drop_partition_table(spark: SparkSession, root: str, name: str) -> int:
    """SNK-5 on a stored table."""
    return write_version(drop_partition(read_current(spark, root), name), root)


def current_bytes(spark: SparkSession, root: str) -> int:
    """Bytes of the current table's parquet files, listed with the
    ``binaryFile`` source without reading the files."""
    row = _current(spark, root)
    total = 0
    for folder in () if row is None else (f"{root}/v={row['base']}", f"{root}/changes={row['base']}"):
        try:
            files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                     .option("recursiveFileLookup", "true").load(folder))
            total += int(files.agg(F.sum("length")).first()[0] or 0)
        except AnalysisException:  # no data files
            pass
    return total


def compact_table(spark: SparkSession, root: str, target_file_mb: float | None = 128.0,
                  rows_per_file: int | None = None) -> int:
    """Rewrite the current table in fewer, larger files (SNK-6).  The file
    count comes from the bytes of the files read (``target_file_mb`` per
    output file), or from the row count when ``rows_per_file`` is given; the
    layout is a range partitioning on (partition, id), which spreads a hot
    partition over many files.  Rows are unchanged."""
    df = read_current(spark, root)
    if rows_per_file:
        n_files = math.ceil(max(df.count(), 1) / rows_per_file)
    else:
        n_files = math.ceil(max(current_bytes(spark, root), 1) / (float(target_file_mb) * 1024 * 1024))
    return write_version(compact(df, n_files), root)
