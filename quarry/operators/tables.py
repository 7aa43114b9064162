"""Table changes and reads over a document table (SNK-1..5, JOI-1, LIM-1, AGG-1..3).

All are pure DataFrame -> DataFrame transforms; persisting a result is a
separate, versioned write (:mod:`quarry.sources.versions`).  The row key is
``(partition_name, id)`` (SURVEY D7).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.partitions import partition_or_default
from ..session import ensure_checkpoint_dir
from ..sources.segments import default_columns
from .knn import scope_corpus

KEY = ["partition_name", "id"]


def _with_partition(docs: DataFrame, partition: str | None) -> DataFrame:
    if partition is not None and partition.strip():
        return docs.withColumn("partition_name", F.lit(partition))
    if "partition_name" not in docs.columns:
        return docs.withColumn("partition_name", partition_or_default(F.lit(None).cast("string")))
    return docs.withColumn("partition_name", partition_or_default("partition_name"))


def add(base: DataFrame, docs: DataFrame, partition: str | None = None) -> DataFrame:
    """SNK-1: append; no key check; an empty input changes nothing."""
    return base.unionByName(_with_partition(docs, partition), allowMissingColumns=True)


def dedupe_changes(changes: DataFrame, seq_col: str | None = "seq") -> DataFrame:
    """One row per key (D7): the highest ``seq`` wins; without a ``seq``
    column (or on a tie at the top) a duplicate key fails the job instead of
    picking a row arbitrarily.

    Per-key statistics are ``groupBy`` aggregates (partial counts and maxima
    before the shuffle) joined back on the key, so a key that holds a large
    share of the batch never gathers in one task.
    """
    def fail_on(cond, message: str) -> Column:
        return F.when(cond, F.raise_error(F.concat(F.lit(message), F.coalesce("id", F.lit("NULL"))))).otherwise(
            F.lit(True))

    def per_key(df: DataFrame, *aggs: Column) -> DataFrame:
        return df.groupBy(F.col("partition_name").alias("_p"), F.col("id").alias("_i")).agg(*aggs)

    same_key = F.col("partition_name").eqNullSafe(F.col("_p")) & F.col("id").eqNullSafe(F.col("_i"))
    what = "duplicate key in one upsert batch: "
    if seq_col and seq_col in changes.columns:
        # A NULL seq is lower than any number.
        order = F.struct(F.col(seq_col).isNotNull().alias("given"), F.col(seq_col).alias("seq"))
        top = per_key(changes, F.max(order).alias("_top"))
        changes = changes.join(top, same_key).where(order.eqNullSafe(F.col("_top"))).drop("_top", "_p", "_i")
        what = "duplicate key with equal seq in one batch: "
    dups = per_key(changes, F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return (changes.join(dups, same_key, "left").withColumn("_ok", fail_on(F.col("_n").isNotNull(), what))
            .where(F.col("_ok").isNotNull()).drop("_n", "_ok", "_p", "_i"))


def not_outranked(base: DataFrame, changes: DataFrame, seq_col: str) -> DataFrame:
    """The changes whose stored row holds no higher ``seq``: what arrives late,
    in a later batch than its successor, changes nothing.  An equal ``seq``
    replaces; NULL is the lowest.  Only the stored rows of the changed keys
    are aggregated."""
    partition = partition_or_default("partition_name")
    keys = changes.select(F.col("partition_name").alias("_p"), F.col("id").alias("_i"))
    held = (base.select(partition.alias("_bp"), F.col("id").alias("_bi"), F.col(seq_col).alias("_held"))
            .where(F.col("_held").isNotNull())
            .join(keys, F.col("_bp").eqNullSafe(F.col("_p")) & F.col("_bi").eqNullSafe(F.col("_i")), "left_semi")
            .groupBy("_bp", "_bi").agg(F.max("_held").alias("_held")))
    same = F.col("partition_name").eqNullSafe(F.col("_bp")) & F.col("id").eqNullSafe(F.col("_bi"))
    late = F.col("_held").isNotNull() & (F.col(seq_col).isNull() | (F.col(seq_col) < F.col("_held")))
    return changes.join(held, same, "left").where(~late).drop("_bp", "_bi", "_held")


def upsert(base: DataFrame, docs: DataFrame, partition: str | None = None, seq_col: str | None = "seq") -> DataFrame:
    """SNK-2: insert or replace by key; empty input changes nothing.

    ``base`` minus the changed keys (one null-safe anti join; a NULL or empty
    partition is the default one), plus the changes.  Spark broadcasts the
    key side when AQE measures it small, else both sides shuffle on the key.

    A ``base`` that keeps the ``seq`` column orders changes across batches
    too (:func:`not_outranked`); without it only the batch itself is ordered.
    """
    return replaced(base, settled_changes(base, docs, partition, seq_col))


def settled_changes(base: DataFrame, docs: DataFrame, partition: str | None = None,
                    seq_col: str | None = "seq") -> DataFrame:
    """The rows that an upsert of ``docs`` puts into ``base``: one for each key."""
    changes = dedupe_changes(_with_partition(docs, partition), seq_col)
    if seq_col and seq_col in changes.columns:
        changes = not_outranked(base, changes, seq_col) if seq_col in base.columns else changes.drop(seq_col)
    return changes


def replaced(base: DataFrame, changes: DataFrame) -> DataFrame:
    """``base`` without the keys of ``changes``, plus ``changes``."""
    keys = changes.select(F.col("partition_name").alias("_p"), F.col("id").alias("_i"))
    kept = base.join(keys, partition_or_default("partition_name").eqNullSafe(F.col("_p"))
                     & F.col("id").eqNullSafe(F.col("_i")), "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def delete_by_ids(base: DataFrame, ids: DataFrame, partition: str | None = None, id_col: str = "id") -> DataFrame:
    """SNK-3: remove rows whose id is in ``ids`` (in one partition if named)."""
    keys = ids.select(F.col(id_col).cast("string").alias("id")).where(F.col("id").isNotNull())
    if partition is not None and partition.strip():
        return base.join(keys.withColumn("partition_name", F.lit(partition)), KEY, "left_anti")
    return base.join(keys, "id", "left_anti")


def delete_by_filter(base: DataFrame, pred, partition: str | None = None) -> DataFrame:
    """SNK-4: remove matching rows.  A missing or empty filter deletes
    nothing (never "delete all"); a NULL predicate keeps the row."""
    if pred is None or (isinstance(pred, str) and not pred.strip()):
        return base
    cond: Column = F.coalesce(F.expr(pred) if isinstance(pred, str) else pred, F.lit(False))
    if partition is not None and partition.strip():
        cond = cond & (F.col("partition_name") == F.lit(partition))
    return base.where(~cond)


def drop_partition(base: DataFrame, name: str) -> DataFrame:
    """SNK-5: every row of one partition removed."""
    return base.where(~F.coalesce(F.col("partition_name") == F.lit(name), F.lit(False)))


def get_by_ids(base: DataFrame, ids: DataFrame, partition: str | None = None, columns=None,
               include_vectors: bool = False, id_col: str = "id") -> DataFrame:
    """JOI-1: rows whose id is in ``ids`` (left-semi join); empty ids -> empty."""
    keys = ids.select(F.col(id_col).cast("string").alias("id")).where(F.col("id").isNotNull())
    scoped = scope_corpus(base, None, [partition] if partition else None)
    found = scoped.join(keys, "id", "left_semi")
    return found.select(*_columns(base, columns, include_vectors))


def _columns(base: DataFrame, columns, include_vectors: bool) -> list[str]:
    """PRJ-1 default columns, or PRJ-2: a non-empty explicit list replaces them."""
    cols = default_columns(base) if not columns else list(columns)
    if include_vectors and "embedding" in base.columns and "embedding" not in cols:
        cols.append("embedding")
    return cols


@dataclass(frozen=True)
class PageIndex:
    """The keys of a table in (id, partition) order, for pages however deep.

    ``keys`` has a row for each document: its place ``pos`` within the range
    ``part`` that holds it; ``before`` has the number of rows before each
    range.  A page reads the ranges that hold it and no other rows."""

    base: DataFrame
    keys: DataFrame  # part, pos (from 0), id, partition_name
    before: tuple[tuple[int, int, int], ...]  # part, rows before it, rows in it

    @staticmethod
    def build(base: DataFrame, pred=None, partition: str | None = None) -> "PageIndex":
        scoped = scope_corpus(base, pred, [partition] if partition else None).select("id", "partition_name")
        dealt = scoped.repartitionByRange("id", "partition_name").withColumn("part", F.spark_partition_id())
        order = Window.partitionBy("part").orderBy("id", "partition_name")
        path = f"{ensure_checkpoint_dir(base.sparkSession)}/quarry-page-keys-{uuid.uuid4().hex}"
        dealt.withColumn("pos", F.row_number().over(order).cast("long") - 1).write.partitionBy("part").parquet(path)
        keys = base.sparkSession.read.schema("id string, partition_name string, pos long, part int").parquet(path)
        sizes = sorted((r["part"], r["n"]) for r in keys.groupBy("part").agg(F.count("*").alias("n")).collect())
        total, before = 0, []
        for part, n in sizes:  # one row for each range
            before.append((part, total, n))
            total += n
        return PageIndex(base, keys, tuple(before))

    def page(self, offset: int = 0, limit: int = 100, columns=None, include_vectors: bool = False) -> DataFrame:
        """Rows ``offset`` to ``offset + limit - 1`` of the order of :func:`query`.
        Rows that repeat a key are one place each, but come back as often as the key occurs."""
        wanted = [F.lit(False)]
        for part, start, n in self.before:
            lo, hi = max(offset - start, 0), min(offset + limit - start, n)
            if lo < hi:
                wanted.append((F.col("part") == part) & F.col("pos").between(lo, hi - 1))
        keys = self.keys.where(reduce(Column.__or__, wanted)).select("id", "partition_name").distinct()
        return self.base.join(keys, ["id", "partition_name"], "left_semi").select(
            *_columns(self.base, columns, include_vectors))


def query(base: DataFrame, pred=None, partition: str | None = None, offset: int = 0, limit: int = 100,
          columns=None, include_vectors: bool = False) -> DataFrame:
    """LIM-1: a filtered page, ordered by id (D8) so pages are stable.

    Plans as ``TakeOrderedAndProject(limit, offset)``: every task keeps
    only ``offset + limit`` rows.
    """
    scoped = scope_corpus(base, pred, [partition] if partition else None)
    page = scoped.orderBy("id", "partition_name").offset(int(offset)).limit(int(limit))
    return page.select(*_columns(base, columns, include_vectors))


def count(base: DataFrame, partition: str | None = None) -> DataFrame:
    """AGG-1 / AGG-2: one row ``count``."""
    scoped = scope_corpus(base, None, [partition] if partition else None)
    return scoped.agg(F.count(F.lit(1)).cast("long").alias("count"))


def list_partitions(base: DataFrame) -> DataFrame:
    """AGG-3: one row per partition with its row count."""
    return base.groupBy("partition_name").agg(F.count(F.lit(1)).cast("long").alias("n_rows"))


def has_partition(base: DataFrame, name: str) -> bool:
    return base.where(F.col("partition_name") == F.lit(name)).limit(1).count() > 0


def compact(df: DataFrame, n_files: int) -> DataFrame:
    """SNK-6 transform: ``n_files`` range-partitioned outputs ordered by
    (partition, id); a hot partition spreads over many files."""
    return df.repartitionByRange(max(1, int(n_files)), "partition_name", "id")


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    """FLT-2: ``column == value`` with the value as a literal (no quoting hazard)."""
    return df.where(F.col(column) == F.lit(value))


def filter_in(df: DataFrame, column: str, values) -> DataFrame:
    """FLT-3: ``column in values``.

    ``values`` may be a one-column DataFrame (left-semi join, any size) or a
    short Python list (``isin``); an empty list matches nothing (D11).
    """
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias(column)).where(F.col(column).isNotNull())
        return df.join(keys.distinct(), column, "left_semi")
    values = list(values)
    if not values:
        return df.where(F.lit(False))
    return df.where(F.col(column).isin(values))
