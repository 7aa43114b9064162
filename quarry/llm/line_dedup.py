"""Incremental, reversible line dedup: sharded cuckoo filters in front of
exact reference counts.

A line's key is the line without the white space (space, tab to carriage
return) at its ends, A-Z in lower case; keys of fewer than ``min_chars``
characters are left alone.  A key held by ``min_docs`` documents or more
stays in the largest doc_id that holds it and is dropped from all others.

State is a folder of plain tables, one set for each version:

``changes``  (key, doc_id, n): by how many rows of a document the version
             added to (or took from) the references of a key;
``counts``   (key, n_docs, keeper, refs): exact reference counts of the keys
             that the version touched;
``filters``  (shard, n_keys, filter): one cuckoo filter for each shard of the
             keys of at least ``min_docs`` documents.

A document's references are counted, not only noted: rows that repeat a
doc_id, inserted one after the other, can be deleted one after the other.
A change writes its own rows and the counts of the keys it touches, nothing
else; the newest count of a key holds.  Keys that cross ``min_docs`` are
inserted into or deleted from their shard's cuckoo filter (it stores
fingerprints, so it can delete).  Deleting what was inserted gives back the
earlier state; taking out what is not there changes nothing.

Dropping lines asks the filters first.  While together they are below
``broadcast_bytes`` every task has them and asks where documents are read;
beyond, the distinct keys meet their shard's filter in one task for each
shard.  Only keys that pass (all true ones, and about one other in ten
thousand) go on to the exact counts.  The number of shards follows the
number of keys, so a shard's filter stays small.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import schema_with, scratch_path, slices, small_batches, text_bytes

BLANKS = b" \t\n\r\x0b\x0c"
SLOTS = 4
MAX_KICKS = 500


def line_key(line: bytes, min_chars: int) -> int | None:
    """The 64-bit key of a line, None if the line is too short to count."""
    import xxhash
    k = line.strip(BLANKS)
    if len(k) < min_chars:
        return None
    if len(k) < 4 * min_chars and not k.isascii() and len(k.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_64_intdigest(k.lower()) - (1 << 63)


class CuckooFilter:
    """Fingerprints of 16 bits, four to a bucket, in one of two buckets.

    ``insert`` moves others out of the way; should it fail, the filter grows
    to twice the size and is built anew from the caller's exact keys (see
    :func:`build_filter`), so no key is ever missing."""

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.mask = np.uint64(buckets - 1)
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @staticmethod
    def _mix(x):
        with np.errstate(over="ignore"):
            x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
            x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))

    def places(self, keys: np.ndarray):
        """Fingerprint and both buckets of some keys (int64)."""
        h = self._mix(keys.astype(np.int64).view(np.uint64))
        mark = (h >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = h & self.mask
        return mark, first, self.partner(first, mark)

    def partner(self, bucket, mark):
        return (bucket ^ self._mix(mark.astype(np.uint64) + np.uint64(1))) & self.mask

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, bool)
        mark, a, b = self.places(keys)
        return ((self.table[a] == mark[:, None]) | (self.table[b] == mark[:, None])).any(axis=1)

    def insert(self, key: int) -> bool:
        mark, a, b = self.places(np.array([key], np.int64))
        f, at = mark[0], int(a[0])
        for bucket in (at, int(b[0])):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = f
                return True
        at = int(b[0])
        for kick in range(MAX_KICKS):
            slot = (int(f) + kick) % SLOTS
            f, self.table[at, slot] = self.table[at, slot], f
            at = int(self.partner(np.array([at], np.uint64), np.array([f], np.uint16))[0])
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = f
                return True
        return False

    def delete(self, key: int) -> bool:
        """Take out one copy of a key that was inserted."""
        mark, a, b = self.places(np.array([key], np.int64))
        for bucket in (int(a[0]), int(b[0])):
            held = np.flatnonzero(self.table[bucket] == mark[0])
            if len(held):
                self.table[bucket, held[0]] = 0
                return True
        return False

    def dump(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        table = np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(table), table)


def build_filter(keys: np.ndarray) -> CuckooFilter:
    """A filter that holds all ``keys``."""
    buckets = 1 << max(1, math.ceil(math.log2(max(len(keys), 1) / (SLOTS * 0.85))))
    while True:
        out = CuckooFilter(buckets)
        if all(out.insert(int(k)) for k in keys):
            return out
        buckets *= 2


def shard_of(key, shards: int):
    return F.pmod(F.shiftright(key, 40), F.lit(shards))


def line_keys(df: DataFrame, min_chars: int) -> DataFrame:
    """``(key, doc_id)`` of every counted line of ``df(doc_id, text)``, once per row."""
    import pyarrow as pa

    def run(batches):
        for part in slices(batches):
            keys, ids = [], []
            for d, t in zip(part.column(0).to_pylist(), text_bytes(part.column(1))):
                if t:
                    own = {line_key(x, min_chars) for x in t.split(b"\n")} - {None}
                    keys += own
                    ids += [d] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.int64())],
                                             names=["key", "doc_id"])

    return small_batches(df).mapInArrow(run, "key long, doc_id long")


class LineIndex:
    """The state of a line dedup, one folder for each version of it.

    ``doc_id`` must be a number; a null one is a document of its own,
    smaller than all others.  Rows that repeat a doc_id are one document.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, min_chars: int = 20, min_docs: int = 3,
                 shard_keys: int = 1 << 16, broadcast_bytes: int = 32 << 20):
        self.spark, self.path = spark, path or scratch_path(spark, "lines")
        self.min_chars, self.min_docs, self.shard_keys = min_chars, min_docs, shard_keys
        self.broadcast_bytes = broadcast_bytes
        self.version, self.shards = 0, 0

    def _read(self, name: str, version: int) -> DataFrame:
        schema = {"changes": "key long, doc_id long, n long", "counts": "key long, n_docs long, keeper long, refs long",
                  "filters": "shard long, n_keys long, filter binary"}[name]
        return self.spark.read.schema(schema).parquet(f"{self.path}/v{version}/{name}")

    def counts(self) -> DataFrame | None:
        """``key, n_docs, keeper, refs``: the newest count of every key."""
        if self.version < 2:
            return self._read("counts", 1) if self.version else None
        each = [self._read("counts", v).withColumn("v", F.lit(v)) for v in range(1, self.version + 1)]
        newest = F.max_by(F.struct("n_docs", "keeper", "refs"), "v").alias("c")
        return reduce(DataFrame.unionByName, each).groupBy("key").agg(newest).select("key", "c.*").filter("refs > 0")

    def holders(self) -> DataFrame | None:
        """``key, doc_id, n``: how many rows of which document hold which key."""
        if not self.version:
            return None
        each = [self._read("changes", v) for v in range(1, self.version + 1)]
        return reduce(DataFrame.unionByName, each).groupBy("key", "doc_id").agg(F.sum("n").alias("n")).filter("n > 0")

    def filters(self) -> DataFrame:
        return self._read("filters", self.version)

    def _keys(self, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
        base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
        return line_keys(base, self.min_chars)

    def _held_by(self, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
        return self._keys(docs, doc_id, text).groupBy("key", "doc_id").agg(F.count("*").alias("n"))

    def insert(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineIndex:
        """Add documents."""
        return self._change(self._held_by(docs, doc_id, text))

    def delete(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineIndex:
        """Take documents out again (as they were inserted, by doc_id and text)."""
        if not self.version:
            return self
        gone = self._held_by(docs, doc_id, text).alias("g")
        return self._change(gone.join(self.holders().alias("h"), F.expr("g.key = h.key AND g.doc_id <=> h.doc_id"))
                            .select("g.key", "g.doc_id", (-F.least("g.n", "h.n")).alias("n")))

    def _change(self, changes: DataFrame) -> LineIndex:
        """Write the next version: the changes, the counts of their keys, the filters."""
        before, to = self.counts(), f"{self.path}/v{self.version + 1}"
        changes.write.parquet(f"{to}/changes")
        self.version += 1
        keys = self._read("changes", self.version).select("key").distinct()
        held = self.holders()
        if before is not None:
            held = held.join(keys, "key", "left_semi")
        count = held.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"),
                                        F.sum("n").alias("refs"))
        if before is not None:  # a key without holders is noted as such
            count = keys.join(count, "key", "left").fillna(0, ["n_docs", "refs"])
        count.write.parquet(f"{to}/counts")
        self._filters(before).write.parquet(f"{to}/filters")
        return self

    def _frequent_keys(self, counts: DataFrame) -> DataFrame:
        return counts.filter(F.col("n_docs") >= self.min_docs).select("key")

    def _filters(self, before: DataFrame | None) -> DataFrame:
        """The filters after the newest change: the last ones with the keys
        that crossed ``min_docs``, or new ones when shards are too full."""
        schema = "shard long, n_keys long, filter binary"
        all_now = self.counts()
        n = all_now.count()
        if before is None or n > 4 * self.shards * self.shard_keys:
            self.shards = shards = 1 + n // self.shard_keys

            def build(group):
                import pandas as pd
                keys = np.sort(group["key"].to_numpy(np.int64))
                return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "n_keys": [len(keys)],
                                     "filter": [build_filter(keys).dump()]})
            return self._frequent_keys(all_now).withColumn("shard", shard_of(F.col("key"), shards)).groupBy(
                "shard").applyInPandas(build, schema)

        def change(old, keys):
            import pandas as pd
            shard = int((old if len(old) else keys)["shard"].iloc[0])
            f = CuckooFilter.load(old["filter"].iloc[0]) if len(old) else build_filter(np.zeros(0, np.int64))
            final = np.sort(keys["key"].to_numpy(np.int64)[keys["after"].to_numpy(bool)])
            for k in keys["key"][keys["was"] & ~keys["after"]]:
                f.delete(int(k))
            if not all(f.insert(int(k)) for k in keys["key"][~keys["was"] & keys["after"]]):
                f = build_filter(final)  # too full: twice the size, from the exact keys
            return pd.DataFrame({"shard": [shard], "n_keys": [len(final)], "filter": [f.dump()]})

        now = self._frequent_keys(all_now).withColumn("after", F.lit(True))
        both = (now.join(self._frequent_keys(before).withColumn("was", F.lit(True)), "key", "full")
                .fillna(False, ["after", "was"]).withColumn("shard", shard_of(F.col("key"), self.shards)))
        return self._read("filters", self.version - 1).groupBy("shard").cogroup(both.groupBy("shard")).applyInPandas(
            change, schema)

    def _frequent(self, lines: DataFrame) -> DataFrame:
        """The ``(key, doc_id)`` rows that may be frequent, by the filters."""
        import pyarrow as pa
        filters, shards = self.filters(), self.shards
        size = filters.agg(F.coalesce(F.sum(F.length("filter")), F.lit(0))).first()[0]
        if size > self.broadcast_bytes:
            def ask(held: pa.Table, keys: pa.Table) -> pa.Table:
                if not held.num_rows:
                    return keys.select(["key"]).slice(0, 0)
                own = CuckooFilter.load(held.column("filter")[0].as_py())
                return keys.select(["key"]).filter(pa.array(own.contains(keys.column("key").to_numpy()), pa.bool_()))

            keys = lines.select("key").distinct().withColumn("shard", shard_of(F.col("key"), shards))
            maybe = filters.groupBy("shard").cogroup(keys.groupBy("shard")).applyInArrow(ask, "key long")
            return lines.join(maybe, "key", "left_semi")
        # Plain bytes travel: a task may run where this package is not installed.
        shared = self.spark.sparkContext.broadcast({r["shard"]: bytes(r["filter"]) for r in filters.collect()})

        def run(batches):
            held = {s: CuckooFilter.load(raw) for s, raw in shared.value.items()}
            for b in batches:
                keys = b.column(0).to_numpy(zero_copy_only=False)
                shard = (keys >> 40) % shards
                maybe = np.zeros(len(keys), bool)
                for s in np.unique(shard):
                    if s in held:
                        own = shard == s
                        maybe[own] = held[s].contains(keys[own])
                yield b.filter(pa.array(maybe, pa.bool_()))

        return lines.mapInArrow(run, "key long, doc_id long")

    def drop_lines(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """``docs`` with ``kept_text`` (string), ``n_lines`` and ``n_dropped``
        (long) after all its columns.  Null text counts as one empty line and
        gives the empty text.  Columns with those names are replaced."""
        import pyarrow as pa
        counts = self.counts()
        own = ["kept_text", "n_lines", "n_dropped"]
        base = docs.select(*[c for c in docs.columns if c not in own])
        min_chars, text_at = self.min_chars, base.columns.index(text)
        if counts is not None:
            maybe = self._frequent(self._keys(docs, doc_id, text))
            frequent = counts.filter(F.col("n_docs") >= self.min_docs).select("key", "keeper")
            drops = (maybe.join(frequent, "key").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
                     .groupBy("doc_id").agg(F.collect_set("key").alias("__drops"))
                     .withColumnRenamed("doc_id", "__drop_id"))
            base = base.join(drops, F.col(doc_id).cast("long").eqNullSafe(F.col("__drop_id")), "left").drop(
                "__drop_id")
        else:
            base = base.withColumn("__drops", F.lit(None).cast("array<long>"))
        schema = schema_with(base.drop("__drops"), kept_text="string", n_lines="long", n_dropped="long")

        def run(batches):
            for b in slices(batches):
                out, n_lines, n_dropped = [], [], []
                for t, drops in zip(text_bytes(b.column(text_at)), b.column(b.num_columns - 1).to_pylist()):
                    lines = (t or b"").split(b"\n")
                    gone = set(drops or ())
                    left = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
                    out.append(b"\n".join(left).decode("utf-8", "replace"))
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(left))
                cols = b.columns[:-1]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(out, pa.string()), pa.array(n_lines, pa.int64()),
                     pa.array(n_dropped, pa.int64())], names=[*b.schema.names[:-1], *own])

        return base.mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """Index all of ``docs`` and drop its repeated lines: see :meth:`LineIndex.drop_lines`."""
    return LineIndex(docs.sparkSession, **settings).insert(docs, doc_id, text).drop_lines(docs, doc_id, text)
