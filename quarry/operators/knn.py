"""Dense-vector top-k (SRCH-1, plus the search by lots used by SRCH-2/3/4).

Plan, for a table of queries against a corpus of N rows:

1. Scope the corpus first (partition list, predicate): plain filters that
   reach the scan.
2. Deal the queries into lots of at most about ``QUERY_ROWS`` by a hash of the
   id, and with few lots the corpus into stripes.  Both numbers are aggregates
   inside the plan; nothing passes through the driver.
3. A task holds one lot and reads its stripe as a stream, in the order of ids
   (Spark sorts it).  It keeps the best ``offset+k`` rows of each query; a
   single-precision matrix product with a proven margin says which rows may be
   among them, and only those are scored, in double precision.  A task's
   memory depends on the lot and the Arrow batch only, and what it returns on
   the lot only.
4. An IVF search sends each query once, with the list of the cells it probes,
   and each row once to every lot that probes its cell.
5. A per-query ``row_number`` top-k over the stripes' winners.
6. Wide output columns are joined back for the k winners only.

Vectors of another length than the query's never rank, and a query without a
vector ranks nothing; neither fails the job.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import check_metric, prepare_queries, round_score, score_matrix, topk_per_column
from ..sources.segments import default_columns
from .topk import apply_threshold, rank_topk

# Largest score matrix (n rows x m queries) computed at once inside a task.
_MAX_CELLS = 4_000_000
# Queries of a lot (200 MB of 1,536 dimensions); the corpus is shuffled once
# for each lot.  A lot keeps about ``KEPT`` winners at most, and lots are
# smaller while the cores would idle, down to ``LEAST_ROWS``.
QUERY_ROWS = 16_384
KEPT = 1 << 20
LEAST_ROWS = 1_024
# Rows of a stripe at least.
CORPUS_ROWS = 16_384


def scope_corpus(corpus: DataFrame, pred=None, partitions=None) -> DataFrame:
    """FLT-1 / FLT-4: partition list and predicate, applied before ranking."""
    out = corpus
    if partitions:
        names = [partitions] if isinstance(partitions, str) else list(partitions)
        out = out.where(F.col("partition_name").isin(names))
    if pred is not None:
        cond = F.expr(pred) if isinstance(pred, str) else pred
        if not (isinstance(pred, str) and not pred.strip()):
            out = out.where(cond)  # as it is, so that it reaches the scan
    return out


def _arrow_matrix(col: pa.Array) -> np.ndarray:
    """A list<float> Arrow column of equal-length rows as an (n, d) float64 matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0:
        return np.zeros((0, 0))
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(n, -1)


def raw_vectors(vector_col: str):
    """The (n, d) vectors of some rows of one length, as they are stored."""
    return lambda rows: _arrow_matrix(rows.column(vector_col))


class _Lot:
    """The queries of a lot that have one length, and the best ``kk`` rows
    of each so far.  Rows come in the order of ids, so that of rows with the
    same rounded score an earlier one is never displaced."""

    def __init__(self, at: np.ndarray, q: np.ndarray, cells: list | None, kk: int, metric: str, rescored: bool):
        self.at, self.kk, self.metric, self.rescored = at, kk, metric, rescored
        self.q, ok = prepare_queries(q, metric)
        self.ok = np.flatnonzero(ok)
        self.size = np.linalg.norm(self.q, axis=1)
        self.odd = ~np.isfinite(self.size)
        self.least = np.full(len(q), -np.inf)  # the rounded score that a row has to beat
        self.seen, self.pending, self.kept = 0, [], None
        self.by_cell = None
        if cells is not None:
            cells = [cells[i] for i in self.ok]
            flat = np.concatenate(cells) if cells else np.zeros(0, np.int64)
            owner = np.repeat(self.ok, [len(c) for c in cells])
            order = np.argsort(flat, kind="stable")
            names, starts = np.unique(flat[order], return_index=True)
            self.by_cell = dict(zip(names.tolist(), np.split(owner[order], starts[1:]))) if len(names) else {}

    def read(self, x: np.ndarray, first: int, names: tuple, cells: np.ndarray | None, raw: np.ndarray | None) -> None:
        """Takes rows ``x``; ``first`` and up are their places in the stripe."""
        done = 0
        while done < len(x):  # few rows at first: they give the score to beat
            n = min(len(x) - done, max(256, 4 * self.kk, self.seen))
            rows = np.arange(done, done + n)
            if cells is None:
                self._scan(x, rows, self.ok, first, names, raw)
            else:
                asked = {c: self.by_cell.get(c) for c in np.unique(cells[rows]).tolist()}
                every = [c for c, q in asked.items() if q is not None and len(q) == len(self.ok)]
                groups = [(rows[np.isin(cells[rows], every)], self.ok)] if every else []
                groups += [(rows[cells[rows] == c], q) for c, q in asked.items() if q is not None and c not in every]
                for own, q in groups:
                    self._scan(x, own, q, first, names, raw)
            done += n
            self.seen += n
            if self.seen < 1 << 14 or sum(len(p[0]) for p in self.pending) > len(self.q) * self.kk // 2:
                self.merge()

    def _scan(self, x: np.ndarray, rows: np.ndarray, queries: np.ndarray, first: int, names: tuple, raw) -> None:
        x, raw = x[rows], None if raw is None else raw[rows]
        long = np.linalg.norm(x, axis=1)
        plain = np.isfinite(long) if self.metric != "cosine" else np.isfinite(long) & (long > 0)
        odd = np.flatnonzero(~np.isfinite(long))
        step = max(1, _MAX_CELLS // max(len(x), 1))
        strange = queries[self.odd[queries]]
        if len(odd) or len(strange):  # non-finite components: scored as they are
            for part, some in ((strange, np.arange(len(x))), (queries[~self.odd[queries]], odd)):
                for a in range(0, len(part) if len(some) else 0, step):
                    self._plainly(x, some, part[a:a + step], rows, first, names, raw)
        queries, good = queries[~self.odd[queries]], np.flatnonzero(plain)
        if not len(queries) or not len(good):
            return
        most, dim = long[good].max(), x.shape[1]
        y = x[good] / long[good, None] if self.metric == "cosine" else x[good]
        single = max(most, most * most, 1.0) * max(self.size[queries].max(), 1.0) < 1e30
        kind, eps = (np.float32, 6e-8) if single else (np.float64, 2.3e-16)
        if self.metric == "l2":
            y = np.concatenate((y, -0.5 * (long[good] ** 2)[:, None]), axis=1)
        y = y.astype(kind).T
        for a in range(0, len(queries), step):
            part = queries[a:a + step]
            q, least, size = self.q[part], self.least[part] - 1e-6, self.size[part]
            if self.metric == "l2":
                q = np.concatenate((q, np.ones((len(q), 1))), axis=1)
                far = 1.0 / np.where(least > 0, least, np.nan) - 1.0
                limit = 0.5 * (size * size - far * far)
                slack = (dim + 9) * eps * (size * most + 0.5 * most * most + size * size)
            else:
                limit, slack = least, (dim + 9) * eps * size * (1.0 if self.metric == "cosine" else most)
            limit = np.nan_to_num(limit - slack - 1e-30, nan=-np.inf)
            if kind is np.float32:  # rounded down, and not beyond the type
                limit = np.nextafter(np.clip(limit, -3e38, 3e38).astype(kind), kind(-np.inf))
            limit = np.where(np.isfinite(least), limit, -np.inf).astype(kind)
            flat = np.flatnonzero((q.astype(kind) @ y) >= limit[:, None])
            qi, ri = np.divmod(flat, len(good))
            many = np.bincount(qi, minlength=len(part)) > max(64, 4 * self.kk)
            if many.any():
                self._plainly(x, good, part[many], rows, first, names, raw)
                few = ~many[qi]
                qi, ri = qi[few], ri[few]
            if len(qi):
                self._take(*self._pairs(x, good[ri], part[qi]), part[qi], good[ri], x, rows, first, names, raw)

    def _pairs(self, x: np.ndarray, r: np.ndarray, q: np.ndarray, exact=None):
        """Scores and distances of pairs of a row and a query."""
        s, d = np.empty(len(r)), np.empty(len(r))
        for a in range(0, len(r), 1 << 16):
            own, asked = x[r[a:a + (1 << 16)]], self.q[q[a:a + (1 << 16)]]
            prod = np.einsum("ij,ij->i", own, asked)
            part = slice(a, a + len(prod))
            if self.metric == "ip":
                s[part] = d[part] = prod
            elif self.metric == "cosine":
                with np.errstate(divide="ignore", invalid="ignore"):
                    s[part] = d[part] = prod / np.linalg.norm(own, axis=1)
            else:
                square = np.einsum("ij,ij->i", own, own) + np.einsum("ij,ij->i", asked, asked) - 2.0 * prod
                d[part] = np.sqrt(np.maximum(square, 0.0))
                s[part] = 1.0 / (1.0 + d[part])
        return s, d

    def _plainly(self, x, some, queries, rows, first, names, raw) -> None:
        """All pairs scored in double precision: the first rows, and many equal ones."""
        with np.errstate(invalid="ignore", over="ignore"):
            s, d = score_matrix(x[some], self.q[queries], self.metric)
            r, c = topk_per_column(s, self.kk)
        self._take(s[r, c], d[r, c], queries[c], some[r], x, rows, first, names, raw)

    def _take(self, s, d, q, r, x, rows, first, names, raw) -> None:
        score = round_score(s)
        with np.errstate(invalid="ignore"):
            better = np.flatnonzero((score > self.least[q]) & np.isfinite(score))
        s, d, q, r, score = s[better], d[better], q[better], r[better], score[better]
        more = self._pairs(raw, r, q) if self.rescored else ()
        at = rows[r]
        self.pending.append((q, score, first + at, s, d, names[0][at], names[1][at], *more))

    def merge(self) -> None:
        if not self.pending:
            return
        found = self.pending + ([self.kept] if self.kept is not None else [])
        found = [np.concatenate(f) for f in zip(*found)]
        order = np.lexsort((found[2], -found[1], found[0]))
        q = found[0][order]
        start = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
        rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
        order = order[rank < self.kk]
        self.kept, self.pending = tuple(f[order] for f in found), []
        last = order[rank[rank < self.kk] == self.kk - 1]
        self.least[found[0][last]] = found[1][last]


def _best_rows(vectors_of, kk: int, metric: str, valid_col: str, rescore_col: str | None, by_cell: bool):
    """The task of step 3, for ``mapInArrow``: the queries of each lot come
    first, then the rows."""

    def lots_of(asked: pa.Table) -> list[_Lot]:
        vectors, lots = asked.column("_qv").combine_chunks(), []
        length = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
        cells = asked.column("_cells").combine_chunks() if by_cell else None
        for dim in np.unique(length[length > 0]):
            at = np.flatnonzero(length == dim)
            own = None
            if by_cell:
                part = cells.take(pa.array(at))
                ends = np.cumsum(pc.list_value_length(part).to_numpy(zero_copy_only=False))
                own = np.split(part.flatten().to_numpy(zero_copy_only=False), ends[:-1])
            lots.append(_Lot(at, _arrow_matrix(vectors.take(pa.array(at))), own, kk, metric, rescore_col is not None))
        return lots

    def winners(asked: pa.Table, lots: list[_Lot]):
        for lot in lots:
            lot.merge()
            if lot.kept is not None and len(lot.kept[0]):
                q, _, _, s, d, ids, parts, *more = lot.kept
                columns = [asked.column("query_id").combine_chunks().take(pa.array(lot.at[q])),
                           pa.array(parts, pa.string()), pa.array(ids, pa.string()), pa.array(s), pa.array(d),
                           *map(pa.array, more)]
                names = ["query_id", "partition_name", "id", "score", "distance", "true_score", "true_distance"]
                yield pa.RecordBatch.from_arrays(columns, names=names[:len(columns)])

    def read(lots: list[_Lot], batch: pa.RecordBatch, first: int) -> None:
        names = batch.column("id").to_numpy(zero_copy_only=False), batch.column("partition_name").to_numpy(zero_copy_only=False)
        cells = batch.column("_cell").to_numpy(zero_copy_only=False) if by_cell else None
        length = pc.fill_null(pc.list_value_length(batch.column(valid_col)), 0).to_numpy(zero_copy_only=False)
        for n in np.unique(length[length > 0]):
            rows = np.flatnonzero(length == n)
            part = batch.take(pa.array(rows))
            x = vectors_of(part)
            raw = _arrow_matrix(part.column(rescore_col)) if rescore_col else None
            for lot in lots:
                if lot.q.shape[1] == x.shape[1]:
                    lot.read(x, first, tuple(c[rows] for c in names), None if cells is None else cells[rows], raw)

    def run(batches):
        group, asked, lots, first = None, [], None, 0
        for batch in batches:
            groups = batch.column("_g").to_numpy()
            tags = batch.column("_tag").to_numpy()
            cuts = np.flatnonzero((np.diff(groups) != 0) | (np.diff(tags) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if groups[a] != group:
                    if lots:
                        yield from winners(asked, lots)
                    group, asked, lots, first = groups[a], [], None, 0
                part = batch.slice(a, b - a)
                if tags[a] == 0:
                    asked.append(part)
                    continue
                if lots is None:
                    asked = pa.Table.from_batches(asked).select([c for c in ("query_id", "_qv", "_cells") if c in part.schema.names]) if asked else None
                    lots = lots_of(asked) if asked is not None else []
                read(lots, part, first)
                first += part.num_rows
        if lots:
            yield from winners(asked, lots)

    return run


def query_vectors(queries: DataFrame, query_vector_col: str) -> DataFrame:
    """``query_id`` (long for whole numbers, else string) and ``_qv``.  No
    filter stands on the vector: it may be a model's output, and Catalyst
    would copy the model call into the filter."""
    whole = isinstance(queries.schema["query_id"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return queries.select(F.col("query_id").cast("long" if whole else "string").alias("query_id"),
                          F.col(query_vector_col).cast("array<double>").alias("_qv"))


def knn_candidates(scope: DataFrame, queries: DataFrame, kk: int, *, metric: str = "cosine",
                   vector_col: str = "embedding", query_vector_col: str = "vector", vectors_of=None,
                   cell_col: str | None = None, probe_fn=None, valid_col: str | None = None,
                   rescore_col: str | None = None) -> DataFrame:
    """Up to ``kk`` best rows per query and stripe (not yet globally ranked).

    ``vectors_of(rows)`` gives the vectors of Arrow rows (raw vectors by
    default; SQ8/PQ pass their decoders).  With ``cell_col``,
    ``probe_fn(queries)`` gives each query the list of the cells it probes
    (column ``_cells``).  ``rescore_col`` adds ``true_score`` and
    ``true_distance`` by the vectors of that column.
    """
    metric = check_metric(metric)
    spark = scope.sparkSession
    cores = spark.sparkContext.defaultParallelism
    asked = query_vectors(queries, query_vector_col)
    qid = asked.schema["query_id"].dataType.simpleString()
    most = min(QUERY_ROWS, max(1, KEPT // max(kk, 1)))
    # One-row aggregates as scalar subqueries: no join, and no job while the plan is made.
    n = F.count("*")
    lots = queries.agg(F.greatest(F.lit(1), F.ceil(n / most), F.least(F.lit(2 * cores), F.ceil(n / LEAST_ROWS))).cast("int")).scalar()
    stripes = scope.agg(F.greatest(F.lit(1), F.ceil(n / CORPUS_ROWS)).cast("int")).scalar()
    rows = scope if cell_col is None else scope.withColumn("_cell", F.col(cell_col))
    asked = asked if cell_col is None else probe_fn(asked)

    def sized(df: DataFrame) -> DataFrame:
        return df.withColumn("_lots", lots).withColumn(
            "_stripes", F.least(stripes, F.ceil(F.lit(2 * cores) / F.col("_lots")).cast("int")))

    lot = F.pmod(F.xxhash64("query_id"), F.col("_lots")).cast("int")
    asked = sized(asked).withColumn("_lot", lot)
    rows = sized(rows)
    if cell_col is None:
        rows = rows.withColumn("_lot", F.explode(F.sequence(F.lit(0), F.col("_lots") - 1)))
    else:  # to each lot that probes the row's cell
        rows = rows.join(asked.select("_lot", F.explode("_cells").alias("_cell")).distinct(), "_cell")
    stripe = F.pmod(F.xxhash64("id"), F.col("_stripes")).cast("int")
    carried = [c for c in rows.columns if c not in ("_lots", "_stripes", "_lot", cell_col)]
    rows = rows.select((F.col("_lot") * F.col("_stripes") + stripe).alias("_g"), F.lit(1).alias("_tag"), *carried)
    every = F.explode(F.sequence(F.lit(0), F.col("_stripes") - 1)).alias("_s")
    asked = (asked.select("*", every).withColumn("_g", F.col("_lot") * F.col("_stripes") + F.col("_s"))
             .withColumn("_tag", F.lit(0)).drop("_lots", "_stripes", "_lot", "_s"))
    n_tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * cores)
    dealt = (asked.unionByName(rows, allowMissingColumns=True).repartitionById(n_tasks, F.pmod("_g", F.lit(n_tasks)))
             .sortWithinPartitions("_g", "_tag", "id", "partition_name"))
    run = _best_rows(vectors_of or raw_vectors(vector_col), kk, metric, valid_col or vector_col, rescore_col,
                     cell_col is not None)
    more = ", true_score double, true_distance double" if rescore_col else ""
    return dealt.mapInArrow(run, f"query_id {qid}, partition_name string, id string, score double, distance double{more}")


def attach_columns(ranked: DataFrame, scope: DataFrame, columns) -> DataFrame:
    """Join the requested document columns back onto the k winners per query.

    The winners table is at most ``queries * k`` rows: AQE broadcasts it
    from its measured size and the corpus side is a column-pruned scan;
    beyond the broadcast threshold the join shuffles on the key.
    """
    cols = [c for c in columns if c not in ("partition_name", "id")]
    if not cols:
        return ranked
    side = scope.select("partition_name", "id", *cols)
    return side.join(ranked, ["partition_name", "id"], "inner")


def vector_search(corpus: DataFrame, queries: DataFrame, k: int = 10, offset: int = 0, *,
                  metric: str = "cosine", pred=None, partitions=None, threshold: float | None = 0.0,
                  columns=None, vector_col: str = "embedding", query_vector_col: str = "vector",
                  include_vectors: bool = False) -> DataFrame:
    """Exact top-k by ``metric`` for every query row (SRCH-1; the theta /
    top-k join JOI-2, planned as pairs of blocks, not a cross join).

    ``queries`` needs ``query_id`` and ``query_vector_col``.  Result:
    ``query_id, rank, partition_name, id, score, distance`` + ``columns``
    (PRJ-1 defaults: all non-vector columns; ``[]`` for none).
    """
    metric = check_metric(metric)
    scope = scope_corpus(corpus, pred, partitions)
    cands = knn_candidates(scope.select("partition_name", "id", vector_col), queries, k + offset,
                           metric=metric, vector_col=vector_col, query_vector_col=query_vector_col)
    return finish_search(cands, scope, queries, k, offset, threshold, columns, include_vectors, vector_col)


def finish_search(cands: DataFrame, scope: DataFrame, queries: DataFrame, k: int, offset: int,
                  threshold, columns, include_vectors: bool, vector_col: str = "embedding") -> DataFrame:
    ranked = rank_topk(cands, k, offset).withColumn("distance", F.round("distance", 6))
    ranked = apply_threshold(ranked, threshold)
    cols = [c for c in default_columns(scope) if c != vector_col] if columns is None else list(columns)
    if include_vectors and vector_col not in cols:
        cols.append(vector_col)
    ranked = ranked.select("query_id", "rank", "partition_name", "id", "score", "distance")
    return attach_columns(ranked, scope, cols)
