"""Approximate vector indexes: IVF_FLAT, IVF_SQ8, IVF_PQ (SRCH-2, -3, -4).

Build
    * cells: ``pyspark.ml`` KMeans trained on all rows (cosine: on unit
      vectors); every row is assigned to its nearest centroid with one BLAS
      product per Arrow batch (centroids broadcast: ``nlist x d`` numbers).
      The index is the corpus plus a ``cell`` column; written, it is
      range-clustered by (cell, id), so a hot cell is many files.
    * ``two_level=True``: KMeans makes about ``sqrt(nlist)`` branches, each is
      split into its share of the cells (KMeans in a task, on a bounded sample
      of the branch), and cells of over ``FULL`` times the mean are split
      again.  Rows and queries choose a branch first, then among its cells,
      so nothing is compared with all ``nlist`` centroids.
    * SQ8: per-dimension min/max (MLlib ``Summarizer``, an element-wise tree
      aggregate; dim-sized result), codes ``round((x-min)/(max-min)*255)``
      computed natively.
    * PQ: codes of the residual ``vector - centroid`` after a learned rotation
      (:mod:`quarry.operators.product_codes`), rotation and codebooks learned
      on a bounded sample (``train_rows`` rows), every row coded in
      ``mapInArrow`` (``d * d + 2**nbits * d`` numbers travel with the task).

Search is the search by lots of :mod:`quarry.operators.knn`: a query travels
once, with the list of its ``nprobe`` nearest cells, and a row goes to every
lot of queries that probes its cell; a cell that nothing probes is dropped
before it is shuffled.

:func:`exact_ivf_search` is exact without scanning all cells: the nearest
cells give every query a score to beat, and then only cells whose centroid
and radius allow a better one are scanned.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import check_metric, normalize, prepare_queries
from ..sources.segments import default_columns
from ..session import materialize
from .knn import _arrow_matrix, finish_search, knn_candidates, scope_corpus
from .product_codes import ProductCodes, learn, nearest, update
from .topk import rank_topk

KINDS = ("flat", "sq8", "pq")
INDEX_COLUMNS = ("cell", "sq8_codes", "pq_codes")
# A two-level cell of more than so many times the mean number of rows is split again.
FULL = 4
# Rows for each cell to be made that a branch is split by.
SPLIT_ROWS = 64


@dataclass
class IvfIndex:
    table: DataFrame  # corpus columns + cell (+ sq8_codes | pq_codes)
    centroids: np.ndarray  # (nlist, d) in the space rows were assigned in
    metric: str
    kind: str = "flat"
    vector_col: str = "embedding"
    sq8_min: np.ndarray | None = None
    sq8_max: np.ndarray | None = None
    pq: ProductCodes | None = None
    branches: np.ndarray | None = None  # two-level: (n, d) centroids of the branches
    branch_of: np.ndarray | None = None  # and the branch of each cell
    params: dict = field(default_factory=dict)

    @property
    def nlist(self) -> int:
        return len(self.centroids)

    def write(self, root: str) -> None:
        """Persist the index table clustered by cell (range-partitioned and
        sorted), plus the small arrays it needs."""
        (self.table.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id")
         .write.mode("error").parquet(f"{root}/table"))
        spark = self.table.sparkSession
        arrays = {"centroids": self.centroids, "sq8_min": self.sq8_min, "sq8_max": self.sq8_max,
                  "branches": self.branches, "branch_of": self.branch_of,
                  "rotation": self.pq and self.pq.rotation, "books": self.pq and self.pq.books}
        meta = {"metric": self.metric, "kind": self.kind, "vector_col": self.vector_col, "params": self.params,
                "arrays": {name: a.tolist() for name, a in arrays.items() if a is not None}}
        import json
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("error").text(
            f"{root}/meta")

    @staticmethod
    def read(spark: SparkSession, root: str) -> "IvfIndex":
        import json
        meta = json.loads(spark.read.text(f"{root}/meta").first()[0])
        arrays = {name: np.asarray(a, dtype=np.float64) for name, a in meta["arrays"].items()}
        pq = ProductCodes(arrays["rotation"], arrays["books"]) if "books" in arrays else None
        branch_of = arrays["branch_of"].astype(np.int64) if "branch_of" in arrays else None
        return IvfIndex(spark.read.parquet(f"{root}/table"), arrays["centroids"], meta["metric"], meta["kind"],
                        meta["vector_col"], arrays.get("sq8_min"), arrays.get("sq8_max"), pq,
                        arrays.get("branches"), branch_of, meta.get("params", {}))


def _train_frame(scope: DataFrame, vector_col: str, metric: str) -> DataFrame:
    vec = normalize(vector_col) if metric == "cosine" else F.col(vector_col)
    return scope.select(array_to_vector(vec).alias("features"))


def _kmeans(train: DataFrame, k: int, seed: int, max_iter: int):
    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cell").fit(train)


def _sq8_stats(scope: DataFrame, vector_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Per-dimension min and max: MLlib's ``Summarizer`` aggregates the
    vectors element-wise in the JVM (a tree aggregate, no explode of
    ``rows x dims``); the result is two dim-sized arrays."""
    summary = scope.select(Summarizer.metrics("min", "max").summary(array_to_vector(vector_col)).alias("s"))
    row = summary.select("s.min", "s.max").first()
    return np.asarray(row["min"].toArray(), dtype=np.float64), np.asarray(row["max"].toArray(), dtype=np.float64)


def sq8_encode(vector_col: str, mins: np.ndarray, maxs: np.ndarray):
    """Column of 8-bit codes, ``round((x - min) / (max - min) * 255)``
    clipped to 0..255 (0 where a dimension is constant)."""
    lo = F.array(*[F.lit(float(v)) for v in mins])
    rng = F.array(*[F.lit(float(h - l)) for l, h in zip(mins, maxs)])
    return F.transform(
        F.col(vector_col),
        lambda x, i: F.when(
            F.element_at(rng, i + 1) > 0,
            F.least(F.greatest(F.round((x.cast("double") - F.element_at(lo, i + 1))
                                       / F.element_at(rng, i + 1) * 255.0), F.lit(0.0)), F.lit(255.0)),
        ).otherwise(F.lit(0.0)).cast("int"),
    )


def sq8_vectors(mins: np.ndarray, maxs: np.ndarray):
    """The vectors that the codes of Arrow rows stand for."""
    rng = maxs - mins
    return lambda rows: mins[None, :] + _arrow_matrix(rows.column("sq8_codes")) / 255.0 * rng[None, :]


def _in_space(batch, vector_col: str, metric: str) -> np.ndarray:
    """The vectors of a batch in the space of the centroids."""
    return _placed(batch.column(vector_col), metric)


def _placed(vectors, metric: str) -> np.ndarray:
    """Vectors in the space of the centroids: cosine has unit vectors."""
    x = _arrow_matrix(vectors)
    if len(x) and metric == "cosine":
        n = np.linalg.norm(x, axis=1, keepdims=True)
        x = np.divide(x, n, out=np.zeros_like(x), where=n > 0)
    return x


def nearest_cells(x: np.ndarray, centroids: np.ndarray, branches, branch_of) -> np.ndarray:
    """The cell of every row: its nearest centroid, with two levels the
    nearest one of the nearest branch."""
    if not len(x):
        return np.zeros(0, np.int32)
    if branches is None:
        return nearest(x, centroids).astype(np.int32)
    out = np.zeros(len(x), np.int32)
    branch = nearest(x, branches)
    for one in np.unique(branch):
        rows, cells = np.flatnonzero(branch == one), np.flatnonzero(branch_of == one)
        out[rows] = cells[nearest(x[rows], centroids[cells])]
    return out


def _assign_cells(scope: DataFrame, vector_col: str, metric: str, centroids: np.ndarray, branches=None,
                  branch_of=None) -> DataFrame:
    """``scope`` with each row's ``cell``, by the rule that probes use.  A
    column: a reader that leaves the texts out never reads them."""
    bc = scope.sparkSession.sparkContext.broadcast((centroids, branches, branch_of))

    @F.arrow_udf("int")
    def cell(vectors: pa.Array) -> pa.Array:
        return pa.array(nearest_cells(_placed(vectors, metric), *bc.value), pa.int32())

    return scope.withColumn("cell", cell(vector_col))


def _split(assigned: DataFrame, vector_col: str, metric: str, parts: dict[int, int], counts: dict[int, int],
           seed: int, max_iter: int) -> dict[int, np.ndarray]:
    """New centroids for some cells: each is split into so many parts by
    KMeans in a task, on about ``SPLIT_ROWS`` of its rows for each part."""
    share = {c: min(1.0, SPLIT_ROWS * n / max(counts[c], 1)) for c, n in parts.items()}
    wanted = assigned.sparkSession.createDataFrame(
        [(int(c), int(n), float(share[c])) for c, n in parts.items()], "cell int, parts int, share double")
    drawn = (F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) / float(1 << 30)) < F.col("share")
    rows = assigned.join(wanted, "cell").where(drawn).select("cell", "parts", vector_col)

    def centers(table: pa.Table) -> pa.Table:
        x, k = _in_space(table, vector_col, metric), table.column("parts")[0].as_py()
        x = np.unique(x, axis=0)
        rng = np.random.default_rng(seed)
        c = x[rng.permutation(len(x))[:k]].copy()
        for _ in range(max_iter):
            c = update(x, c, nearest(x, c), rng)
        return pa.table({"cell": pa.array([table.column("cell")[0].as_py()] * len(c), pa.int32()),
                         "center": pa.array(c.tolist(), pa.list_(pa.float64()))})

    found: dict[int, list] = {}
    for r in rows.groupBy("cell").applyInArrow(centers, "cell int, center array<double>").toLocalIterator():
        found.setdefault(r["cell"], []).append(r["center"])  # nlist centroids in all
    return {c: np.array(v) for c, v in found.items()}


def _cell_counts(assigned: DataFrame) -> dict[int, int]:
    return {r["cell"]: r["n"] for r in assigned.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # <= nlist


def _two_levels(scope: DataFrame, vector_col: str, metric: str, nlist: int, n_rows: int, seed: int, max_iter: int):
    """Centroids, branches and the branch of each centroid."""
    model = _kmeans(_train_frame(scope, vector_col, metric), max(2, int(np.ceil(np.sqrt(nlist)))), seed, max_iter)
    branches = np.array(model.clusterCenters(), dtype=np.float64)
    by_branch = _assign_cells(scope, vector_col, metric, branches)
    counts = _cell_counts(by_branch)
    parts = {c: max(1, round(nlist * n / n_rows)) for c, n in counts.items()}
    split = _split(by_branch, vector_col, metric, parts, counts, seed, max_iter)
    cells = [split.get(b, branches[b:b + 1]) for b in range(len(branches))]
    centroids, branch_of = np.concatenate(cells), np.repeat(np.arange(len(branches)), list(map(len, cells)))
    assigned = _assign_cells(scope, vector_col, metric, centroids, branches, branch_of)
    counts = _cell_counts(assigned)
    mean = n_rows / len(centroids)
    full = {c: int(np.ceil(n / mean)) for c, n in counts.items() if n > FULL * mean}
    if full:
        split = _split(assigned, vector_col, metric, full, counts, seed + 1, max_iter)
        keep = np.setdiff1d(np.arange(len(centroids)), list(split))
        branch_of = np.concatenate((branch_of[keep], *[np.repeat(branch_of[c], len(v)) for c, v in split.items()]))
        centroids = np.concatenate((centroids[keep], *split.values()))
    return centroids, branches, branch_of


def _pq_train(assigned: DataFrame, n_rows: int, vector_col: str, metric: str, centroids: np.ndarray, m: int,
              nbits: int, seed: int, train_rows: int) -> ProductCodes:
    """Rotation and codebooks from about ``train_rows`` rows, drawn by a hash
    of the id: that sample, and no more, comes to the driver."""
    cut = int(min(1.0, train_rows / max(n_rows, 1)) * (1 << 30))
    drawn = assigned.where(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) < cut)
    sample = drawn.select("cell", vector_col).limit(2 * train_rows).toArrow()
    x = _in_space(sample, vector_col, metric)
    dim = centroids.shape[1]
    cells = sample.column("cell").to_numpy()
    return learn((x - centroids[cells]) if len(x) else np.zeros((0, dim)), m, nbits, seed=seed)


def _pq_assign(table: DataFrame, vector_col: str, metric: str, centroids: np.ndarray, pq: ProductCodes) -> DataFrame:
    bc = table.sparkSession.sparkContext.broadcast((centroids, pq.rotation, pq.books))

    @F.arrow_udf("array<int>")
    def codes(vectors: pa.Array, cells: pa.Array) -> pa.Array:
        c, rotation, books = bc.value
        x, m = _placed(vectors, metric), len(books)
        found = ProductCodes(rotation, books).encode(x - c[cells.to_numpy(zero_copy_only=False)]) if len(x) else \
            np.zeros((0, m), np.int32)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, (len(x) + 1) * m, m, dtype=np.int32)),
                                        pa.array(found.ravel()))

    return table.withColumn("pq_codes", codes(vector_col, "cell"))


def pq_vectors(centroids: np.ndarray, rotation: np.ndarray, books: np.ndarray):
    """The vectors that the codes of Arrow rows stand for: centroid plus decoded residual."""
    def decoded(rows) -> np.ndarray:
        codes = _arrow_matrix(rows.column("pq_codes")).astype(np.int64)
        cells = rows.column("_cell").to_numpy(zero_copy_only=False)
        return centroids[cells] + ProductCodes(rotation, books).decode(codes)
    return decoded


def one_dimension(scope: DataFrame, vector_col: str) -> tuple[int, int]:
    """Number of rows and the length of their vectors; vectors of several
    lengths, or with null or non-finite components, are an error that names them."""
    size = F.size(vector_col)
    odd = F.exists(F.col(vector_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    st = scope.agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("lo"), F.max(size).alias("hi"),
                   F.count_if(size != F.lit(0)).alias("some"), F.min_by("id", size).alias("lo_id"),
                   F.max_by("id", size).alias("hi_id"), F.count_if(odd).alias("odd")).first()
    if st["n"] and st["lo"] != st["hi"]:
        raise ValueError(f"{vector_col} has vectors of several lengths: {st['lo']} (id {st['lo_id']}) to {st['hi']} "
                         f"(id {st['hi_id']}); filter the table to one length first")
    if st["odd"]:
        raise ValueError(f"{vector_col} has {st['odd']} vectors with null or non-finite components")
    return int(st["n"]), int(st["hi"] or 0)


def build_ivf(corpus: DataFrame, nlist: int, metric: str = "cosine", *, kind: str = "flat",
              m: int = 8, nbits: int = 8, seed: int = 42, max_iter: int = 20,
              vector_col: str = "embedding", two_level: bool = False, train_rows: int = 1 << 16) -> IvfIndex:
    """Build an IVF index over the rows of ``corpus`` that have a vector.

    Vectors of several lengths are an error.  ``nlist=1`` is a flat SQ8 or PQ
    index.  Cells (MLlib KMeans) are trained on all rows; ``two_level`` makes
    about ``nlist`` cells in two steps.  PQ learns on ``train_rows`` rows.
    """
    metric = check_metric(metric)
    if kind not in KINDS:
        raise ValueError(f"unknown index kind {kind!r}; expected one of {KINDS}")
    scope = corpus.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0))
    n_rows, dim = one_dimension(scope, vector_col)
    if kind == "pq" and dim % m:
        raise ValueError(f"dimension {dim} is not divisible by m={m}")
    branches = branch_of = None
    if nlist <= 1 or n_rows == 0:
        centroids = np.zeros((1, dim))
        table = scope.withColumn("cell", F.lit(0))
    else:
        if two_level:
            centroids, branches, branch_of = _two_levels(scope, vector_col, metric, nlist, n_rows, seed, max_iter)
        else:
            model = _kmeans(_train_frame(scope, vector_col, metric), nlist, seed, max_iter)
            centroids = np.array(model.clusterCenters(), dtype=np.float64)
        table = _assign_cells(scope, vector_col, metric, centroids, branches, branch_of)
    index = IvfIndex(table, centroids, metric, kind, vector_col, branches=branches, branch_of=branch_of,
                     params={"nlist": len(centroids), "m": m, "nbits": nbits})
    if kind == "sq8":
        lo, hi = _sq8_stats(scope, vector_col)
        index.sq8_min, index.sq8_max = lo, hi
        index.table = table.withColumn("sq8_codes", sq8_encode(vector_col, lo, hi))
    elif kind == "pq":
        index.pq = _pq_train(table, n_rows, vector_col, metric, centroids, m, nbits, seed, train_rows)
        index.table = _pq_assign(table, vector_col, metric, centroids, index.pq)
    return index


def nearest_first(q: np.ndarray, near: int, centroids: np.ndarray, branches, branch_of) -> np.ndarray:
    """The ``near`` nearest cells of every query, nearest first.  With two
    levels they come from its ``near`` nearest branches, which hold as many cells at least."""
    near = min(near, len(centroids))
    if not len(q):
        return np.zeros((0, near), np.int32)
    cc = (centroids * centroids).sum(1)
    if branches is None or near >= len(branches):
        return np.argsort(cc[None, :] - 2 * (q @ centroids.T), axis=1, kind="stable")[:, :near].astype(np.int32)
    close = np.argsort((branches * branches).sum(1)[None, :] - 2 * (q @ branches.T), axis=1, kind="stable")[:, :near]
    out = np.zeros((len(q), near), np.int32)
    for i, mine in enumerate(close):
        cells = np.flatnonzero(np.isin(branch_of, mine))
        d2 = cc[cells] - 2 * (centroids[cells] @ q[i])
        out[i] = cells[np.argsort(d2, kind="stable")[:near]]
    return out


def _as_rows(lists):
    """Queries once for each cell of their list."""
    def rows(asked: DataFrame) -> DataFrame:
        given = lists(asked)
        return given.select(*[c for c in given.columns if c != "_cells"], F.explode("_cells").alias("_cell"))
    return rows


def _cell_lists(part: pa.RecordBatch, counts: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(cells.astype(np.int32)))
    return pa.RecordBatch.from_arrays([part.column("query_id"), part.column("_qv"), lists],
                                      names=["query_id", "_qv", "_cells"])


def _with_cells(asked: DataFrame) -> T.StructType:
    return T.StructType([asked.schema["query_id"], asked.schema["_qv"], T.StructField("_cells", T.ArrayType(T.IntegerType()))])


def probe_cells(index: IvfIndex, nprobe: int):
    """The queries once for each of their ``nprobe`` nearest cells (column ``_cell``)."""
    return _as_rows(probe_lists(index, nprobe))


def probe_lists(index: IvfIndex, nprobe: int):
    """The queries with their ``nprobe`` nearest cells in ``_cells`` (the same
    L2 rule rows were assigned by; cosine queries as unit vectors)."""
    def probes(asked: DataFrame) -> DataFrame:
        bc = asked.sparkSession.sparkContext.broadcast(
            (index.centroids, index.branches, index.branch_of))  # nlist x d numbers
        metric = index.metric

        def run(batches):
            c = bc.value[0]
            for batch in batches:
                length = pc.fill_null(pc.list_value_length(batch.column("_qv")), 0).to_numpy(zero_copy_only=False)
                # The one cell of a flat index takes queries of every length.
                good = np.flatnonzero(length > 0 if len(c) == 1 else length == c.shape[1])
                part = batch.take(pa.array(good))
                if len(c) == 1:
                    cells = np.zeros((len(good), 1), np.int32)
                else:
                    q, _ = prepare_queries(_arrow_matrix(part.column("_qv")), metric)
                    cells = nearest_first(q, nprobe, *bc.value)
                yield _cell_lists(part, np.full(len(good), cells.shape[1]), cells.ravel())

        return asked.mapInArrow(run, _with_cells(asked))
    return probes


def ivf_search(index: IvfIndex, queries: DataFrame, k: int = 10, offset: int = 0, *, nprobe: int = 8,
               pred=None, partitions=None, threshold: float | None = 0.0, columns=None,
               query_vector_col: str = "vector", rerank: int = 0) -> DataFrame:
    """Approximate top-k (SRCH-2 IVF_FLAT, SRCH-3 IVF_SQ8, SRCH-4 IVF_PQ; the
    cell join JOI-3): only the ``nprobe`` nearest cells of each query are
    scored (``nprobe >= nlist`` is exact).  SQ8 and PQ score decoded vectors;
    ``rerank=r`` ranks the best ``r*k`` of these by their raw vectors, which
    travel with the codes, so that candidates need no join."""
    if nprobe < 1:
        raise ValueError("nprobe must be >= 1")
    metric = index.metric
    scope = scope_corpus(index.table, pred, partitions)
    vectors_of, valid_col = None, index.vector_col
    if index.kind == "sq8":
        vectors_of, valid_col = sq8_vectors(index.sq8_min, index.sq8_max), "sq8_codes"
    elif index.kind == "pq":
        vectors_of, valid_col = pq_vectors(index.centroids, index.pq.rotation, index.pq.books), "pq_codes"
    again = index.vector_col if rerank and index.kind != "flat" else None
    kk = (k + offset) * (max(1, rerank) if index.kind != "flat" else 1)
    cols = [valid_col] + ([again] if again else [])
    cands = knn_candidates(scope.select("partition_name", "id", "cell", *cols), queries, kk, metric=metric,
                           vector_col=index.vector_col, query_vector_col=query_vector_col, vectors_of=vectors_of,
                           cell_col="cell", probe_fn=probe_lists(index, nprobe), valid_col=valid_col, rescore_col=again)
    if again:
        cands = rank_topk(cands, kk).select("query_id", "partition_name", "id", F.col("true_score").alias("score"),
                                            F.col("true_distance").alias("distance"))
    if columns is None:  # the corpus's own columns, not the index's
        columns = [c for c in default_columns(scope) if c not in INDEX_COLUMNS and c != index.vector_col]
    return finish_search(cands, scope, queries, k, offset, threshold, columns, False, index.vector_col)


def cell_radii(index: IvfIndex) -> np.ndarray:
    """The largest distance of a row of each cell from its centroid: largest
    of each batch first, then of each cell; ``nlist`` numbers come back."""
    bc = index.table.sparkSession.sparkContext.broadcast(index.centroids)
    vector_col, metric = index.vector_col, index.metric

    def farthest(batches):
        for batch in batches:
            x, cells = _in_space(batch, vector_col, metric), batch.column("cell").to_numpy(zero_copy_only=False)
            far = np.zeros(len(bc.value))
            if len(x):
                np.maximum.at(far, cells, np.linalg.norm(x - bc.value[cells], axis=1))
            own = np.unique(cells).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(far[own])], names=["cell", "far"])

    out = np.zeros(index.nlist)
    rows = index.table.select("cell", vector_col).mapInArrow(farthest, "cell int, far double")
    for r in rows.groupBy("cell").agg(F.max("far").alias("far")).collect():
        out[r["cell"]] = r["far"]
    return out


def best_possible(q: np.ndarray, centroids: np.ndarray, radii: np.ndarray, metric: str) -> np.ndarray:
    """An upper bound of the score of any row of each cell, for prepared queries."""
    if metric == "ip":
        return q @ centroids.T + np.linalg.norm(q, axis=1)[:, None] * radii[None, :]
    cc, qq = (centroids * centroids).sum(1), (q * q).sum(1)
    d = np.sqrt(np.maximum(qq[:, None] + cc[None, :] - 2.0 * (q @ centroids.T), 0.0))
    least = np.maximum(d - radii[None, :], 0.0)
    return 1.0 - least * least / 2.0 if metric == "cosine" else 1.0 / (1.0 + least)


# Scores are ranked after rounding to 6 places: a bound has to be below by more than that.
SLACK = 2e-6


def promising_cells(index: IvfIndex, to_beat: DataFrame, radii: np.ndarray, seen: int):
    """The queries once for each cell (column ``_cell``) of :func:`promising_lists`."""
    return _as_rows(promising_lists(index, to_beat, radii, seen))


def promising_lists(index: IvfIndex, to_beat: DataFrame, radii: np.ndarray, seen: int):
    """The queries with the cells that may hold a better row than
    ``to_beat(query_id, least)`` says, without their ``seen`` nearest cells."""
    def probes(asked: DataFrame) -> DataFrame:
        bc = asked.sparkSession.sparkContext.broadcast((index.centroids, index.branches, index.branch_of, radii))
        metric = index.metric

        def run(batches):
            c, branches, branch_of, far = bc.value
            for batch in batches:
                length = pc.fill_null(pc.list_value_length(batch.column("_qv")), 0).to_numpy(zero_copy_only=False)
                part = batch.take(pa.array(np.flatnonzero(length == c.shape[1])))
                if not part.num_rows:
                    continue
                q, _ = prepare_queries(_arrow_matrix(part.column("_qv")), metric)
                least = part.column("least").to_numpy(zero_copy_only=False)
                may = best_possible(q, c, far, metric) >= np.where(np.isnan(least), -np.inf, least)[:, None] - SLACK
                np.put_along_axis(may, nearest_first(q, seen, c, branches, branch_of).astype(np.int64), False, axis=1)
                yield _cell_lists(part, may.sum(axis=1), np.nonzero(may)[1])

        return (asked.join(to_beat, "query_id", "left").select("query_id", "_qv", "least")
                .mapInArrow(run, _with_cells(asked)))
    return probes


def exact_ivf_search(index: IvfIndex, queries: DataFrame, k: int = 10, offset: int = 0, *, first: int = 1, pred=None,
                     partitions=None, threshold: float | None = 0.0, columns=None,
                     query_vector_col: str = "vector") -> DataFrame:
    """Exact top-k from a flat index: the result of ``vector_search``, without
    scoring every row.  The ``first`` nearest cells are scanned, and their
    ``offset + k``-th score is what other cells have to beat; by the triangle
    inequality a cell whose centroid is too far for its radius cannot, and is
    not scanned.  A query that finds too few rows there scans all cells."""
    if index.kind != "flat":
        raise ValueError("exact search needs a flat index")
    scope, kk = scope_corpus(index.table, pred, partitions), k + offset
    rows = scope.select("partition_name", "id", "cell", index.vector_col)
    common = dict(metric=index.metric, vector_col=index.vector_col, query_vector_col=query_vector_col,
                  cell_col="cell")
    near = materialize(rank_topk(knn_candidates(rows, queries, kk, probe_fn=probe_lists(index, first), **common), kk)
                       .drop("rank"), "nearest-cells")
    to_beat = near.groupBy("query_id").agg(F.when(F.count("*") >= kk, F.min("score")).alias("least"))
    if threshold is not None:
        to_beat = to_beat.withColumn("least", F.greatest("least", F.lit(float(threshold))))
    far = knn_candidates(rows, queries, kk, probe_fn=promising_lists(index, to_beat, cell_radii(index), first), **common)
    if columns is None:
        columns = [c for c in default_columns(scope) if c not in INDEX_COLUMNS and c != index.vector_col]
    return finish_search(near.unionByName(far), scope, queries, k, offset, threshold, columns, False, index.vector_col)


def recall_at_k(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Per query: share of the exact top-k that the approximate search found."""
    keys = ["query_id", "partition_name", "id"]
    hit = exact.select(*keys).join(approx.select(*keys), keys, "left_semi").groupBy("query_id").count()
    tot = exact.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    return tot.join(hit, "query_id", "left").select(
        "query_id", (F.coalesce(F.col("count"), F.lit(0)) / F.col("n")).alias("recall"))
