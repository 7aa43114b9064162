"""Nearest neighbours by multi-index hashing of learned binary codes.

Codes: inner products become angles by giving every vector one more
component, ``sqrt(max_norm ** 2 - norm ** 2)`` (0 for queries).  Rotations
learned on a bounded sample (iterative quantization: alternate the signs and
the rotation that fits them best) turn a vector into ``bits`` signs.

Index: codes are cut into 16-bit substrings and each substring has an index
of its own, value to rows.  If two codes differ in at most ``r`` bits, then
by the pigeonhole principle some substring differs in at most ``r // m``
bits (and all but the first ``r % m + 1`` need only be searched one bit
less), so probing the substring indexes finds every code within ``r``.
Those within ``r`` are ranked by their exact inner products.

The radius is the one that holds ``aim`` of the true neighbours within the
sample.  The sample's neighbours are farther than those among all rows, so
the recall over all rows is higher.  Queries that find fewer than ``k`` rows
within it, all blocks together, are asked again with twice the radius, up to
all bits, where every row is found: each gets ``k`` rows, or all there are.

All rows are indexed.  Rows are dealt into blocks by a hash of the id (no
block is ever hot), queries into blocks as well, and each pair of blocks is
one task of fixed size: the queries go to every index block, and a task
returns the ``k`` best of its block for each query, so a shuffle of ``k``
rows for each query and block finishes the search.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored


@dataclass
class BinaryCodes:
    """Learned projections (size fixed by dimension and bits) and the search radius."""

    dim: int
    max_norm: float
    projection: np.ndarray = field(repr=False)  # dim + 1 x bits
    radius: int = 0

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        extra = np.zeros(len(x)) if query else np.sqrt(
            np.maximum(self.max_norm ** 2 - (x * x).sum(axis=1), 0.0))
        return np.concatenate((x, extra[:, None]), axis=1)

    def encode(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Codes as rows of 16-bit substrings."""
        signs = self.lift(x, query) @ self.projection > 0
        return np.packbits(signs, axis=1).view(np.uint16)


def learn_codes(sample: np.ndarray, max_norm: float, bits: int, k: int, aim: float, rounds: int = 20,
                seed: int = 5) -> BinaryCodes:
    """Rotations by iterative quantization and a radius, from a sample of rows."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    codes = BinaryCodes(dim, max_norm, np.zeros((dim + 1, 0)))
    lifted = codes.lift(sample, query=False)
    blocks = []
    while sum(b.shape[1] for b in blocks) < bits:
        r = np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0]
        for _ in range(rounds):
            signs = np.where(lifted @ r > 0, 1.0, -1.0)
            u, _, vt = np.linalg.svd(lifted.T @ signs)
            r = u @ vt
        blocks.append(r)
    codes.projection = np.concatenate(blocks, axis=1)[:, :bits]
    chosen = rng.permutation(len(sample))[:512]
    near = min(k, len(sample) - 1)
    if near < 1:
        codes.radius = bits
        return codes
    scores = sample[chosen] @ sample.T
    scores[np.arange(len(chosen)), chosen] = -np.inf
    top = np.argpartition(-scores, near - 1, axis=1)[:, :near]
    far = hamming(codes.encode(sample[chosen], query=True), codes.encode(sample))
    codes.radius = int(np.quantile(np.take_along_axis(far, top, axis=1), aim, method="higher"))
    return codes


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which every code of ``a`` differs from every code of ``b``."""
    out = np.zeros((len(a), len(b)), np.uint16)
    for s in range(a.shape[1]):
        out += np.bitwise_count(a[:, s, None] ^ b[None, :, s])
    return out


class SubstringIndexes:
    """The substring indexes of a block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.parts = [np.unique(codes[:, s], return_inverse=True) for s in range(codes.shape[1])]

    def within(self, queries: np.ndarray, radius: int) -> np.ndarray:
        """Which codes lie within ``radius`` of each query: probe, then check.

        A substring's probes are the values it holds; their distance to the
        query's substring decides, which is cheaper than to list all values
        around it once there are more of those than the block has."""
        m = queries.shape[1]
        if radius >= 16 * m:
            return np.ones((len(queries), len(self.codes)), bool)
        small, more = divmod(radius, m)
        hit = np.zeros((len(queries), len(self.codes)), bool)
        for s, (values, rows) in enumerate(self.parts):
            limit = small if s <= more else small - 1
            if limit >= 0:
                hit |= (np.bitwise_count(queries[:, s, None] ^ values[None, :]) <= limit)[:, rows]
        q, c = np.nonzero(hit)
        far = np.zeros(len(q), np.uint16)
        for s in range(m):
            far += np.bitwise_count(queries[q, s] ^ self.codes[c, s])
        hit[q, c] = far <= radius
        return hit


def search_block(codes: BinaryCodes, ids, x, query_ids, y, k: int, radius: int, step: int = 128):
    """The best ``k`` of a block for each query: query, id and score arrays.
    Scores are sums in a fixed order, so equal vectors tie exactly."""
    index = SubstringIndexes(codes.encode(x))
    out = []
    for at in range(0, len(y), step):
        q, qid = y[at:at + step], query_ids[at:at + step]
        hit = index.within(codes.encode(q, query=True), radius)
        hit &= qid[:, None] != ids[None, :]
        for i in range(len(q)):
            found = np.flatnonzero(hit[i])
            if len(found) > k:  # floats are read for codes within the radius only
                rough = x[found] @ q[i]
                cut = np.partition(rough, len(found) - k)[len(found) - k]
                found = found[rough >= cut - 1e-9 * (1 + abs(cut))]
            score = (x[found] * q[i]).sum(axis=1)
            best = np.lexsort((ids[found], -score))[:k]
            out.append((np.full(len(best), qid[i]), ids[found][best], score[best]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate([o[j] for o in out]) for j in range(3))


def valid_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, v`` (array<double>) of the rows that take part, repeated rows once."""
    v = F.col("v")
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return (df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
            .filter(F.coalesce(good, F.lit(False))).filter(F.exists(v, lambda c: c != 0)).distinct())


def nearest(df: DataFrame, queries, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20,
            bits: int = 256, aim: float = 0.985, sample_rows: int = 8192, block_bytes: int = 16 << 20,
            query_block: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner
    product found for each row that the condition ``queries`` selects, its own
    id aside, ties to the smaller id; all other rows if they are fewer.

    Rows whose id or vector is null, zero, empty or holds a null or
    non-finite component take no part, nor do rows of another length than
    most rows have; repeated rows count once.  No valid row: empty result.
    """
    import pyarrow as pa

    if bits % 16:
        raise ValueError("bits must be a multiple of 16")
    valid = valid_vectors(df, vec_id, vector)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))
    lengths = valid.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max(norm).alias("most")).orderBy(
        F.desc("n"), "dim").head(1)
    schema = "query_id long, vec_id long, score double"
    if not lengths:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n, most = lengths[0]
    valid = valid.filter(F.size("v") == dim)
    draw = F.xxhash64(F.lit(3), "vec_id")
    share = min(1.0, sample_rows / n)
    rows = valid.filter((draw % 2 ** 30 + 2 ** 30) / 2.0 ** 31 < share).select("vec_id", "v").toPandas()
    rows = rows.sort_values("vec_id")
    sample = np.array(rows["v"].tolist(), np.float64).reshape(-1, dim)[:2 * sample_rows]
    model = learn_codes(sample, most, bits, k, aim)
    # Plain values travel: a task may run where this package is not installed.
    shared = df.sparkSession.sparkContext.broadcast(vars(model))

    blocks = max(1, -(-n * dim * 8 // block_bytes))
    asked = valid.filter(queries)
    part = lambda seed, count: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def matrix(table):
        ids = table.column("vec_id").to_numpy()
        x = table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        return ids, x

    def search(asked: DataFrame, n_asked: int, radius: int) -> DataFrame:
        """The ranked ``k`` best within ``radius`` of each row of ``asked``."""
        def run(rows_of_block, asked_of_block):
            if not rows_of_block.num_rows or not asked_of_block.num_rows:
                found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
            else:
                found = search_block(BinaryCodes(**shared.value), *matrix(rows_of_block), *matrix(asked_of_block), k, radius)
            return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

        query_blocks = max(1, -(-n_asked // query_block))
        left = valid.withColumn("block", part(11, blocks)).withColumn("query_block", every(query_blocks))
        right = asked.withColumn("query_block", part(13, query_blocks)).withColumn("block", every(blocks))
        keys = ["block", "query_block"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", place).filter(F.col("rank") <= k).select(
            "query_id", "rank", "vec_id", "score")

    radius, n_asked, done = (bits if n <= k + 1 else model.radius), asked.count(), None
    while True:  # the radius doubles: a few rounds at most, and only while queries are short of rows
        found = search(asked, n_asked, radius)
        if radius < bits:
            found = stored(found, "nearest")
            full = found.filter(F.col("rank") == k).select("query_id")
            asked = stored(asked.join(full.withColumnRenamed("query_id", "vec_id"), "vec_id", "left_anti"), "asked")
            n_asked = asked.count()
            if n_asked:
                found = found.join(full, "query_id", "left_semi").select(*found.columns)
        done = found if done is None else done.unionByName(found)
        if radius >= bits or not n_asked:
            return done
        radius = min(bits, max(2 * radius, 16))
