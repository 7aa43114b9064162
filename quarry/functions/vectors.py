"""Vector metrics (FN-1..FN-4).

Two forms of each metric:

* Column expressions built from ``zip_with`` + ``aggregate`` so a metric can
  be used in any DataFrame expression (filters, single-pair scoring, SQL).
* numpy kernels used inside ``mapInPandas`` where a whole batch of corpus
  rows is scored against a block of queries with one matrix product.

Scores follow SURVEY D1: for ``ip`` and ``cosine`` the score is the raw
similarity; for ``l2`` the distance is Euclidean and ``score = 1 / (1 + d)``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("cosine", "ip", "l2")


def check_metric(metric: str) -> str:
    m = (metric or "cosine").strip().lower()
    aliases = {"inner_product": "ip", "dot": "ip", "euclidean": "l2", "cos": "cosine"}
    m = aliases.get(m, m)
    if m not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")
    return m


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """FN-1: inner product of two array<float> columns, in double."""
    pairs = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """FN-2: cosine similarity; a zero norm gives NULL (such a row is never returned)."""
    den = norm(a) * norm(b)
    return F.when(den > 0, dot(a, b) / den)


def l2_distance(a, b) -> Column:
    """FN-3: Euclidean distance."""
    diffs = F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) ** 2)
    return F.sqrt(F.aggregate(diffs, F.lit(0.0).cast("double"), lambda acc, v: acc + v))


def normalize(a) -> Column:
    """L2-normalise a vector column (FN-4); a zero vector stays as it is."""
    # The norm is bound once; inside the lambda it would be summed anew for every component.
    scaled = F.get(F.transform(F.array(norm(a)), lambda n: F.when(
        n > 0, F.transform(_c(a), lambda x: (x / n).cast("float"))).otherwise(_c(a))), F.lit(0))
    return scaled


# ---------------------------------------------------------------- numpy side

def stack(values) -> np.ndarray:
    """Stack a pandas/Arrow column of equal-length arrays into float64 rows."""
    if len(values) == 0:
        return np.zeros((0, 0), dtype=np.float64)
    return np.vstack([np.asarray(v, dtype=np.float64) for v in values])


def prepare_queries(q: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Return the query matrix as used by :func:`score_matrix` and a validity
    mask (zero-norm cosine queries have no score)."""
    if metric == "cosine":
        n = np.linalg.norm(q, axis=1)
        ok = n > 0
        out = np.zeros_like(q)
        out[ok] = q[ok] / n[ok, None]
        return out, ok
    return q, np.ones(len(q), dtype=bool)


def score_matrix(x: np.ndarray, q: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Scores and distances of every row of ``x`` against every prepared
    query row of ``q``: two (n, m) float64 matrices, NaN where undefined."""
    prod = x @ q.T
    if metric == "ip":
        return prod, prod
    if metric == "cosine":
        n = np.linalg.norm(x, axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            s = prod / n[:, None]
        s[n == 0, :] = np.nan
        return s, s
    xx = np.einsum("ij,ij->i", x, x)
    qq = np.einsum("ij,ij->i", q, q)
    d = np.sqrt(np.maximum(xx[:, None] + qq[None, :] - 2.0 * prod, 0.0))
    return 1.0 / (1.0 + d), d


def round_score(scores: np.ndarray) -> np.ndarray:
    """Rounded to 6 places, half away from zero, as Spark rounds."""
    return np.sign(scores) * np.floor(np.abs(scores) * 1e6 + 0.5) / 1e6


def topk_per_column(scores: np.ndarray, kk: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column indices of the best ``kk`` rows per column.

    Order is the library's ranking order: score rounded to 6 places
    descending, then row index ascending (callers sort rows by id first, so
    this is id ascending).  NaN scores never qualify.  Ties at the cut are
    resolved exactly, so the candidates a batch emits always contain the
    global winners that fall in that batch.
    """
    n, m = scores.shape
    if n == 0 or m == 0 or kk <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    r = round_score(scores)
    r = np.where(np.isnan(r), -np.inf, r)
    if n > kk:
        cut = np.partition(r, n - kk, axis=0)[n - kk]  # kk-th largest per column
        mask = r >= cut[None, :]
    else:
        cut = np.full(m, -np.inf)
        mask = np.ones_like(r, dtype=bool)
    mask &= np.isfinite(r)
    counts = mask.sum(axis=0)
    over = np.nonzero(counts > kk)[0]
    for j in over:  # rare: ties at the cut; keep the smallest row indices
        col = r[:, j]
        above = np.nonzero(col > cut[j])[0]
        tied = np.nonzero(col == cut[j])[0][: kk - len(above)]
        keep = np.zeros(n, dtype=bool)
        keep[above] = True
        keep[tied] = True
        mask[:, j] = keep
    rows, cols = np.nonzero(mask)
    return rows, cols
