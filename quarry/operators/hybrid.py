"""Weighted hybrid ranking and method comparison (SRCH-9, SRCH-10; D3, D4).

Each branch (dense top-k, BM25 top-k) is cut to ``offset + k`` rows per
query before fusion, so fusion only ever sees a bounded number of rows per
query: a union and a ``groupBy(query_id, doc)`` sum, then the top-k.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import check_metric
from ..session import materialize
from .bm25 import Bm25Index, bm25_search
from .knn import attach_columns, scope_corpus, vector_search
from .topk import apply_threshold, rank_topk

NORMS = ("arctan", "minmax", "none")


def normalize_score(kind: str, norm: str, metric: str = "cosine") -> Column:
    """Branch score on a 0..1 scale.

    arctan: cosine ``(1+s)/2``; ip ``1/2 + atan(s)/pi``; bm25 ``2*atan(s)/pi``;
    l2 ``1 - 2*atan(d)/pi``.  minmax: ``(s-min)/(max-min)`` over the query's
    branch hits (1.0 when all equal).  none: the raw score.
    """
    s, d = F.col("score"), F.col("distance")
    if norm == "none":
        return s
    if norm == "minmax":
        w = Window.partitionBy("query_id")
        lo, hi = F.min(s).over(w), F.max(s).over(w)
        return F.when(hi > lo, (s - lo) / (hi - lo)).otherwise(F.lit(1.0))
    if norm != "arctan":
        raise ValueError(f"unknown norm {norm!r}; expected one of {NORMS}")
    if kind == "bm25":
        return 2.0 * F.atan(s) / math.pi
    metric = check_metric(metric)
    if metric == "cosine":
        return (1.0 + s) / 2.0
    if metric == "ip":
        return 0.5 + F.atan(s) / math.pi
    return 1.0 - 2.0 * F.atan(d) / math.pi


def fuse(dense: DataFrame, sparse: DataFrame, weights=(0.5, 0.5), norm: str = "arctan",
         metric: str = "cosine") -> DataFrame:
    """JOI-5: weighted sum of normalised branch scores, a union plus a
    ``groupBy`` (cheaper than a full outer join); a missing side adds 0.
    Weights are used as given, not rescaled."""
    wd, ws = float(weights[0]), float(weights[1])
    keys = ["query_id", "partition_name", "id"]
    a = dense.select(*keys, (F.lit(wd) * normalize_score("dense", norm, metric)).alias("w"))
    b = sparse.select(*keys, (F.lit(ws) * normalize_score("bm25", norm)).alias("w"))
    return (a.unionByName(b).groupBy(*keys).agg(F.sum("w").alias("score"))
            .withColumn("distance", F.col("score")))


def hybrid_search(corpus: DataFrame, index: Bm25Index, queries: DataFrame, k: int = 10, offset: int = 0, *,
                  weights=(0.5, 0.5), norm: str = "arctan", metric: str = "cosine", pred=None, partitions=None,
                  threshold: float | None = 0.0, columns=None, text_col: str = "text",
                  query_vector_col: str = "vector", vector_col: str = "embedding",
                  ivf_index=None, nprobe: int = 8, drop_ratio: float | None = None) -> DataFrame:
    """SRCH-9: ``offset+k`` dense hits and ``offset+k`` BM25 hits per query,
    fused and ranked.  Queries need text (empty text is skipped, see
    :func:`quarry.plans.search.query_errors`) and a vector (embed first with
    :func:`quarry.functions.embed.embed_queries`).  Filter, partitions and
    offset apply to both branches before their top-k (D3).  With
    ``ivf_index`` the dense branch is the approximate IVF search (its own
    metric), else exact search by ``metric``."""
    good = queries.where(F.col(text_col).isNotNull() & (F.trim(F.col(text_col)) != ""))
    kk = k + offset
    if ivf_index is not None:
        from .ivf import ivf_search
        metric = ivf_index.metric
        dense = ivf_search(ivf_index, good, kk, 0, nprobe=nprobe, pred=pred, partitions=partitions,
                           threshold=None, columns=[], query_vector_col=query_vector_col)
    else:
        dense = vector_search(corpus, good, kk, 0, metric=metric, pred=pred, partitions=partitions,
                              threshold=None, columns=[], vector_col=vector_col, query_vector_col=query_vector_col)
    sparse = bm25_search(index, good, kk, 0, text_col=text_col, pred=pred, partitions=partitions,
                         corpus=corpus, threshold=None, columns=[], drop_ratio=drop_ratio)
    ranked = rank_topk(fuse(dense, sparse, weights, norm, metric), k, offset).withColumn(
        "distance", F.col("score"))
    ranked = apply_threshold(ranked, threshold).select("query_id", "rank", "partition_name", "id", "score",
                                                      "distance")
    cols = [c for c in corpus.columns if c not in ("embedding", "sparse")] if columns is None else list(columns)
    return attach_columns(ranked, scope_corpus(corpus, None, partitions), cols)


def compare_methods(corpus: DataFrame, index: Bm25Index, queries: DataFrame, k: int = 10, *,
                    weights=(0.5, 0.5), norm: str = "arctan", metric: str = "cosine", pred=None,
                    partitions=None, threshold: float | None = 0.0, text_col: str = "text",
                    query_vector_col: str = "vector") -> DataFrame:
    """SRCH-10: the same queries through VECTOR, BM25 and HYBRID, tagged
    ``method``: ``method, query_id, rank, partition_name, id, score``.

    Each branch is computed once: both are bounded (``queries * k`` rows)
    and written as a table under the session's checkpoint folder, then the
    VECTOR and BM25 results are the branches themselves and HYBRID fuses
    the same two.
    """
    common = dict(pred=pred, partitions=partitions)
    good = queries.where(F.col(text_col).isNotNull() & (F.trim(F.col(text_col)) != ""))
    dense = materialize(vector_search(corpus, good, k, metric=metric, threshold=None, columns=[],
                                      query_vector_col=query_vector_col, **common), "dense-hits")
    sparse = materialize(bm25_search(index, good, k, text_col=text_col, corpus=corpus, threshold=None,
                                     columns=[], **common), "bm25-hits")
    fused = rank_topk(fuse(dense, sparse, weights, norm, metric), k)
    cols = ["query_id", "rank", "partition_name", "id", "score"]
    return (apply_threshold(dense, threshold).select(F.lit("vector").alias("method"), *cols)
            .unionByName(apply_threshold(sparse, threshold).select(F.lit("bm25").alias("method"), *cols))
            .unionByName(apply_threshold(fused, threshold).select(F.lit("hybrid").alias("method"), *cols)))


def overlap_at_k(results: DataFrame, method_a: str, method_b: str) -> DataFrame:
    """Share of ``method_b``'s hits that ``method_a`` also returned, per query
    (recall@k of an approximate method against exact: a=approx, b=exact)."""
    a = results.where(F.col("method") == method_a).select("query_id", "partition_name", "id")
    b = results.where(F.col("method") == method_b).select("query_id", "partition_name", "id")
    hits = b.join(a, ["query_id", "partition_name", "id"], "left_semi").groupBy("query_id").count()
    total = b.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    return (total.join(hits, "query_id", "left")
            .select("query_id", (F.coalesce(F.col("count"), F.lit(0)) / F.col("n")).alias("overlap")))
