"""The numpy ranking kernel against brute force, and the batch merge."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions.vectors import prepare_queries, score_matrix, topk_per_column
from quarry.operators.ivf import build_ivf, ivf_search, probe_lists
from quarry.operators.knn import _Lot, knn_candidates, query_vectors, vector_search
from quarry.plans.workloads import _seg, _vector_queries
from tests.conftest import SF_SMALL


def brute(scores, kk):
    out = set()
    r = np.round(scores, 6)
    for j in range(scores.shape[1]):
        col = [(-(r[i, j]), i) for i in range(scores.shape[0]) if not np.isnan(r[i, j])]
        for _, i in sorted(col)[:kk]:
            out.add((i, j))
    return out


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 30), st.integers(1, 5), st.integers(1, 12), st.integers(0, 2**31 - 1))
def test_topk_per_column_matches_sort(n, m, kk, seed):
    rng = np.random.default_rng(seed)
    # few distinct values -> many ties; some NaN
    scores = rng.integers(0, 4, size=(n, m)).astype(float) / 3.0
    scores[rng.random((n, m)) < 0.1] = np.nan
    rows, cols = topk_per_column(scores, kk)
    assert set(zip(rows.tolist(), cols.tolist())) == brute(scores, kk)


def test_many_batches_per_task_equal_one(spark):
    seg, q = _seg(spark, SF_SMALL), _vector_queries(spark, SF_SMALL)
    cols = ["query_id", "rank", "id", "score"]
    whole = sorted(tuple(r) for r in vector_search(seg, q, 10, columns=[]).select(*cols).collect())
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        small = sorted(tuple(r) for r in vector_search(seg.coalesce(1), q, 10, columns=[]).select(*cols).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert small == whole


def test_query_blocks_under_a_small_budget(spark):
    seg, q = _seg(spark, SF_SMALL), _vector_queries(spark, SF_SMALL)
    cols = ["query_id", "rank", "id", "score"]
    whole = sorted(tuple(r) for r in vector_search(seg, q, 5, columns=[]).select(*cols).collect())
    spark.conf.set("quarry.broadcast.budget.bytes", str(64 * 8 * 60))  # ~60 queries per block
    try:
        blocked = sorted(tuple(r) for r in vector_search(seg, q, 5, columns=[]).select(*cols).collect())
    finally:
        spark.conf.unset("quarry.broadcast.budget.bytes")
    assert blocked == whole


def test_ivf_full_probe_equals_exact_for_ip_and_l2(spark):
    seg, q = _seg(spark, SF_SMALL), _vector_queries(spark, SF_SMALL)
    cols = ["query_id", "rank", "id", "score", "distance"]
    for metric in ("ip", "l2"):
        exact = sorted(tuple(r) for r in vector_search(seg, q, 5, metric=metric, columns=[]).select(*cols).collect())
        index = build_ivf(seg, nlist=4, metric=metric)
        approx = sorted(tuple(r) for r in ivf_search(index, q, 5, nprobe=4, columns=[]).select(*cols).collect())
        assert approx == exact, metric


def test_columns_join_back(spark):
    seg, q = _seg(spark, SF_SMALL), _vector_queries(spark, SF_SMALL)
    out = vector_search(seg, q.where("query_id < 3"), 3)
    assert set(out.columns) == {"query_id", "rank", "partition_name", "id", "score", "distance", "file_id",
                                "content", "metadata"}
    got = out.join(seg.select("id", F.col("file_id").alias("f2")), "id").where("file_id <> f2").count()
    assert got == 0


def test_hybrid_with_full_probe_ivf_equals_exact_hybrid(spark):
    from quarry.operators.bm25 import build_bm25_index
    from quarry.operators.hybrid import hybrid_search
    from quarry.plans.workloads import _embedded_corpus, _embedded_queries
    corpus, q = _embedded_corpus(spark, SF_SMALL), _embedded_queries(spark, SF_SMALL)
    index = build_bm25_index(corpus)
    cols = ["query_id", "rank", "id", "score"]
    exact = sorted(tuple(r) for r in hybrid_search(corpus, index, q, 5, columns=[]).select(*cols).collect())
    ivf = build_ivf(corpus, nlist=4)
    approx = sorted(tuple(r) for r in hybrid_search(corpus, index, q, 5, columns=[], ivf_index=ivf, nprobe=4)
                    .select(*cols).collect())
    assert approx == exact


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
@pytest.mark.parametrize("scale", [1.0, 1e-25, 1e25])
def test_lot_equals_all_pairs(metric, scale):
    rng = np.random.default_rng(5)
    x, q = rng.normal(size=(3000, 8)) * scale, rng.normal(size=(40, 8)) * scale
    x[100:1500] = x[7]  # equal scores: the earliest rows stay
    q[:3] = x[7]
    x[11], x[12, 0], x[13, 1], q[5], q[6, 2] = 0.0, np.nan, np.inf, 0.0, np.inf
    names = np.array([f"{i:05}" for i in range(len(x))], dtype=object)
    cells = rng.integers(0, 5, len(x))
    probes = [rng.permutation(5)[:1 + i % 5] for i in range(len(q))]
    for own in (None, probes):
        lot = _Lot(np.arange(len(q)), q, own, 6, metric, False)
        for at in range(0, len(x), 700):
            part = slice(at, at + 700)
            lot.read(x[part], at, (names[part], names[part]), None if own is None else cells[part], None)
        lot.merge()
        asked, ok = prepare_queries(q, metric)
        with np.errstate(invalid="ignore", over="ignore"):
            s, _ = score_matrix(x, asked, metric)
        s[~np.isfinite(s)] = np.nan
        s[:, ~ok] = np.nan
        if own is not None:
            s[~np.array([np.isin(cells, p) for p in own]).T] = np.nan
        r, c = topk_per_column(s, 6)
        if metric == "ip" and scale > 1:  # equal vectors differ by more than the rounding there
            best = [sorted(s[r[c == i], i]) for i in range(len(q))]
            assert all(np.allclose(sorted(lot.kept[3][lot.kept[0] == i]), b, rtol=1e-12) for i, b in enumerate(best))
        else:
            assert set(zip(lot.kept[0].tolist(), lot.kept[2].tolist())) == set(zip(c.tolist(), r.tolist()))


def test_a_query_has_no_candidates_for_each_cell(spark):
    """with every cell probed a query travelled once for each cell, and brought ``k`` rows from each."""
    seg, q = _seg(spark, SF_SMALL), _vector_queries(spark, SF_SMALL)
    index = build_ivf(seg, nlist=24)
    n = q.count()
    assert probe_lists(index, 24)(query_vectors(q, "vector")).count() == n
    found = knn_candidates(index.table.select("partition_name", "id", "cell", "embedding"), q, 5, cell_col="cell",
                           probe_fn=probe_lists(index, 24))
    assert found.count() <= 5 * n
