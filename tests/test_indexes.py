"""IVF indexes: residual product codes, two-level cells, pruned exact search."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators.ivf import (FULL, IvfIndex, build_ivf, cell_radii, exact_ivf_search, ivf_search, probe_cells,
                                  promising_cells, recall_at_k)
from quarry.operators.knn import query_vectors, vector_search
from quarry.operators.product_codes import learn, nearest
from quarry.session import ensure_checkpoint_dir
from quarry.sources.versions import add_to_table, upsert_table, write_version

COLS = ["query_id", "rank", "partition_name", "id", "score", "distance"]


def table(spark, x):
    rows = [(str(i), f"p{i % 3}", i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id string, partition_name string, n long, embedding array<float>")


def asked(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)],
                                 "query_id long, vector array<float>")


def clustered(n, clusters, d=16, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(clusters, d)) * 4
    return centers[rng.integers(0, clusters, n)] + rng.normal(size=(n, d)) * 0.3


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_pruned_search_is_exact_and_scans_less(spark, metric):
    x = clustered(1200, 12)
    x[5] = x[6] = x[7]  # ties
    seg, q = table(spark, x), asked(spark, np.concatenate((x[:40], np.zeros((1, 16)), -x[40:50])))
    index = build_ivf(seg, 12, metric)
    for kw in ({}, {"offset": 3}, {"pred": "n % 7 = 1"}, {"partitions": ["p1"]}, {"threshold": None}, {"first": 3}):
        own = {k: v for k, v in kw.items() if k != "first"}
        assert rows(exact_ivf_search(index, q, 5, columns=[], **kw)) == rows(
            vector_search(seg, q, 5, metric=metric, columns=[], **own))
    hits = vector_search(seg, q, 5, metric=metric, columns=[], threshold=None)
    to_beat = hits.groupBy("query_id").agg(F.min("score").alias("least"))
    sent = promising_cells(index, to_beat, cell_radii(index), 1)(query_vectors(q, "vector")).count()
    assert sent < 51 * 12 / (1 if metric == "ip" else 2)


def test_two_level_cells(spark):
    x = np.concatenate((clustered(1500, 5, seed=1), np.random.default_rng(2).normal(size=(500, 16)) * 3))
    seg, q = table(spark, x), asked(spark, x[::40])
    index = build_ivf(seg, 100, "l2", two_level=True)
    assert 80 <= index.nlist <= 160 and len(index.branches) == 10 and len(index.branch_of) == index.nlist
    sizes = [r["count"] for r in index.table.groupBy("cell").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 2 * FULL * 2000 / index.nlist
    exact = vector_search(seg, q, 5, metric="l2", columns=[])
    assert rows(ivf_search(index, q, 5, nprobe=index.nlist, columns=[])) == rows(exact)
    assert rows(exact_ivf_search(index, q, 5, columns=[])) == rows(exact)
    found = ivf_search(index, q, 5, nprobe=20, columns=[], threshold=None)
    assert recall_at_k(found, exact).agg(F.avg("recall")).first()[0] >= 0.95
    assert probe_cells(index, 7)(query_vectors(q, "vector")).count() == 7 * 50


def test_more_cells_than_rows(spark):
    x = clustered(30, 3)
    index = build_ivf(table(spark, x), 64, "l2", two_level=True)
    exact = rows(vector_search(table(spark, x), asked(spark, x), 4, metric="l2", columns=[]))
    assert rows(ivf_search(index, asked(spark, x), 4, nprobe=index.nlist, columns=[])) == exact


def test_rotation_beats_plain_cuts():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2000, 16)) @ np.diag([6, 5, 4, 3] + [0.3] * 12) @ np.linalg.qr(rng.normal(size=(16, 16)))[0]
    codes = learn(x, 4, 4)
    assert np.allclose(codes.rotation @ codes.rotation.T, np.eye(16))
    made = codes.decode(codes.encode(x))
    plain = np.zeros_like(x)
    for j in range(4):
        part = x[:, 4 * j:4 * j + 4]
        books = learn(part, 1, 4)
        plain[:, 4 * j:4 * j + 4] = books.decode(books.encode(part))
    assert ((x - made) ** 2).sum() < 0.8 * ((x - plain) ** 2).sum()
    assert nearest(x[:5], x[:50]).tolist() == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_residual_codes_search_and_storage(spark, metric):
    x = clustered(600, 8)
    seg, q = table(spark, x), asked(spark, x[::30])
    index = build_ivf(seg, 8, metric, kind="pq", m=4, nbits=5)
    exact = vector_search(seg, q, 5, metric=metric, columns=[], threshold=None)
    found = ivf_search(index, q, 5, nprobe=8, rerank=12, columns=[], threshold=None)
    assert recall_at_k(found, exact).agg(F.avg("recall")).first()[0] >= 0.9
    root = f"{ensure_checkpoint_dir(spark)}/test-pq-{uuid.uuid4().hex}"
    index.write(root)
    assert rows(ivf_search(IvfIndex.read(spark, root), q, 5, nprobe=3, columns=[])) == rows(
        ivf_search(index, q, 5, nprobe=3, columns=[]))
    with pytest.raises(ValueError, match="flat"):
        exact_ivf_search(index, q, 5)


def test_odd_vectors_are_named_not_dropped(spark):
    x = [[0.1 * i, 1.0] for i in range(50)]
    seg = table(spark, x + [[1.0, 2.0, 3.0]])
    with pytest.raises(ValueError, match=r"several lengths: 2 .* to 3 \(id 50\)"):
        build_ivf(seg, 2)
    with pytest.raises(ValueError, match="non-finite"):
        build_ivf(table(spark, x + [[1.0, float("nan")]]), 2)
    assert build_ivf(seg.where("size(embedding) = 2"), 2).table.count() == 50
    empty = build_ivf(seg.where("false"), 4)
    assert ivf_search(empty, asked(spark, x[:3]), 5).count() == 0


def test_stored_table_refuses_unknown_columns(spark):
    root = f"{ensure_checkpoint_dir(spark)}/test-stored-{uuid.uuid4().hex}"
    docs = spark.createDataFrame([("a", "p", "x")], "id string, partition_name string, content string")
    write_version(docs, root)
    more = docs.withColumn("extra", F.lit(1)).withColumn("seq", F.lit(2))
    with pytest.raises(ValueError, match="no column extra"):
        upsert_table(spark, root, more)
    with pytest.raises(ValueError, match="no column extra"):
        add_to_table(spark, root, more.drop("seq"))
    assert upsert_table(spark, root, more.drop("extra")) == 2


def test_rerank_is_the_exact_order_of_the_best_by_codes(spark):
    """candidates were joined with their raw vectors, and brought ``r*k`` rows from each cell and block."""
    x = clustered(400, 6)
    seg, q = table(spark, x), asked(spark, x[::20])
    index = build_ivf(seg, 6, "l2", kind="pq", m=4, nbits=3)
    index.table = index.table.localCheckpoint()
    held = {r["id"]: (r["cell"], r["pq_codes"]) for r in index.table.select("id", "cell", "pq_codes").collect()}
    cells, codes = (np.array([held[str(i)][j] for i in range(400)]) for j in (0, 1))
    near = ((x[::20, None] - (index.centroids[cells] + index.pq.decode(codes))[None]) ** 2).sum(2)
    true = np.sqrt(((x[::20, None] - x[None]) ** 2).sum(2))
    found = ivf_search(index, q, 3, nprobe=6, rerank=4, columns=[], threshold=None)
    for i in range(5):
        by_codes = sorted(range(400), key=lambda r: (-round(1 / (1 + near[i, r] ** 0.5), 6), str(r)))[:12]
        best = sorted(by_codes, key=lambda r: (-round(1 / (1 + true[i, r]), 6), str(r)))[:3]
        assert [r["id"] for r in found.where(f"query_id = {i}").orderBy("rank").collect()] == [str(r) for r in best]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # the cells to the lots; no candidate is joined
