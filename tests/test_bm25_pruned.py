"""Two-pass BM25 against the plain search."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators.bm25 import bm25_candidates, bm25_search, build_bm25_index
from quarry.operators.bm25_pruned import bm25_pruned_search, doc_weights, pruned_parts, term_bounds
from quarry.session import materialize

COLS = ["query_id", "rank", "partition_name", "id", "score", "distance"]


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


@pytest.fixture(scope="module")
def corpus(spark):
    """Words of Zipf frequencies, some documents twice under one key, some empty."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    odds = [1 / (i + 1) for i in range(400)]
    docs = [(str(i % 900), f"p{i % 3}", " ".join(rng.choices(words, odds, k=rng.randint(0, 60)))) for i in range(1000)]
    docs += [("empty", "p0", ""), ("none", "p1", None), ("one", "p2", "w399")]
    return materialize(spark.createDataFrame(docs, "id string, partition_name string, content string"), "pruned-corpus")


@pytest.fixture(scope="module")
def queries(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(1, 4))) + " w0 w1 w2 w3" for _ in range(30)]
    texts += ["w0", "w399", "absent", "", None, "w0 w0 w1", "w7 w7 w7 w200"]
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")


def test_same_hits(corpus, queries):
    index = build_bm25_index(corpus)
    weights = materialize(doc_weights(index), "weights")
    for k, offset in ((1, 0), (10, 0), (5, 7), (2000, 0)):
        assert rows(bm25_pruned_search(index, queries, k, offset, weights=weights)) == rows(bm25_search(index, queries, k, offset))
    some = dict(pred="id NOT LIKE '1%'", partitions=["p0", "p2"], corpus=corpus, columns=[])
    assert rows(bm25_pruned_search(index, queries, 10, weights=weights, **some)) == rows(bm25_search(index, queries, 10, **some))
    assert rows(bm25_pruned_search(index, queries, 10, drop_ratio=0.4)) == rows(bm25_search(index, queries, 10, drop_ratio=0.4))
    assert bm25_pruned_search(index, queries.limit(0), 10).count() == 0
    with pytest.raises(ValueError, match="needs the corpus"):
        bm25_pruned_search(index, queries, 10, pred="id = '1'")


def test_empty_corpus(corpus, queries):
    assert bm25_pruned_search(build_bm25_index(corpus.limit(0)), queries, 10).count() == 0


def test_fewer_rows_are_summed(corpus, queries):
    index = build_bm25_index(corpus)
    parts = pruned_parts(index, queries, 5)
    joined = lambda terms: terms.join(parts["weights"], "term").count()
    plain = joined(parts["terms"])
    lead, second = joined(parts["terms"].where("lead")), joined(parts["judged"].where("NOT aside"))
    looked_up = (parts["open"].join(parts["judged"].where("aside AND NOT low"), "query_id").count()
                 + parts["halved"].join(parts["judged"].where("aside AND low"), "query_id").count())
    pairs = bm25_candidates(index, queries).count()
    assert parts["open"].count() < pairs / 2 and parts["halved"].count() < parts["open"].count()
    assert lead + second + looked_up < plain * 0.8, (lead, second, looked_up, plain)
    # every hit of the plain search is among the documents left open
    hits = bm25_search(index, queries, 5)
    assert hits.join(parts["halved"], ["query_id", "partition_name", "id"], "left_anti").count() == 0


def test_bounds_cover_every_document(corpus):
    index = build_bm25_index(corpus)
    bounds = term_bounds(doc_weights(index))
    parts = index.postings.groupBy("partition_name", "id", "term").count()
    assert bounds.agg(F.sum("df")).first()[0] == parts.count()


def test_terms_are_counted_without_a_shuffle(spark):
    """Tokens were shuffled to be counted, and the index's entries again one by one."""
    from collections import Counter

    from quarry.operators.bm25 import count_terms
    docs = spark.createDataFrame([("p", "1", "b a b  c b"), ("p", "1", "a"), ("p", "2", ""), (None, None, None)],
                                 "partition_name string, id string, content string")
    counted = count_terms(docs, "content", None)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    got = [(r["id"], r["dl"], dict(zip(r["terms"], r["tfs"]))) for r in counted.collect()]
    assert got == [("1", 5, {"a": 1, "b": 3, "c": 1}), ("1", 1, {"a": 1}), ("2", 0, {}), (None, 0, {})]
    index = build_bm25_index(docs)
    assert (index.n_docs, index.avgdl) == (4, 1.5)
    assert Counter((r["term"], r["tf"], r["dl"]) for r in index.postings.collect()) == Counter(
        [("a", 1, 5), ("b", 3, 5), ("c", 1, 5), ("a", 1, 1)])
    assert {(r["term"], r["df"], r["cf"]) for r in index.terms.collect()} == {("a", 2, 2), ("b", 1, 3), ("c", 1, 1)}


def test_passes_shuffle_neither_postings_nor_pairs(corpus, queries):
    """each pass joined postings with pairs of a query and a document, by document and term."""
    parts = pruned_parts(build_bm25_index(corpus), queries, 5)
    for name in ("open", "halved", "candidates"):
        plan = parts[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "MapInArrow" in plan, plan
    best = parts["candidates"].groupBy("query_id").count().agg(F.max("count")).first()[0]
    assert best <= 5 * queries.sparkSession.sparkContext.defaultParallelism * 4


def test_rows_and_postings_give_the_same_hits(corpus, queries, monkeypatch):
    """Many lots, stripes and slices of a document or two against the join with the postings."""
    from dataclasses import replace

    from quarry.operators import bm25_rows
    index = build_bm25_index(corpus)
    saved = replace(index, counted=None)
    asked = queries.unionByName(queries.selectExpr("query_id + 100 AS query_id", "text"))
    for name, value in (("_MAX_CELLS", 80), ("_MAX_LINKS", 60), ("STRIPE_ROWS", 100), ("LEAST_ROWS", 16), ("LOT_TERMS", 64)):
        monkeypatch.setattr(bm25_rows, name, value)
    some = dict(pred="id NOT LIKE '1%'", partitions=["p0", "p2"], corpus=corpus, columns=[])
    for k, more in ((4, {}), (300, {}), (4, some)):
        assert rows(bm25_search(index, asked, k, **more)) == rows(bm25_search(saved, asked, k, **more))
    assert rows(bm25_pruned_search(index, asked, 4)) == rows(bm25_search(saved, asked, 4))
    assert rows(bm25_pruned_search(saved, asked, 4)) == rows(bm25_search(saved, asked, 4))


def test_a_missing_key_is_one_document(spark):
    docs = spark.createDataFrame([(None, "p", "a b"), (None, "p", "a a c"), ("1", None, "a"), ("1", None, "b a"), ("2", "p", "c")],
                                 "id string, partition_name string, content string")
    asked = spark.createDataFrame([("x", "a c"), ("y", "b")], "query_id string, text string")
    index = build_bm25_index(docs)
    from dataclasses import replace
    key = lambda df: sorted(map(str, rows_of(df)))
    rows_of = lambda df: [tuple(r) for r in df.select(*COLS).collect()]
    assert key(bm25_search(index, asked, 10)) == key(bm25_search(replace(index, counted=None), asked, 10))


def test_a_filter_is_applied_once(corpus, queries):
    """every pass, and the count of its stripes, joined the documents with the filtered corpus again."""
    index = build_bm25_index(corpus)
    some = dict(pred="id NOT LIKE '1%'", partitions=["p0", "p2"], corpus=corpus)
    parts = pruned_parts(index, queries, 10, **some)
    for name in ("weights", "open", "halved", "candidates"):
        plan = parts[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "pruned-corpus" not in plan, plan
    held = parts["weights"].select("partition_name", "id").distinct().collect()
    assert held and all(r.partition_name in ("p0", "p2") and not r.id.startswith("1") for r in held)
    assert rows(bm25_pruned_search(index, queries, 10, columns=[], **some)) == rows(
        bm25_search(index, queries, 10, columns=[], **some))
