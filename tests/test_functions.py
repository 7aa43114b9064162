"""Scalar functions, ranking rules and edge rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.embed import HashEmbedder, embed_documents, embed_queries
from quarry.functions.metadata import get_metadata, metadata_or_empty, set_metadata
from quarry.functions.partitions import knowledge_id, partition_collisions, partition_name
from quarry.functions.text import analyze
from quarry.functions.vectors import cosine, dot, l2_distance, normalize
from quarry.operators.knn import vector_search
from quarry.plans.search import SearchRequest, SearchType, query_errors
from quarry.sources.schema import float_vector, segment_schema, validate_batch
from tests.fixtures import docs, vec_docs


def test_partition_names(spark):
    df = spark.createDataFrame([("kb-1",), ("kb_1",), ("知识库",), ("abc",)], "k string")
    out = df.select("k", partition_name("k").alias("p")).collect()
    assert {r["k"]: r["p"] for r in out} == {"kb-1": "partition_kb_1", "kb_1": "partition_kb_1",
                                             "知识库": "partition____", "abc": "partition_abc"}
    back = spark.createDataFrame([("partition_abc",), ("other",)], "p string").select(knowledge_id("p")).collect()
    assert [r[0] for r in back] == ["abc", "other"]
    clash = partition_collisions(df.withColumnRenamed("k", "knowledge_id")).collect()
    assert sorted((r["partition_name"], r["knowledge_id"], r["n_ids"]) for r in clash) == [
        ("partition_kb_1", "kb-1", 2), ("partition_kb_1", "kb_1", 2)]


def test_metadata(spark):
    df = spark.createDataFrame([('{"a": 1, "file_id": null}',), (None,)], "m string")
    out = df.select(set_metadata("m", "b", "x").alias("s"), get_metadata("m", "file_id").alias("f"),
                    metadata_or_empty("m").alias("e")).collect()
    assert get_json(out[0]["s"]) == {"a": 1, "file_id": None, "b": "x"}
    assert get_json(out[1]["s"]) == {"b": "x"}
    assert out[0]["f"] is None and out[1]["e"] == "{}"


def get_json(s):
    import json
    return json.loads(s)


def test_vector_metrics(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([3.0, 4.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 1.0])],
                               "a array<float>, b array<float>")
    out = df.select(dot("a", "b").alias("d"), cosine("a", "b").alias("c"), l2_distance("a", "b").alias("l"),
                    normalize("a").alias("n")).collect()
    assert out[0]["d"] == 0.0 and out[0]["c"] == 0.0 and math.isclose(out[0]["l"], math.sqrt(5))
    assert math.isclose(out[1]["c"], 1.0) and out[1]["l"] == 0.0
    assert out[2]["c"] is None  # zero norm -> no score
    assert np.allclose(out[1]["n"], [0.6, 0.8])


def test_analyzer_bigrams(spark):
    df = spark.createDataFrame([("Spring Boot 框架",), ("人 工智能",), (None,)], "t string")
    out = [r[0] for r in df.select(analyze("t")).collect()]
    assert out == [["spring", "boot", "框架"], ["人", "工智", "智能"], []]


def test_ties_by_id_and_zero_vectors(spark):
    corpus = vec_docs(spark, [("b", "p", [1.0, 0.0]), ("a", "p", [1.0, 0.0]), ("c", "p", [0.0, 0.0]),
                              ("d", "p", [1.0, 0.0, 0.0]), ("e", "p", None), ("f", "p", [-1.0, 0.0])])
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vector array<float>")
    out = vector_search(corpus, q, 10, columns=[]).orderBy("rank").collect()
    # zero vector, wrong dimension, null vector never returned; negative
    # cosine dropped by the default threshold 0.0
    assert [r["id"] for r in out] == ["a", "b"]
    assert [r["rank"] for r in out] == [1, 2]
    neg = vector_search(corpus, q, 10, threshold=None, columns=[]).orderBy("rank").collect()
    assert [r["id"] for r in neg] == ["a", "b", "f"] and neg[2]["score"] == -1.0


def test_l2_score_and_distance(spark):
    corpus = vec_docs(spark, [("a", "p", [0.0, 0.0]), ("b", "p", [3.0, 4.0])])
    q = spark.createDataFrame([(1, [0.0, 0.0])], "query_id long, vector array<float>")
    out = vector_search(corpus, q, 10, metric="l2", columns=[]).orderBy("rank").collect()
    assert [(r["id"], r["distance"], r["score"]) for r in out] == [("a", 0.0, 1.0), ("b", 5.0, round(1 / 6, 6))]


def test_embed_only_missing(spark):
    d = docs(spark, [("1", "f", "hello world", "p"), ("2", "f", "", "p"), ("3", "f", None, "p")])
    d = d.unionByName(vec_docs(spark, [("4", "p", [1.0] + [0.0] * 63)]))
    out = {r["id"]: r["embedding"] for r in embed_documents(d, HashEmbedder()).collect()}
    assert len(out["1"]) == 64 and math.isclose(float(np.linalg.norm(out["1"])), 1.0, rel_tol=1e-6)
    assert out["2"] is None and out["3"] is None and out["4"][0] == 1.0
    assert embed_documents(d, None).collect() == d.collect()


def test_query_errors_and_dispatch_names(spark):
    q = spark.createDataFrame([(1, "text", None), (2, "  ", None), (3, None, [1.0])],
                              "query_id long, text string, vector array<float>")
    bm = {r["query_id"]: r["error"] for r in query_errors(q, SearchRequest.bm25()).collect()}
    assert bm == {2: "text is empty", 3: "text is empty"}
    vec = {r["query_id"] for r in query_errors(q, SearchRequest.of()).collect()}
    assert vec == {1, 2}
    assert {r["query_id"] for r in query_errors(q, SearchRequest.of(), has_model=True).collect()} == {2}
    with pytest.raises(ValueError, match="embedding model"):  # D18: query 1 has a text and no vector
        embed_queries(q, None)
    assert embed_queries(q.where("query_id <> 1"), None).where("vector IS NULL").count() == 1
    assert SearchType.parse(" hybrid ") is SearchType.HYBRID
    assert SearchType.parse("", SearchType.VECTOR) is SearchType.VECTOR
    with pytest.raises(ValueError):
        SearchType.parse("fuzzy")


def test_validate_batch(spark):
    spec = segment_schema(2).with_field(float_vector("other", 3))
    df = spark.createDataFrame(
        [("a", "f", "x", [1.0, 2.0], "{}", "p", [1.0, 1.0, 1.0]),
         ("a", "f", "x", [1.0], "{}", "p", None),
         ("b", "f" * 70, "x", [float("nan"), 1.0], "not json", "p", None),
         (None, "f", "x", [None, 1.0], "{}", "p", None)],
        "id string, file_id string, content string, embedding array<float>, metadata string, "
        "partition_name string, other array<float>")
    good, bad = validate_batch(df, spec)
    assert good.count() == 0
    v = {(r["id"], tuple(sorted(r["violations"]))) for r in bad.collect()}
    assert ("a", ("id: duplicate key",)) in v
    assert ("a", ("embedding: dimension is not 2", "id: duplicate key")) in v
    assert ("b", ("embedding: NaN element", "file_id: longer than 64 bytes", "metadata: not JSON")) in v
    assert (None, ("embedding: null element", "id: null")) in v


def test_custom_analyzer_and_request_defaults(spark):
    df = spark.createDataFrame([("Hello-World foo_bar",)], "t string")
    assert df.select(analyze("t", r"([a-z]+)")).first()[0] == ["hello", "world", "foo", "bar"]
    req = SearchRequest()
    assert (req.top_k, req.offset, req.similarity_threshold, req.metric) == (10, 0, 0.0, "cosine")
    assert SearchRequest.hybrid().is_hybrid_search and SearchRequest.bm25().is_bm25_search
    assert SearchRequest.of(partitions=("p",)).has_partitions
    from quarry.plans.search import QueryRequest
    assert QueryRequest().limit == 100


def test_include_vectors_and_empty_inputs(spark):
    from quarry.operators import tables as tb
    corpus = vec_docs(spark, [("a", "p", [1.0, 0.0]), ("b", "p", [0.0, 1.0])])
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vector array<float>")
    out = vector_search(corpus, q, 1, include_vectors=True).first()
    assert out["id"] == "a" and list(out["embedding"]) == [1.0, 0.0]
    got = tb.get_by_ids(corpus, spark.createDataFrame([("b",)], "id string"), include_vectors=True).first()
    assert list(got["embedding"]) == [0.0, 1.0]
    assert tb.filter_in(corpus, "id", []).count() == 0  # D11: empty list matches nothing
    assert tb.filter_in(corpus, "id", ["a"]).count() == 1
    assert tb.add(corpus, corpus.limit(0)).count() == 2  # empty add changes nothing
    assert tb.upsert(corpus, corpus.limit(0)).count() == 2
    none = spark.createDataFrame([], "query_id long, vector array<float>")
    assert vector_search(corpus, none, 5).count() == 0


def test_request_params_and_dotted_metadata(spark):
    from quarry.functions.metadata import get_metadata, set_metadata
    r = SearchRequest.of(nprobe=8, params={"nprobe": 1, "drop_ratio_search": 0.2}).with_params()
    assert (r.nprobe, r.drop_ratio) == (1, 0.2)
    with pytest.raises(ValueError):
        SearchRequest.of(params={"ef": 3}).with_params()
    df = spark.createDataFrame([("{}",)], "metadata string")
    out = df.select(set_metadata("metadata", "a.b", "x").alias("m")).select(get_metadata("m", "a.b").alias("v"))
    assert out.first()["v"] == "x"


def test_null_partition_duplicates_are_reported(spark):
    df = spark.createDataFrame([("a", "f", "x", None, "{}", None), ("a", "f", "x", None, "{}", None)],
                               "id string, file_id string, content string, embedding array<float>, "
                               "metadata string, partition_name string")
    _, bad = validate_batch(df, segment_schema(2))
    assert [r["violations"] for r in bad.collect()] == [["id: duplicate key"]] * 2


def test_wrong_length_queries_rank_nothing(spark):
    corpus = vec_docs(spark, [("a", "p", [1.0, 0.0]), ("b", "p", [0.0, 1.0]), ("c", "p", [1.0, 0.0, 0.0])])
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0, 0.0]), (3, None), (4, [0.0, 0.0])],
                              "query_id short, vector array<float>")
    out = vector_search(corpus, q, 1, columns=[]).collect()
    assert [(r["query_id"], r["id"]) for r in out] == [(1, "a")]


def test_saved_bm25_keeps_its_drop_ratio(spark):
    import uuid
    from quarry.operators.bm25 import Bm25Index, build_bm25_index
    index = build_bm25_index(docs(spark, [("1", "f", "b a b", "p"), ("2", "f", None, "p")]))
    assert sorted((r["term"], r["tf"], r["dl"]) for r in index.postings.collect()) == [("a", 1, 3), ("b", 2, 3)]
    assert (index.n_docs, index.avgdl) == (2, 1.5)
    index.drop_ratio_search = 0.4
    root = f"{spark.sparkContext.getCheckpointDir()}/bm25-{uuid.uuid4().hex}"
    index.write(root)
    assert Bm25Index.read(spark, root).drop_ratio_search == 0.4


def test_a_model_gets_slices_of_a_batch(spark):
    """a whole Arrow batch of token lists became Python objects at once."""
    import pyarrow as pa

    from quarry.functions.embed import SLICE_ROWS, SLICE_SIZE, _slices
    lists = pa.array([["x"] * n for n in (3, 0, SLICE_SIZE + 5, 1, SLICE_SIZE)] + [None] + [["y"]] * (2 * SLICE_ROWS))
    got = list(_slices(lists))
    assert [g for given, _ in got for g in given] == [i for i in range(len(lists)) if i != 5]
    assert all(inputs == lists.take(pa.array(given)).to_pylist() for given, inputs in got)
    assert all(len(given) <= SLICE_ROWS and (len(given) == 1 or sum(map(len, inputs)) <= SLICE_SIZE) for given, inputs in got)
    assert [g for g, _ in _slices(pa.array(["ab", None, "c"]))] == [[0, 2]] and not list(_slices(pa.array([None], pa.string())))


def test_a_model_reads_arrow_values(spark):
    """every token was a Python object; Arrow values give the same vectors."""
    import pyarrow as pa

    from quarry.functions.embed import ARROW_SIZE, _embed_arrow
    model = HashEmbedder()
    lists = [["a", "b", "a"], None, [], ["é"] * 40, ["a", "b", "a"], [f"w{i}" for i in range(500)]] * 50
    values = pa.array([["x"], *lists, ["y"] * (ARROW_SIZE + 1), ["z"]], pa.list_(pa.string())).slice(1)
    want = model.embed_batch(values.to_pylist())
    got = _embed_arrow(model, values).to_pylist()
    assert [None if v is None else v.tolist() for v in want] == got
    assert _embed_arrow(model, values.slice(1, 1)).to_pylist() == [None] and not len(_embed_arrow(model, values.slice(0, 0)))

    class Lists(HashEmbedder):
        def embed_batch(self, values):
            raise AssertionError("tokens as Python objects")
    rows = spark.createDataFrame([("1", "a b a"), ("2", ""), ("3", None)], "id string, text string")
    vectors = {r["id"]: r["vector"] for r in embed_queries(rows, Lists()).collect()}
    assert vectors["1"] == want[0].tolist() and vectors["2"] is None and vectors["3"] is None
