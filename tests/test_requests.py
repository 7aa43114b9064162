"""What requests take from the schema and the index, bad queries, deep pages, text partitions."""

import uuid

import pytest
from pyspark.sql import functions as F

from quarry.operators.ivf import build_ivf
from quarry.operators.knn import vector_search
from quarry.operators.tables import PageIndex, query
from quarry.plans.indexes import IndexSpec, build_index
from quarry.plans.search import SearchRequest, query_errors, search, search_with_errors
from quarry.session import ensure_checkpoint_dir
from quarry.sources.schema import CollectionSpec, FieldSpec, float_vector, varchar
from quarry.sources.segments import default_columns, read_segments

DDL = "id string, partition_name string, content string, note string, embedding array<float>"


def corpus(spark):
    rows = [(str(i), f"p{i % 2}", f"a-b c{i}", f"n{i}", [1.0, float(i)]) for i in range(20)]
    return spark.createDataFrame(rows, DDL)


def test_bad_queries_come_beside_the_hits(spark):
    queries = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0]), (3, None), (4, [])],
                                    "query_id int, vector array<float>")
    out = search_with_errors(corpus(spark), queries, SearchRequest.of(3))
    assert {r.query_id for r in out.hits.collect()} == {1}
    assert {r.query_id: r.error for r in out.errors.collect()} == {
        2: "vector has 3 dimensions, the corpus has 2", 3: "no vector and no text", 4: "no vector and no text"}
    assert query_errors(queries, SearchRequest.of(3)).count() == 2  # lengths are checked against a corpus only
    empty = search_with_errors(corpus(spark).limit(0), queries.limit(1), SearchRequest.of(3))
    assert empty.hits.count() == 0 and empty.errors.count() == 1


def test_default_columns_come_from_the_schema(spark):
    spec = CollectionSpec("c", (varchar("content"), FieldSpec("note", "varchar", exclude=True), float_vector("embedding", 2)))
    queries = spark.createDataFrame([(1, [1.0, 2.0])], "query_id int, vector array<float>")
    assert default_columns(corpus(spark), spec) == ["id", "partition_name", "content"]
    got = search(corpus(spark), queries, SearchRequest.of(2), spec=spec)
    assert {"content"} == set(got.columns) - {"query_id", "rank", "partition_name", "id", "score", "distance"}
    renamed = corpus(spark).withColumnRenamed("embedding", "vec2")
    assert "vec2" not in vector_search(renamed, queries, 2, vector_col="vec2").columns


def test_analyzer_of_the_schema_reaches_the_index(spark):
    words = CollectionSpec("c", (FieldSpec("content", "varchar", analyzer={"type": "whitespace"}),))
    queries = spark.createDataFrame([(1, "a-b")], "query_id int, text string")
    ask = lambda spec: search(corpus(spark), queries, SearchRequest.bm25(50), spec=spec).count()
    assert ask(words) == 20 and ask(None) == 20
    one = spark.createDataFrame([(1, "b")], "query_id int, text string")
    assert search(corpus(spark), one, SearchRequest.bm25(50), spec=words).count() == 0
    assert search(corpus(spark), one, SearchRequest.bm25(50)).count() == 20
    index = build_index(corpus(spark), IndexSpec.sparse_inverted(), schema=words)
    assert {r.term for r in index.terms.collect()} == {"a-b", *(f"c{i}" for i in range(20))}


def test_metric_must_be_the_index_s(spark):
    index = build_ivf(corpus(spark), 2, "l2")
    queries = spark.createDataFrame([(1, [1.0, 2.0])], "query_id int, vector array<float>")
    with pytest.raises(ValueError, match="not the index's 'l2'"):
        search(corpus(spark), queries, SearchRequest.of(2, metric="ip"), ivf_index=index)
    assert search(corpus(spark), queries, SearchRequest.of(2), ivf_index=index).first()["score"] == 1.0


def test_deep_pages(spark):
    base = corpus(spark).unionByName(corpus(spark).withColumn("id", F.concat(F.lit("x"), "id")))
    pages = PageIndex.build(base)
    assert sum(n for _, _, n in pages.before) == 40
    for offset, limit in ((0, 5), (17, 9), (38, 10), (40, 5), (3, 0)):
        assert sorted(pages.page(offset, limit).collect()) == sorted(query(base, None, None, offset, limit).collect())
    part = PageIndex.build(base, "note <> 'n3'", "p1")
    assert sorted(part.page(4, 6).collect()) == sorted(query(base, "note <> 'n3'", "p1", 4, 6).collect())
    assert PageIndex.build(base.limit(0)).page(0, 5).count() == 0


def test_partition_folders_stay_text(spark):
    root = f"{ensure_checkpoint_dir(spark)}/test-parts-{uuid.uuid4().hex}"
    rows = corpus(spark).withColumn("file_id", F.lit("f")).withColumn("metadata", F.lit("{}"))
    rows.withColumn("partition_name", F.lit("001")).write.partitionBy("partition_name").parquet(root)
    back = read_segments(spark, root)
    assert {r.partition_name for r in back.collect()} == {"001"} and back.count() == 20
