"""The reference's end-to-end assertions, on fixture F1, plus the BM25
match sets derived for the bigram analyzer (FIXTURES.md §3)."""

from pyspark.sql import functions as F

from quarry.operators import tables as tb
from quarry.operators.bm25 import bm25_search, build_bm25_index
from tests.fixtures import docs, f1

KB1, KB2, KB3 = "partition_kb001", "partition_kb002", "partition_kb003"


def ids(df):
    return {r["id"] for r in df.select("id").collect()}


def bm25_ids(spark, base, text, k, partitions=None):
    index = build_bm25_index(base)
    q = spark.createDataFrame([(1, text)], "query_id long, text string")
    return ids(bm25_search(index, q, k, partitions=partitions, corpus=base, columns=[]))


def test_counts_per_partition(spark):
    base = f1(spark)
    assert tb.count(base, KB1).first()["count"] == 5
    assert tb.count(base, KB2).first()["count"] == 3
    parts = {r["partition_name"]: r["n_rows"] for r in tb.list_partitions(base).collect()}
    assert parts == {KB1: 5, KB2: 3}


def test_query_by_file_id(spark):
    rows = tb.query(f1(spark), F.col("file_id") == "file_001", KB1).collect()
    assert rows and all(r["file_id"] == "file_001" for r in rows)
    assert [r["id"] for r in rows] == sorted(r["id"] for r in rows)


def test_get_by_id(spark):
    got = tb.get_by_ids(f1(spark), spark.createDataFrame([("file_001_0",)], "id string"), KB1).collect()
    assert len(got) == 1 and got[0]["id"] == "file_001_0" and got[0]["file_id"] == "file_001"
    assert "embedding" not in got[0].asDict()


def test_upsert_get_delete(spark):
    base = f1(spark)
    new = docs(spark, [("upsert_test", "file_001", "这是通过 Upsert 插入的新内容，会自动进行向量化", KB1)])
    after = tb.upsert(base, new)
    key = spark.createDataFrame([("upsert_test",)], "id string")
    assert tb.get_by_ids(after, key, KB1).count() == 1
    gone = tb.delete_by_ids(after, key, KB1)
    assert tb.get_by_ids(gone, key, KB1).count() == 0


def test_delete_by_filter_lowers_count_by_two(spark):
    base = tb.add(f1(spark), docs(spark, [("file_to_delete_0", "file_to_delete", "a", KB1),
                                          ("file_to_delete_1", "file_to_delete", "b", KB1)]))
    before = tb.count(base, KB1).first()["count"]
    after = tb.delete_by_filter(base, "file_id == 'file_to_delete'", KB1)
    assert tb.count(after, KB1).first()["count"] == before - 2


def test_drop_partition(spark):
    base = tb.add(f1(spark), docs(spark, [("new_file_0", "new_file", "x", KB3), ("new_file_1", "new_file", "y", KB3)]))
    assert tb.has_partition(base, KB3)
    assert not tb.has_partition(tb.drop_partition(base, KB3), KB3)


def test_bm25_match_sets(spark):
    base = f1(spark)
    assert bm25_ids(spark, base, "框架", 5, [KB1]) == {"file_001_1", "file_002_1"}
    assert bm25_ids(spark, base, "Spring Boot 框架", 5) == {"file_001_1", "file_002_1", "file_003_1"}
    assert bm25_ids(spark, base, "人工智能", 3) == {"file_001_2", "file_003_2"}
    assert bm25_ids(spark, base, "人工智能 机器学习", 5, [KB1]) == {"file_001_2"}
    assert bm25_ids(spark, base, "深度学习 图像识别", 5) == set()
    six = {"file_001_0", "file_001_1", "file_002_0", "file_002_1", "file_003_0", "file_003_1"}
    got = bm25_ids(spark, base, "编程语言 框架", 5)
    assert len(got) == 5 and got <= six
