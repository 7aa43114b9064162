"""Fixture F1: eight segments in two partitions (see FIXTURES.md)."""

import json

from pyspark.sql import functions as F

from quarry.functions.partitions import partition_name

# The five sentences of the fixture generator.
SENTENCES = [
    "Java 是一种广泛使用的编程语言，具有跨平台特性",
    "Spring Boot 是一个用于快速构建 Spring 应用的框架",
    "人工智能正在改变我们的生活方式",
    "机器学习是人工智能的一个重要分支",
    "深度学习在图像识别领域取得了巨大成功",
]
FILES = [("kb001", "file_001", 3), ("kb001", "file_002", 2), ("kb002", "file_003", 3)]


def segment_rows(kb: str, file_id: str, n: int):
    return [(f"{file_id}_{i}", file_id, f"{SENTENCES[i % 5]} - 片段 {i}", None,
             json.dumps({"chunk_index": i, "total_chunks": n}), kb) for i in range(n)]


def f1(spark):
    rows = [r for kb, f, n in FILES for r in segment_rows(kb, f, n)]
    df = spark.createDataFrame(rows, "id string, file_id string, content string, embedding array<float>, "
                                     "metadata string, kb string")
    return df.withColumn("partition_name", partition_name("kb")).drop("kb")


def docs(spark, rows):
    """Rows of (id, file_id, content, partition_name) as segments."""
    df = spark.createDataFrame(rows, "id string, file_id string, content string, partition_name string")
    return df.select("id", "file_id", "content", F.lit(None).cast("array<float>").alias("embedding"),
                     F.lit("{}").alias("metadata"), "partition_name")


def vec_docs(spark, rows):
    """Rows of (id, partition_name, vector) as segments."""
    df = spark.createDataFrame(rows, "id string, partition_name string, embedding array<float>")
    return df.select("id", F.lit("f").alias("file_id"), F.lit("c").alias("content"), "embedding",
                     F.lit("{}").alias("metadata"), "partition_name")
