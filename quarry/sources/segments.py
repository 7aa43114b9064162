"""Sources (SRC-1): bring input rows to the canonical document columns.

Canonical ``segments`` columns (SURVEY §1.3)::

    id string not null | file_id string | content string | embedding array<float>
    metadata string (JSON object) | partition_name string
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metadata import metadata_or_empty
from ..functions.partitions import partition_name, partition_or_default

SEGMENT_COLUMNS = ["id", "file_id", "content", "embedding", "metadata", "partition_name"]
SEGMENT_DDL = ("id string, file_id string, content string, embedding array<float>, "
               "metadata string, partition_name string")
# Columns left out of results unless asked for (PRJ-1: fields marked excluded).
EXCLUDED_COLUMNS = ("embedding", "sparse")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def load_segments(df: DataFrame, *, id=None, content=None, embedding=None, file_id=None,
                  metadata=None, partition=None, extra: list[str] | None = None) -> DataFrame:
    """Map arbitrary input columns to the canonical document columns.

    Every argument is a column name or Column (or None for NULL).  The id is
    cast to string, metadata is never null, an empty partition becomes the
    default partition.  ``extra`` columns are carried through unchanged.
    """
    cols = [
        (_c(id) if id is not None else F.col("id")).cast("string").alias("id"),
        (_c(file_id).cast("string") if file_id is not None else F.lit(None).cast("string")).alias("file_id"),
        (_c(content).cast("string") if content is not None else F.lit(None).cast("string")).alias("content"),
        (_c(embedding).cast("array<float>") if embedding is not None
         else F.lit(None).cast("array<float>")).alias("embedding"),
        metadata_or_empty(_c(metadata) if metadata is not None else F.lit(None).cast("string")).alias("metadata"),
        partition_or_default(_c(partition) if partition is not None else F.lit(None).cast("string"))
        .alias("partition_name"),
    ]
    return df.select(*cols, *(extra or []))


def testdata_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``segments`` view over the driver tables.

    ``documents`` left join ``embeddings`` on ``doc_id = vec_id``; file id is
    the source, metadata holds ``lang`` and ``n_chars``, the partition is
    ``partition_<lang>``.
    """
    docs = read_table(spark, sf_dir, "documents")
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    joined = docs.join(emb, docs.doc_id == emb.vec_id, "left")
    return load_segments(
        joined,
        id="doc_id",
        file_id="source",
        content="text",
        embedding="embedding",
        metadata=F.to_json(F.struct("lang", "n_chars")),
        partition=partition_name("lang"),
    )


def testdata_vector_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding of the driver tables as a corpus row, with its
    document's columns where it has one (default partition otherwise)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang", "n_chars")
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    joined = emb.join(docs, docs.doc_id == emb.vec_id, "left")
    return load_segments(joined, id="vec_id", file_id="source", content="text", embedding="embedding",
                         metadata=F.to_json(F.struct("lang", "n_chars")), partition=partition_name("lang"))


def default_columns(df: DataFrame, spec=None) -> list[str]:
    """PRJ-1: every column except those marked excluded: by ``spec`` (a
    ``CollectionSpec``) where one is given, else the vector columns' usual names."""
    left_out = EXCLUDED_COLUMNS if spec is None else [f.name for f in spec.fields if f.exclude]
    return [c for c in df.columns if c not in left_out]


def read_segments(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = SEGMENT_DDL,
                  **mapping) -> DataFrame:
    """SRC-1 from files: read documents in ``fmt`` (parquet, json, orc, csv)
    and map them to the canonical columns (``mapping`` as in
    :func:`load_segments`; none when the files already hold them).

    JSON and CSV are read with the canonical schema (no inference pass);
    parquet and ORC carry their own.  Partition directories
    (``partition_name=...``) are discovered and pruned by Spark; their names
    stay text (``001`` is not 1).
    """
    reader = spark.read.format(fmt)
    if fmt in ("json", "csv") and schema:
        reader = reader.schema(schema)
    df = reader.load(path)
    if "partition_name" in df.columns and df.schema["partition_name"].dataType != T.StringType():
        # Spark reads a folder name such as 001 as the number 1: say that it is text.
        text = [T.StructField(f.name, T.StringType()) if f.name == "partition_name" else f for f in df.schema.fields]
        df = spark.read.format(fmt).schema(T.StructType(text)).load(path)
    if mapping:
        return load_segments(df, **mapping)
    return load_segments(df, id="id", content="content", embedding="embedding", file_id="file_id",
                         metadata="metadata", partition="partition_name",
                         extra=[c for c in df.columns if c not in SEGMENT_COLUMNS])
