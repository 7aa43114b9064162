"""JSON rows in and out, and metadata promotion (SRC-2, SRC-3, SRC-4).

All per-row and JVM-side: ``to_json`` / ``from_json`` / ``get_json_object``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metadata import get_metadata


def to_json_rows(df: DataFrame, columns=None, json_col: str = "json") -> DataFrame:
    """SRC-2: every row as one JSON object, typed columns included, null
    fields left out (as the reference's serialiser does)."""
    cols = list(columns) if columns else df.columns
    return df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias(json_col))


def from_json_rows(df: DataFrame, schema: T.StructType | str, json_col: str = "json") -> DataFrame:
    """SRC-3: typed rows from JSON entities; absent keys become NULL."""
    return df.select(F.from_json(F.col(json_col), schema).alias("_r")).select("_r.*")


def promote_metadata_field(df: DataFrame, key: str, dtype: str = "string", source: str = "metadata",
                           name: str | None = None) -> DataFrame:
    """SRC-4: lift one JSON key to a typed column.  A present-but-null value
    stays NULL (D12), never the text ``"null"``."""
    return df.withColumn(name or key, get_metadata(source, key, dtype))
