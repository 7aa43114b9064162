"""JSON metadata helpers (FN-9, FN-10, SURVEY D12).

Metadata is a JSON-object string column.  Edits parse it into a
``map<string, variant>`` so every existing value keeps its JSON type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def metadata_or_empty(metadata) -> Column:
    """Metadata is never null: NULL becomes ``{}`` (FN-10)."""
    return F.coalesce(_col(metadata), F.lit("{}"))


def _as_variant(value: Column) -> Column:
    wrapped = F.parse_json(F.to_json(F.struct(value.alias("v"))))
    return F.variant_get(wrapped, "$.v", "variant")


def set_metadata(metadata, key: str, value) -> Column:
    """Set one key of a JSON-object column (FN-9); other keys are kept with
    their JSON types.  ``value`` is a Column or a Python literal."""
    v = value if isinstance(value, Column) else F.lit(value)
    parsed = F.from_json(metadata_or_empty(metadata), "map<string,variant>")
    kept = F.map_filter(parsed, lambda k, _v: k != F.lit(key))
    return F.to_json(F.map_concat(kept, F.create_map(F.lit(key), _as_variant(v))))


def get_metadata(metadata, key: str, dtype: str = "string") -> Column:
    """One key of the metadata JSON as a typed column; a present-but-null
    value stays NULL (D12), never the text ``"null"``."""
    path = "$['" + key.replace("'", "\\'") + "']"  # quoted: a dot is part of the key
    return F.get_json_object(metadata_or_empty(metadata), path).cast(dtype)
