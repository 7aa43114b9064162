"""Collection schemas, ingest validation and dynamic fields (SRC-5, SRC-6, PRJ-1, PRJ-3).

A :class:`CollectionSpec` is the declared schema of a document table: an
ordered list of :class:`FieldSpec` plus the dynamic-field flag.  It maps to a
Spark ``StructType`` whose field metadata carries the constraints, and
drives :func:`validate_batch`, which checks a batch in one pass plus one
aggregation on the key.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default sizes of the stock schemas.
DEFAULT_KEY_LENGTH = 64
DEFAULT_TEXT_LENGTH = 65535
DEFAULT_DIM = 1536
DEFAULT_ANALYZER = {"type": "chinese"}
DYNAMIC_COLUMN = "dynamic_fields"

_INT_RANGES = {"int8": (-(2 ** 7), 2 ** 7 - 1), "int16": (-(2 ** 15), 2 ** 15 - 1),
               "int32": (-(2 ** 31), 2 ** 31 - 1)}
_SPARK_TYPES = {
    "varchar": T.StringType(), "int64": T.LongType(), "int32": T.IntegerType(), "int16": T.ShortType(),
    "int8": T.ByteType(), "float": T.FloatType(), "double": T.DoubleType(), "bool": T.BooleanType(),
    "json": T.StringType(), "float_vector": T.ArrayType(T.FloatType(), False), "binary_vector": T.BinaryType(),
    "sparse_vector": T.MapType(T.LongType(), T.FloatType()),
}


@dataclass(frozen=True)
class FieldSpec:
    name: str
    dtype: str
    max_length: int | None = None
    dim: int | None = None
    primary_key: bool = False
    auto_id: bool = False
    nullable: bool = True
    element_type: str | None = None
    max_capacity: int | None = None
    analyzer: dict | None = None
    exclude: bool = False  # left out of default outputs (vectors)
    alias: str | None = None  # name used in a typed document view (PRJ-3)

    def spark_type(self) -> T.DataType:
        if self.dtype == "array":
            return T.ArrayType(_SPARK_TYPES[self.element_type or "varchar"])
        return _SPARK_TYPES[self.dtype]

    def struct_field(self) -> T.StructField:
        meta = {k: v for k, v in {"dtype": self.dtype, "max_length": self.max_length, "dim": self.dim,
                                  "primary_key": self.primary_key, "max_capacity": self.max_capacity,
                                  "analyzer": self.analyzer, "exclude": self.exclude}.items() if v}
        return T.StructField(self.name, self.spark_type(), self.nullable and not self.primary_key, meta)


# Field factories (one per reference field type).
def varchar(name, max_length=DEFAULT_TEXT_LENGTH, **kw): return FieldSpec(name, "varchar", max_length=max_length, **kw)
def varchar_key(name, max_length=DEFAULT_KEY_LENGTH): return FieldSpec(name, "varchar", max_length=max_length, primary_key=True, nullable=False)
def int64_key(name, auto_id=False): return FieldSpec(name, "int64", primary_key=True, auto_id=auto_id, nullable=False)
def text_with_analyzer(name, max_length=DEFAULT_TEXT_LENGTH, analyzer=None):
    return FieldSpec(name, "varchar", max_length=max_length, analyzer=analyzer or dict(DEFAULT_ANALYZER))
def int64(name): return FieldSpec(name, "int64")
def int32(name): return FieldSpec(name, "int32")
def int16(name): return FieldSpec(name, "int16")
def int8(name): return FieldSpec(name, "int8")
def float_(name): return FieldSpec(name, "float")
def double(name): return FieldSpec(name, "double")
def bool_(name): return FieldSpec(name, "bool")
def json_(name): return FieldSpec(name, "json")
def float_vector(name, dim=DEFAULT_DIM): return FieldSpec(name, "float_vector", dim=dim, exclude=True)
def binary_vector(name, dim): return FieldSpec(name, "binary_vector", dim=dim, exclude=True)
def sparse_vector(name): return FieldSpec(name, "sparse_vector", exclude=True)
def array(name, element_type, max_capacity): return FieldSpec(name, "array", element_type=element_type, max_capacity=max_capacity)


@dataclass(frozen=True)
class CollectionSpec:
    name: str
    fields: tuple[FieldSpec, ...]
    description: str = ""
    enable_dynamic_field: bool = True
    bm25: tuple[tuple[str, str], ...] = ()  # (input text field, output sparse field)

    def struct_type(self) -> T.StructType:
        return T.StructType([f.struct_field() for f in self.fields])

    def field(self, name: str) -> FieldSpec:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    @property
    def primary_key(self) -> FieldSpec | None:
        return next((f for f in self.fields if f.primary_key), None)

    def default_columns(self) -> list[str]:
        """PRJ-1: declared fields not marked excluded, in declared order."""
        return [f.name for f in self.fields if not f.exclude]

    def analyzer_of(self, name: str) -> str | None:
        """The pattern by which BM25 cuts a text field: None is the default
        analyzer, which serves every ``type`` but ``whitespace``; ``pattern``
        is a Java regex with one group."""
        setting = self.field(name).analyzer or {}
        if "pattern" in setting:
            return setting["pattern"]
        return r"(\S+)" if setting.get("type") == "whitespace" else None

    def with_field(self, spec: FieldSpec) -> "CollectionSpec":
        return replace(self, fields=self.fields + (spec,))


def default_schema(dim: int = DEFAULT_DIM) -> CollectionSpec:
    return CollectionSpec("default", (varchar_key("id"), varchar("content"), float_vector("embedding", dim),
                                      json_("metadata")), enable_dynamic_field=True)


def simple_schema(dim: int = DEFAULT_DIM) -> CollectionSpec:
    return CollectionSpec("simple", (varchar_key("id"), float_vector("embedding", dim)), enable_dynamic_field=True)


def document_schema(dim: int = DEFAULT_DIM, bm25: bool = False, key_length: int = 128) -> CollectionSpec:
    content = text_with_analyzer("content") if bm25 else varchar("content")
    return CollectionSpec("document", (varchar_key("id", key_length), content, float_vector("embedding", dim),
                                       sparse_vector("sparse"), json_("metadata")),
                          enable_dynamic_field=False, bm25=(("content", "sparse"),) if bm25 else ())


def segment_schema(dim: int = DEFAULT_DIM, bm25: bool = True) -> CollectionSpec:
    content = text_with_analyzer("content") if bm25 else varchar("content")
    fields = (varchar_key("id"), varchar("file_id", DEFAULT_KEY_LENGTH), content, float_vector("embedding", dim))
    fields += (sparse_vector("sparse"),) if bm25 else ()
    fields += (json_("metadata"),)
    return CollectionSpec("segment", fields, enable_dynamic_field=False,
                          bm25=(("content", "sparse"),) if bm25 else ())


def _derived(spec: CollectionSpec) -> set[str]:
    return {out for _, out in spec.bm25}


def undeclared_columns(df: DataFrame, spec: CollectionSpec, ignore=("partition_name", "seq")) -> list[str]:
    declared = {f.name for f in spec.fields}
    return [c for c in df.columns if c not in declared and c not in ignore]


def pack_dynamic_fields(df: DataFrame, spec: CollectionSpec, column: str = DYNAMIC_COLUMN,
                        variant: bool = False) -> DataFrame:
    """SRC-5: undeclared columns go to one JSON column (nulls omitted), or to
    a VARIANT column, which is parsed once, when written.  With dynamic fields
    disabled they are an error."""
    extra = undeclared_columns(df, spec)
    if not extra:
        return df
    if not spec.enable_dynamic_field:
        raise ValueError(f"columns {extra} are not declared and dynamic fields are disabled")
    packed = F.to_json(F.struct(*[F.col(c) for c in extra]))
    return df.withColumn(column, F.parse_json(packed) if variant else packed).drop(*extra)


def dynamic_field(column, name: str, dtype: str) -> Column:
    """One dynamic field as a typed column; NULL where a row lacks the field
    or holds a value that is not of the type."""
    column = F.col(column) if isinstance(column, str) else column
    if not name or "'" in name or "?" in name:  # a variant path cannot hold these
        entries = column.cast("map<string,variant>")
        return F.try_variant_get(F.try_element_at(entries, F.lit(name)), "$", dtype)
    return F.try_variant_get(column, f"$['{name}']", dtype)


def with_dynamic_fields(df: DataFrame, fields: dict[str, str], column: str = DYNAMIC_COLUMN) -> DataFrame:
    """``df`` with some dynamic fields (name to SQL type) as columns of their
    own, so that predicates, ``columns=`` arguments and joins can name them
    like declared ones.  They are expressions of the projection: a filter on
    one is evaluated in the scan, and what no one reads is not parsed.

    ``column`` is a VARIANT or a JSON string (invalid JSON has no fields).  A
    field with the name of a column of ``df`` is an error."""
    clash = [n for n in fields if n.lower() in {c.lower() for c in df.columns}]
    if clash:
        raise ValueError(f"fields {clash} are declared columns already")
    packed = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        packed = F.try_parse_json(packed)
    return df.select("*", *[dynamic_field(packed, n, t).alias(n) for n, t in fields.items()])


def _violations(df: DataFrame, spec: CollectionSpec, allow_missing_vectors: bool) -> list[Column]:
    checks: list[Column] = []

    def add(cond: Column, message: str) -> None:
        checks.append(F.when(F.coalesce(cond, F.lit(False)), F.lit(message)))

    derived = _derived(spec)
    for f in spec.fields:
        if f.name in derived:
            continue  # machine-generated (BM25 output)
        if f.name not in df.columns:
            if not f.nullable or f.primary_key:
                checks.append(F.lit(f"{f.name}: missing column"))
            continue
        c = F.col(f.name)
        if f.primary_key or not f.nullable:
            add(c.isNull(), f"{f.name}: null")
        if f.dtype == "varchar" and f.max_length:
            add(F.octet_length(c) > f.max_length, f"{f.name}: longer than {f.max_length} bytes")
        elif f.dtype in _INT_RANGES:
            lo, hi = _INT_RANGES[f.dtype]
            add((c < lo) | (c > hi), f"{f.name}: out of {f.dtype} range")
        elif f.dtype == "json":
            add(c.isNotNull() & F.try_parse_json(c).isNull(), f"{f.name}: not JSON")
        elif f.dtype == "float_vector":
            if not allow_missing_vectors:
                add(c.isNull() | (F.size(c) == 0), f"{f.name}: missing vector")
            if f.dim:
                add(c.isNotNull() & (F.size(c) > 0) & (F.size(c) != f.dim), f"{f.name}: dimension is not {f.dim}")
            add(F.exists(c, lambda x: x.isNull()), f"{f.name}: null element")
            add(F.exists(c, lambda x: F.isnan(x)), f"{f.name}: NaN element")
        elif f.dtype == "binary_vector" and f.dim:
            add(F.octet_length(c) * 8 != f.dim, f"{f.name}: dimension is not {f.dim}")
        elif f.dtype == "array" and f.max_capacity:
            add(F.size(c) > f.max_capacity, f"{f.name}: more than {f.max_capacity} elements")
    if not spec.enable_dynamic_field:
        for extra in undeclared_columns(df, spec):
            add(F.col(extra).isNotNull(), f"{extra}: undeclared field")
    return checks


def validate_batch(df: DataFrame, spec: CollectionSpec, *, allow_missing_vectors: bool = True,
                   key_cols=("partition_name",), existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """SRC-6: split a batch into (good rows, bad rows + ``violations``).

    Row checks are one projection.  Key uniqueness is a ``groupBy`` on the
    key (partial counts before the shuffle) whose duplicate keys are joined
    back; AQE splits a hot key's partition, so no key's rows gather in one
    task.  Missing vectors are allowed unless ``allow_missing_vectors`` is
    false (D13).

    Keys that ``existing`` (a stored table) holds already are violations as
    well.  Its key columns alone are read and semi-joined with the batch's
    keys, so Spark can broadcast those or filter the stored side by a runtime
    Bloom filter before it is shuffled.
    """
    checks = _violations(df, spec, allow_missing_vectors)
    pk = spec.primary_key
    flagged = df
    if pk is not None and pk.name in df.columns:
        key = [c for c in key_cols if c in df.columns] + [pk.name]
        dups = (df.where(F.col(pk.name).isNotNull()).groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > 1).select(*key, F.lit(True).alias("_dup")))
        same = [F.col(f"_key_{c}").eqNullSafe(df[c]) for c in key]
        flagged = df.join(dups.withColumnsRenamed({c: f"_key_{c}" for c in key}), same, "left").drop(
            *[f"_key_{c}" for c in key])
        checks.append(F.when(F.col("_dup"), F.lit(f"{pk.name}: duplicate key")))
        if existing is not None:
            key = [c for c in key if c in existing.columns]
            own = df.where(F.col(pk.name).isNotNull()).select(*[F.col(c).alias(f"_own_{c}") for c in key])
            stored = existing.select(*[F.col(c).alias(f"_key_{c}") for c in key])
            held = (stored.join(own, [F.col(f"_key_{c}").eqNullSafe(F.col(f"_own_{c}")) for c in key], "left_semi")
                    .distinct().withColumn("_held", F.lit(True)))
            flagged = flagged.join(held, [F.col(f"_key_{c}").eqNullSafe(F.col(c)) for c in key], "left").drop(
                *[f"_key_{c}" for c in key])
            checks.append(F.when(F.col("_held"), F.lit(f"{pk.name}: key exists")))
    arr = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
    out = flagged.withColumn("violations", arr)
    out = out.drop("_dup", "_held")
    good = out.where(F.size("violations") == 0).drop("violations")
    bad = out.where(F.size("violations") > 0)
    return good, bad


def typed_view(df: DataFrame, *specs: CollectionSpec, include_vectors: bool = False) -> DataFrame:
    """PRJ-3: the columns of a document class, most specific spec first.

    Fields of the first spec win over same-named fields of later (parent)
    specs; a field's ``alias`` renames it in the view; vector fields are
    left out unless ``include_vectors``.
    """
    seen: set[str] = set()
    cols = []
    for spec in specs:
        for f in spec.fields:
            if f.name in seen or f.name not in df.columns or (f.exclude and not include_vectors):
                continue
            seen.add(f.name)
            cols.append(F.col(f.name).alias(f.alias or f.name))
    return df.select(*cols)


def with_auto_id(df: DataFrame, key_cols, id_col: str = "id") -> DataFrame:
    """An id derived from content columns: the first 16 hex digits
    (64 bits) of the md5 of the key columns joined by ``|``.

    Stable across retries and re-runs, unlike ``monotonically_increasing_id``.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]
    return df.withColumn(id_col, F.substring(F.md5(F.concat_ws("|", *parts)), 1, 16))
