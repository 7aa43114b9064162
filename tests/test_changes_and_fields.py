"""Changes across batches, dynamic fields, isolated model failures, keys against a stored table."""

import contextlib
import io
import uuid

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from quarry.functions.embed import HashEmbedder, embed_documents, embed_each
from quarry.operators.tables import upsert
from quarry.session import ensure_checkpoint_dir
from quarry.sources.schema import (CollectionSpec, default_schema, pack_dynamic_fields, varchar_key, validate_batch,
                                   with_dynamic_fields)
from quarry.sources.versions import read_current, write_version
from quarry.streaming.upsert_sink import apply_batch

ROW = "id string, partition_name string, content string, seq long"


def newest(batches):
    """A dict by key: a change replaces what it finds unless that has a higher seq."""
    table = {}
    rank = lambda s: (s is not None, s or 0)
    for batch in batches:
        for key, part, text, seq in batch:
            at = (part or "_default", key)
            if at not in table or rank(seq) >= rank(table[at][1]):
                table[at] = (text, seq)
    return table


CHANGE = st.tuples(st.sampled_from("ab"), st.sampled_from([None, "", "p"]), st.sampled_from([None, 1, 2, 3]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(CHANGE, max_size=4, unique_by=lambda c: (c[0], c[1] or "")), min_size=1, max_size=3))
def test_late_changes_lose(spark, drawn):
    batches = [[(k, p, f"{n}-{i}", s) for i, (k, p, s) in enumerate(batch)] for n, batch in enumerate(drawn)]
    table = spark.createDataFrame([], ROW)
    for batch in batches:
        table = spark.createDataFrame(
            upsert(table, spark.createDataFrame(batch, ROW)).select("id", "partition_name", "content", "seq").collect(), ROW)
    got = {(r.partition_name, r.id): (r.content, r.seq) for r in table.collect()}
    assert table.count() == len(got)
    assert got == newest(batches)


def test_late_batches_of_a_stored_table(spark):
    root = f"{ensure_checkpoint_dir(spark)}/test-late-{uuid.uuid4().hex}"
    write_version(spark.createDataFrame([("a", "p", "old", 5), ("b", "p", "old", None), ("a", "p", "twin", 4)], ROW), root)
    apply_batch(spark.createDataFrame([("a", "p", "late", 3), ("b", "p", "new", 0), ("c", None, "first", None)], ROW), 0, root)
    apply_batch(spark.createDataFrame([("c", "", "same", None), ("b", "p", "late", None)], ROW), 1, root)
    got = sorted((r.id, r.content, r.seq) for r in read_current(spark, root).collect())
    assert got == [("a", "old", 5), ("a", "twin", 4), ("b", "new", 0), ("c", "same", None)]


def dynamic_rows(spark):
    rows = [("1", "x", 7, "a.b", None), ("2", "y", None, "q", 1.5), ("3", None, 9, None, None)]
    return spark.createDataFrame(rows, "id string, lang string, `n?` long, `a.b` string, `it's` double")


@pytest.mark.parametrize("variant", [True, False])
def test_dynamic_fields_can_be_filtered(spark, variant):
    df = dynamic_rows(spark)
    spec = CollectionSpec("c", (varchar_key("id"),), enable_dynamic_field=True)
    quoted = df.select("id", F.to_json(F.struct("lang", "`n?`", "`a.b`", "`it's`")).alias("dynamic_fields"))
    packed = quoted if not variant else quoted.withColumn("dynamic_fields", F.parse_json("dynamic_fields"))
    kinds = {"lang": "string", "n?": "long", "a.b": "string", "it's": "double", "none": "int"}
    wide = with_dynamic_fields(packed, kinds)
    assert [tuple(r) for r in wide.select("id", "lang", "`n?`", "`a.b`", "`it's`", "none").orderBy("id").collect()] == [
        (*r, None) for r in df.orderBy("id").collect()]
    assert [r.id for r in wide.where("`n?` > 7 OR lang = 'x'").orderBy("id").collect()] == ["1", "3"]
    # a value that is not of the type is missing; a field never hides a column
    assert with_dynamic_fields(packed, {"lang": "int"}).where("lang IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="declared"):
        with_dynamic_fields(packed, {"ID": "string"})
    plain = pack_dynamic_fields(df.select("id", "lang"), spec, variant=variant)
    assert with_dynamic_fields(plain, {"lang": "string"}).where("lang = 'y'").first()["id"] == "2"


def test_invalid_json_has_no_fields(spark):
    df = spark.createDataFrame([("1", "{"), ("2", None), ("3", "[1]"), ("4", '{"k": null}'), ("5", '{"k": 2}')],
                               "id string, dynamic_fields string")
    assert [r.id for r in with_dynamic_fields(df, {"k": "int"}).where("k IS NOT NULL").collect()] == ["5"]


def test_a_dynamic_filter_is_one_projection(spark):
    root = f"{ensure_checkpoint_dir(spark)}/test-dyn-{uuid.uuid4().hex}"
    pack_dynamic_fields(dynamic_rows(spark).select("id", "lang"), default_schema(4), variant=True).write.parquet(root)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        with_dynamic_fields(spark.read.parquet(root), {"lang": "string"}).where("lang = 'x'").select("id").explain()
    assert "Exchange" not in buf.getvalue() and "Python" not in buf.getvalue()


class Picky:
    """Fails on any batch that holds a bad text; counts its calls."""

    dim, input = 2, "text"

    def __init__(self):
        self.calls = 0

    def embed_batch(self, values):
        self.calls += 1
        if any(v.startswith("bad") for v in values):
            raise RuntimeError("cannot")
        return [None if v == "none" else np.ones(3 if v == "long" else 2) for v in values]


def test_failures_stand_alone():
    model = Picky()
    values = [f"t{i}" for i in range(1000)]
    values[17], values[900], values[3], values[4] = "bad 1", "bad 2", "long", "none"
    vectors, reasons = embed_each(model, values)
    assert {i: r for i, r in enumerate(reasons) if r} == {
        17: "RuntimeError: cannot", 900: "RuntimeError: cannot", 3: "ValueError: 3 components instead of 2"}
    assert [i for i, v in enumerate(vectors) if v is None] == [3, 4, 17, 900]
    assert model.calls < 50
    assert embed_each(model, []) == ([], [])


def test_embedding_keeps_what_succeeds(spark):
    rows = [("1", "good", None), ("2", "bad", None), ("3", "", None), ("4", None, None), ("5", "bad", [9.0, 9.0])]
    df = spark.createDataFrame(rows, "id string, content string, embedding array<float>")
    got = {r.id: (r.embedding, r.why) for r in embed_documents(df, Picky(), errors_col="why").collect()}
    assert got == {"1": ([1.0, 1.0], None), "2": (None, "RuntimeError: cannot"), "3": (None, None), "4": (None, None),
                   "5": ([9.0, 9.0], None)}
    with pytest.raises(Exception, match="cannot"):
        embed_documents(df, Picky()).collect()
    assert embed_documents(df, None, errors_col="why").where("why IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="more than 1 tokens"):
        HashEmbedder(max_tokens=1).embed_batch([["a", "b"]])


def test_keys_of_a_stored_table(spark):
    spec = CollectionSpec("c", (varchar_key("id"),), enable_dynamic_field=True)
    cols = "id string, partition_name string"
    stored = spark.createDataFrame([("1", "p"), ("1", "p"), ("2", None), ("3", "q"), (None, "p")], cols)
    batch = spark.createDataFrame([("1", "p"), ("2", None), ("3", "p"), (None, "p"), ("4", "q"), ("4", "q")], cols)
    good, bad = validate_batch(batch, spec, existing=stored)
    assert good.columns == ["id", "partition_name"]
    assert [tuple(r) for r in good.collect()] == [("3", "p")]
    why = sorted(((r.id or "", r.violations) for r in bad.collect()))
    assert why == [("", ["id: null"]), ("1", ["id: key exists"]), ("2", ["id: key exists"]),
                   ("4", ["id: duplicate key"]), ("4", ["id: duplicate key"])]
    assert validate_batch(batch, spec, existing=stored.limit(0))[1].count() == 3
