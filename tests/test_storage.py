"""Versioned writes, index persistence and the streaming upsert sink."""

import contextlib
import io
import uuid

from pyspark.sql import functions as F

from quarry.operators.bm25 import Bm25Index, bm25_search, build_bm25_index
from quarry.operators.ivf import IvfIndex, build_ivf, ivf_search
from quarry.plans.workloads import _conversation_docs, _seg, _vector_queries
from quarry.session import ensure_checkpoint_dir
from quarry.sources.versions import compact_table, current_version, read_current, write_version
from quarry.streaming.upsert_sink import apply_batch
from tests.conftest import SF_SMALL


def scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/test-{name}-{uuid.uuid4().hex}"


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_versions_and_compaction(spark):
    root = scratch(spark, "versions")
    seg = _seg(spark, SF_SMALL)
    assert current_version(spark, root) is None
    assert write_version(seg.repartition(7), root) == 1
    # a partition that became empty disappears in the next version
    assert write_version(seg.where("partition_name <> 'partition_en'"), root) == 2
    assert read_current(spark, root).where("partition_name = 'partition_en'").count() == 0
    assert compact_table(spark, root, rows_per_file=50) == 3
    cols = ["id", "file_id", "partition_name"]
    assert rows(read_current(spark, root), cols) == rows(seg.where("partition_name <> 'partition_en'"), cols)


def test_streaming_batch_is_idempotent(spark):
    root = scratch(spark, "stream")
    write_version(_seg(spark, SF_SMALL), root)
    batch = _conversation_docs(spark, SF_SMALL)
    assert apply_batch(batch, 0, root) == 2
    assert apply_batch(batch, 0, root) is None  # replayed batch: skipped
    assert read_current(spark, root).count() == _seg(spark, SF_SMALL).count() + batch.count()


def test_bm25_index_round_trip(spark):
    seg = _seg(spark, SF_SMALL)
    index = build_bm25_index(seg)
    root = scratch(spark, "bm25")
    index.write(root, n_files=4)
    back = Bm25Index.read(spark, root)
    q = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    cols = ["query_id", "rank", "id", "score"]
    assert rows(bm25_search(back, q, 5, columns=[]), cols) == rows(bm25_search(index, q, 5, columns=[]), cols)


def test_ivf_index_round_trip(spark):
    seg = _seg(spark, SF_SMALL)
    index = build_ivf(seg, nlist=4, kind="sq8")
    root = scratch(spark, "ivf")
    index.write(root)
    back = IvfIndex.read(spark, root)
    q = _vector_queries(spark, SF_SMALL)
    cols = ["query_id", "rank", "id", "score"]
    assert rows(ivf_search(back, q, 5, nprobe=2, columns=[]), cols) == rows(ivf_search(index, q, 5, nprobe=2, columns=[]), cols)


def test_stored_changes_equal_the_pure_ones(spark):
    from quarry.operators import tables as tb
    from quarry.sources.versions import delete_from_table, upsert_table
    root = scratch(spark, "partial")
    seg = _seg(spark, SF_SMALL)
    write_version(seg, root)
    conv = _conversation_docs(spark, SF_SMALL)
    v2 = upsert_table(spark, root, conv)
    cols = ["id", "file_id", "partition_name", "content"]
    assert rows(read_current(spark, root), cols) == rows(tb.upsert(seg, conv), cols)
    # delete a whole partition by filter: it becomes empty in the current table
    v3 = delete_from_table(spark, root, pred="partition_name = 'partition_user'")
    assert v3 == v2 + 1
    after = read_current(spark, root)
    assert after.where("partition_name = 'partition_user'").count() == 0
    assert rows(after, cols) == rows(tb.upsert(seg, conv).where("partition_name <> 'partition_user'"), cols)
    ids = spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("toxic = 1").select(
        F.col("doc_id").cast("string").alias("id"))
    delete_from_table(spark, root, ids=ids)
    expect = tb.delete_by_ids(tb.upsert(seg, conv).where("partition_name <> 'partition_user'"), ids)
    assert rows(read_current(spark, root), cols) == rows(expect, cols)
    # nothing matched: no new version
    assert delete_from_table(spark, root, pred="id = 'no such id'") is None
    # compaction keeps the rows
    compact_table(spark, root, rows_per_file=100)
    assert rows(read_current(spark, root), cols) == rows(expect, cols)


def test_bm25_saved_table_searches_without_shuffle(spark):
    seg = _seg(spark, SF_SMALL)
    index = build_bm25_index(seg)
    name = f"bm25_{uuid.uuid4().hex[:8]}"
    index.save_table(name, 8, path=scratch(spark, "bm25tbl"))
    back = Bm25Index.from_table(spark, name)
    q = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    cols = ["query_id", "rank", "id", "score"]
    got = bm25_search(back, q, 5, columns=[])
    assert rows(got, cols) == rows(bm25_search(index, q, 5, columns=[]), cols)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain()
    plan = buf.getvalue()
    # no exchange between the per-(query, doc) sum and the join with the bucketed postings
    between = plan.split("HashAggregate(keys=[query_id", 1)[1].split("BroadcastHashJoin", 1)[0]
    assert "Exchange" not in between


def test_index_specs_by_name(spark):
    from quarry.operators.knn import vector_search
    from quarry.plans.indexes import IndexSpec, build_index
    seg, q = _seg(spark, SF_SMALL), _vector_queries(spark, SF_SMALL)
    assert build_index(seg, IndexSpec.flat()) is None
    cols = ["query_id", "rank", "id", "score"]
    exact = rows(vector_search(seg, q, 5, columns=[]), cols)
    for spec in (IndexSpec.auto(4), IndexSpec.hnsw(4), IndexSpec.ivf_flat(4)):
        index = build_index(seg, spec)
        assert index.kind == "flat" and index.nlist >= 1
        assert rows(ivf_search(index, q, 5, nprobe=index.nlist, columns=[]), cols) == exact
    assert build_index(seg, IndexSpec.ivf_sq8(4)).kind == "sq8"
    assert build_index(seg, IndexSpec.ivf_pq(2, m=8, nbits=4)).kind == "pq"
    bm = build_index(seg, IndexSpec.sparse_wand(drop_ratio_search=0.3))
    text = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    assert rows(bm25_search(bm, text, 5, columns=[]), cols) == rows(
        bm25_search(build_bm25_index(seg), text, 5, drop_ratio=0.3, columns=[]), cols)


def test_stored_add_and_drop_partition(spark):
    from quarry.operators import tables as tb
    from quarry.sources.versions import add_to_table, drop_partition_table
    root = scratch(spark, "adddrop")
    seg = _seg(spark, SF_SMALL)
    write_version(seg, root)
    conv = _conversation_docs(spark, SF_SMALL)
    add_to_table(spark, root, conv)
    cols = ["id", "file_id", "partition_name", "content"]
    assert rows(read_current(spark, root), cols) == rows(tb.add(seg, conv), cols)
    v = drop_partition_table(spark, root, "partition_en")
    assert v == 3
    assert rows(read_current(spark, root), cols) == rows(tb.drop_partition(tb.add(seg, conv), "partition_en"), cols)


def test_compaction_sized_from_bytes(spark):
    from quarry.sources.versions import current_bytes
    root = scratch(spark, "bytes")
    seg = _seg(spark, SF_SMALL)
    write_version(seg.repartition(12), root)
    size = current_bytes(spark, root)
    assert size > 0
    v = compact_table(spark, root, target_file_mb=size / (4 * 1024 * 1024))  # about 4 output files
    n_files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true").load(f"{root}/v={v}").count()
    assert 4 <= n_files <= 4 * 4  # range partitions split further by partition directory
    cols = ["id", "file_id", "partition_name"]
    assert rows(read_current(spark, root), cols) == rows(seg, cols)


DOC = "id string, file_id string, content string, partition_name string"


def _docs(spark, rows, extra=""):
    return spark.createDataFrame(rows, DOC + extra)


def test_no_row_is_lost_for_its_partition(spark):
    """NULL, empty and numeric partition names survive every change."""
    from quarry.operators import tables as tb
    from quarry.sources.versions import add_to_table, delete_from_table, upsert_table
    base = _docs(spark, [("a", "f1", "x", None), ("b", "f2", "x", "001"), ("c", "f3", "x", ""), ("d", "f4", "x", "2")])
    change = _docs(spark, [("a", "f1", "new", None), ("z", "f9", "new", "001"), ("y", "f9", "new", "")])
    got = {r.id: r.content for r in tb.upsert(base, change).collect()}
    assert got == {"a": "new", "b": "x", "c": "x", "d": "x", "z": "new", "y": "new"}

    root = scratch(spark, "names")
    write_version(base, root)
    names = {r.id: r.partition_name for r in read_current(spark, root).collect()}
    assert names == {"a": "_default", "b": "001", "c": "_default", "d": "2"}
    upsert_table(spark, root, change)
    assert {r.id: r.content for r in read_current(spark, root).collect()} == got
    assert delete_from_table(spark, root, pred="file_id = 'f1'") == 3
    assert {r.id for r in read_current(spark, root).collect()} == {"b", "c", "d", "z", "y"}
    add_to_table(spark, root, _docs(spark, [("n", "f", "x", None), ("m", "f", "x", "001")]))
    assert {r.id: r.partition_name for r in read_current(spark, root).collect()} == {
        "b": "001", "c": "_default", "d": "2", "z": "001", "y": "_default", "n": "_default", "m": "001"}


def test_null_seq_is_the_lowest(spark):
    from quarry.operators import tables as tb
    base = _docs(spark, [])
    change = _docs(spark, [("n1", "f", "only", "p", None), ("n2", "f", "old", "p", None), ("n2", "f", "new", "p", 3)],
                   ", seq long")
    assert {r.id: r.content for r in tb.upsert(base, change).collect()} == {"n1": "only", "n2": "new"}


def test_a_shared_folder_must_be_named(spark):
    import pytest
    from quarry.session import ensure_checkpoint_dir
    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = {}, Context()
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_upserts_write_their_rows_only(spark):
    """every upsert wrote the whole table again."""
    from quarry.sources.versions import add_to_table, current_bytes, upsert_table
    root = f"{ensure_checkpoint_dir(spark)}/test-changes-{uuid.uuid4().hex}"
    schema = "id string, partition_name string, content string, n long"
    base = spark.createDataFrame([(str(i), "p", "old", i) for i in range(40)] + [(None, "p", "null", 0)], schema)
    write_version(base, root)
    held = {(r.id, r.partition_name): (r.content, r.n) for r in base.collect()}
    before = current_bytes(spark, root)
    files = lambda: spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(root)
    whole = files().where("path LIKE '%/v=%'").count()
    for turn in range(4):  # new rows, rows changed before, a null id, a null partition, a column less
        ids = [str(turn), str(turn + 1), f"new{turn}", None]
        upsert_table(spark, root, spark.createDataFrame([(i, "p", f"t{turn}") for i in ids] + [("x", None, f"t{turn}")],
                                                        "id string, partition_name string, content string"))
        held |= {(i, "p"): (f"t{turn}", None) for i in ids}
        held[("x", "default")] = (f"t{turn}", None)
        got = {(r.id, "default" if r.id == "x" else r.partition_name): (r.content, r.n)
               for r in read_current(spark, root).collect()}
        assert got == held and read_current(spark, root).count() == len(held)
    assert files().where("path LIKE '%/v=%'").count() == whole and current_bytes(spark, root) > before
    spark.range(1).select(F.lit("0").alias("id"), F.lit("p").alias("partition_name"), F.lit("crashed").alias("content"),
                          F.lit(9).cast("long").alias("n")).write.parquet(f"{root}/changes=1/_change=9")
    assert read_current(spark, root).where("content = 'crashed'").count() == 0  # no marker names it
    many = spark.createDataFrame([(f"m{i}", "p", "many", i) for i in range(60)], schema)
    assert upsert_table(spark, root, many) == 6  # the rows since then outnumber the table's
    assert upsert_table(spark, root, many.limit(1).withColumn("content", F.lit("last"))) == 7
    assert spark.read.parquet(f"{root}/v=7").count() == len(held) + 60
    add_to_table(spark, root, many.limit(1))
    assert read_current(spark, root).count() == len(held) + 61
