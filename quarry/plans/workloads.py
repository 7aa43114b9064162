"""Named queries over the driver tables, one per operator of SURVEY §2.

Every query reads whole tables (no id subsets, no row caps); a limit
appears only where it is the feature (top-k, page size).  Each has a
DuckDB counterpart of the same name in :mod:`quarry.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.embed import HashEmbedder, embed_documents, embed_queries
from ..functions.metadata import set_metadata
from ..functions.partitions import knowledge_id, partition_collisions, partition_name
from ..functions.vectors import cosine
from ..operators import tables as tb
from ..operators.bm25 import bm25_search, build_bm25_index
from ..operators.bm25_pruned import bm25_pruned_search
from ..operators.hybrid import compare_methods, hybrid_search, overlap_at_k
from ..operators.ivf import IvfIndex, build_ivf, exact_ivf_search, ivf_search, recall_at_k
from ..operators.knn import vector_search
from ..session import ensure_checkpoint_dir, materialize
from ..sources.rows import from_json_rows, promote_metadata_field, to_json_rows
from ..sources.schema import (CollectionSpec, FieldSpec, default_schema, pack_dynamic_fields, segment_schema,
                              typed_view, validate_batch, with_auto_id, with_dynamic_fields)
from ..sources.segments import read_table, testdata_segments, testdata_vector_segments
from ..sources.versions import compact_table, read_current, write_version
from ..streaming.upsert_sink import upsert_stream
from .search import QueryRequest, SearchRequest, SearchType, run_query, search


def _vector_queries(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("query_id"),
                                                      F.col("embedding").alias("vector"))


def vector_exact(metric: str, **kw) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return vector_search(testdata_vector_segments(spark, sf), _vector_queries(spark, sf), k=kw.get("k", 10),
                             offset=kw.get("offset", 0), metric=metric,
                             pred=kw.get("pred"), partitions=kw.get("partitions"),
                             threshold=kw.get("threshold", 0.0), columns=kw.get("columns", []))
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "vector_exact_cosine": vector_exact("cosine"),
    "vector_exact_ip": vector_exact("ip"),
    "vector_exact_l2": vector_exact("l2"),
    "vector_filtered": vector_exact("cosine", pred="file_id IN ('src1', 'src2', 'src3')", columns=["file_id"]),
    "vector_partitions": vector_exact("cosine", partitions=["partition_en", "partition_fr"]),
    "vector_offset": vector_exact("cosine", k=5, offset=5),
    "vector_threshold": vector_exact("cosine", threshold=0.25),
}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Exact cosine top-10 of every embedding against the segments corpus."""
    return QUERIES["vector_exact_cosine"](spark, sf)


# ------------------------------------------------------------ reads, filters

PAGE_COLS = ["id", "file_id", "partition_name", "content"]
ROW_COLS = ["id", "file_id", "partition_name"]


def _seg(spark, sf):
    return testdata_segments(spark, sf)


def _labels(spark, sf, where):
    return read_table(spark, sf, "labels").where(where).select(F.col("doc_id").cast("string").alias("id"))


def _knowledge_ids(spark, sf):
    d = read_table(spark, sf, "documents")
    return (d.select(F.concat_ws("-", "lang", "source").alias("knowledge_id"))
            .unionByName(d.select(F.concat_ws("_", "lang", "source").alias("knowledge_id"))).distinct())


def _conversation_docs(spark, sf):
    c = read_table(spark, sf, "conversations")
    return c.select(F.concat(F.lit("conv_"), F.col("conv_id").cast("string"), F.lit("_"),
                             F.col("turn").cast("string")).alias("id"),
                    F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("file_id"),
                    F.col("text").alias("content"),
                    F.lit(None).cast("array<float>").alias("embedding"),
                    F.to_json(F.struct("role")).alias("metadata"),
                    partition_name("role").alias("partition_name"))


def _upsert_changes(spark, sf):
    d = read_table(spark, sf, "documents")
    lab = read_table(spark, sf, "labels").where("quality = 0")
    changed = (d.join(lab, "doc_id", "left_semi")
               .select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("file_id"),
                       F.concat("text", F.lit(" (rev)")).alias("content"), F.lit(None).cast("array<float>").alias("embedding"),
                       F.lit("{}").alias("metadata"), partition_name("lang").alias("partition_name")))
    return changed.unionByName(_conversation_docs(spark, sf))


def _compact(spark, sf):
    import uuid
    root = f"{ensure_checkpoint_dir(spark)}/quarry-compact-{uuid.uuid4().hex}"
    write_version(_seg(spark, sf).repartition(16), root)
    compact_table(spark, root, rows_per_file=5000)
    return read_current(spark, root).select(*ROW_COLS)


QUERIES.update({
    "query_page": lambda s, sf: tb.query(_seg(s, sf), pred="file_id IN ('src1', 'src2')", offset=20,
                                         limit=100, columns=PAGE_COLS),
    "query_columns": lambda s, sf: tb.query(_seg(s, sf), partition="partition_de", columns=["id", "file_id"]),
    "get_by_ids": lambda s, sf: tb.get_by_ids(_seg(s, sf), _labels(s, sf, "quality = 1"), columns=ROW_COLS),
    "get_by_ids_partition": lambda s, sf: tb.get_by_ids(_seg(s, sf), _labels(s, sf, "quality = 1"),
                                                        partition="partition_en", columns=ROW_COLS),
    "filter_eq": lambda s, sf: tb.filter_eq(_seg(s, sf), "file_id", "src3").select(*ROW_COLS),
    "filter_in": lambda s, sf: tb.filter_in(
        _seg(s, sf), "file_id",
        read_table(s, sf, "documents").join(read_table(s, sf, "labels").where("toxic = 1"), "doc_id", "left_semi")
        .select("source")).select(*ROW_COLS),
    "count_all": lambda s, sf: tb.count(_seg(s, sf)),
    "count_partition": lambda s, sf: tb.count(_seg(s, sf), partition="partition_en"),
    "list_partitions": lambda s, sf: tb.list_partitions(_seg(s, sf)),
    "partition_name": lambda s, sf: _knowledge_ids(s, sf).select(
        "knowledge_id", partition_name("knowledge_id").alias("partition_name")),
    "knowledge_id": lambda s, sf: _seg(s, sf).select("partition_name").distinct().select(
        "partition_name", knowledge_id("partition_name").alias("knowledge_id")),
    "partition_collisions": lambda s, sf: partition_collisions(_knowledge_ids(s, sf)),
    "add": lambda s, sf: tb.add(_seg(s, sf), _conversation_docs(s, sf)).select(*PAGE_COLS),
    "upsert": lambda s, sf: tb.upsert(_seg(s, sf), _upsert_changes(s, sf)).select(*PAGE_COLS),
    "delete_by_ids": lambda s, sf: tb.delete_by_ids(_seg(s, sf), _labels(s, sf, "toxic = 1")).select(*ROW_COLS),
    "delete_by_filter": lambda s, sf: tb.delete_by_filter(_seg(s, sf), "file_id IN ('src0', 'src1')")
    .select(*ROW_COLS),
    "drop_partition": lambda s, sf: tb.drop_partition(_seg(s, sf), "partition_en").select(*ROW_COLS),
    "compact": _compact,
})


# ------------------------------------------------------------------- BM25


def _bench_queries(spark, sf):
    return read_table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def bm25(**kw):
    def run(spark, sf):
        seg = _seg(spark, sf)
        index = build_bm25_index(seg)
        return bm25_search(index, _bench_queries(spark, sf), k=kw.get("k", 10), offset=kw.get("offset", 0),
                           pred=kw.get("pred"), partitions=kw.get("partitions"), corpus=seg,
                           drop_ratio=kw.get("drop_ratio", 0.0), columns=[])
    return run


def bm25_pruned(**kw):
    """The same hits by two passes: only documents that can still win are summed over common terms."""
    def run(spark, sf):
        seg = _seg(spark, sf)
        return bm25_pruned_search(build_bm25_index(seg), _bench_queries(spark, sf), corpus=seg, columns=[], **kw)
    return run


def _bm25_index_terms(spark, sf):
    return build_bm25_index(_seg(spark, sf)).terms


QUERIES.update({
    "bm25_index": _bm25_index_terms,
    "bm25_search": bm25(),
    "bm25_filtered": bm25(partitions=["partition_en", "partition_de"], pred="file_id <> 'src0'"),
    "bm25_offset": bm25(k=5, offset=5),
    "bm25_drop_ratio": bm25(drop_ratio=0.3),
    "bm25_pruned": bm25_pruned(),
    "bm25_pruned_filtered": bm25_pruned(partitions=["partition_en", "partition_de"], pred="file_id <> 'src0'"),
})


# ------------------------------------------------- embeddings and hybrid

MODEL = HashEmbedder()


def _embedded_corpus(spark, sf):
    return embed_documents(_seg(spark, sf), MODEL, tasks=spark.sparkContext.defaultParallelism)


def _embedded_queries(spark, sf):
    return embed_queries(_bench_queries(spark, sf), MODEL)


def _embed_documents_long(spark, sf):
    emb = _embedded_corpus(spark, sf)
    return (emb.where(F.col("embedding").isNotNull())
            .select("partition_name", "id", F.posexplode("embedding").alias("bucket", "value"))
            .where(F.col("value") != 0)
            .select("partition_name", "id", F.col("bucket").cast("long").alias("bucket"),
                    F.round(F.col("value").cast("double"), 6).alias("value")))


def hybrid(**kw):
    def run(spark, sf):
        corpus = _embedded_corpus(spark, sf)
        index = build_bm25_index(_seg(spark, sf))  # needs no vectors
        return hybrid_search(corpus, index, _embedded_queries(spark, sf), k=kw.get("k", 10),
                             offset=kw.get("offset", 0), weights=kw.get("weights", (0.5, 0.5)),
                             norm=kw.get("norm", "arctan"), pred=kw.get("pred"),
                             partitions=kw.get("partitions"), columns=[])
    return run


def _compare(spark, sf):
    corpus = _embedded_corpus(spark, sf)
    return compare_methods(corpus, build_bm25_index(_seg(spark, sf)), _embedded_queries(spark, sf), 10)


QUERIES.update({
    "embed_documents": _embed_documents_long,
    "text_vector_search": lambda s, sf: vector_search(_embedded_corpus(s, sf), _embedded_queries(s, sf), 10,
                                                      columns=[]),
    "hybrid_default": hybrid(),
    "hybrid_weighted": hybrid(weights=(0.7, 0.3)),
    "hybrid_weighted_text": hybrid(weights=(0.3, 0.7)),
    "hybrid_filtered": hybrid(partitions=["partition_en", "partition_fr"], pred="file_id <> 'src1'", offset=2),
    "hybrid_minmax": hybrid(norm="minmax"),
    "compare_methods": _compare,
})


# --------------------------------------------------------- approximate


def ivf(nlist: int, nprobe: int, kind: str = "flat", **kw):
    def run(spark, sf):
        index = build_ivf(testdata_vector_segments(spark, sf), nlist=nlist, kind=kind, m=kw.get("m", 8),
                          nbits=kw.get("nbits", 8))
        return ivf_search(index, _vector_queries(spark, sf), 10, nprobe=nprobe, rerank=kw.get("rerank", 0),
                          columns=[], threshold=kw.get("threshold", 0.0))
    return run


def pruned(nlist: int, metric: str):
    """Exact search that scans only the cells that may hold a winner."""
    def run(spark, sf):
        index = build_ivf(testdata_vector_segments(spark, sf), nlist=nlist, metric=metric)
        return exact_ivf_search(index, _vector_queries(spark, sf), 10, columns=[])
    return run


def _deep_page(spark, sf):
    """The 50 rows behind half of the table, from an index of its keys."""
    pages = tb.PageIndex.build(_seg(spark, sf))
    half = sum(n for _, _, n in pages.before) // 2
    return pages.page(half, 50, columns=["id", "file_id", "partition_name"])


def _two_level_full_probe(spark, sf):
    """A two-level index, every cell probed, is the exact search."""
    index = build_ivf(testdata_vector_segments(spark, sf), nlist=256, two_level=True)
    return ivf_search(index, _vector_queries(spark, sf), 10, nprobe=index.nlist, columns=[])


def recall(floor: float, exact_scores: bool, *args, **kw):
    """An approximate search judged against the exact one: per query the hits
    it returned and whether their scores are the exact ones, and whether the
    mean recall of all queries reaches ``floor``."""
    def run(spark, sf):
        corpus, queries = testdata_vector_segments(spark, sf), _vector_queries(spark, sf)
        found = materialize(ivf(*args, threshold=None, **kw)(spark, sf), "approximate")
        exact = vector_search(corpus, queries, 10, columns=[], threshold=None)
        mean = recall_at_k(found, exact).agg(F.avg("recall")).first()[0] or 0.0
        true = (found.join(corpus.select("partition_name", "id", "embedding"), ["partition_name", "id"])
                .join(queries, "query_id").withColumn("true", cosine("embedding", "vector")))
        same = F.abs(F.col("true") - F.col("score")) < 2e-6 if exact_scores else F.lit(True)
        return true.groupBy("query_id").agg(F.count("*").alias("n_hits"), F.every(same).alias("scores_ok")).select(
            "query_id", "n_hits", "scores_ok", F.lit(mean >= floor).alias("recall_ok"))
    return run


def recall_by_query(*args, **kw):
    """Each query's hits and its recall against the exact search; a query
    without any hit has a row as well."""
    def run(spark, sf):
        found = materialize(ivf(*args, threshold=None, **kw)(spark, sf), "approximate")
        exact = vector_search(testdata_vector_segments(spark, sf), _vector_queries(spark, sf), 10, columns=[],
                              threshold=None)
        hits = found.groupBy("query_id").agg(F.count("*").alias("n_hits"))
        return recall_at_k(found, exact).join(hits, "query_id", "left").select(
            "query_id", F.coalesce("n_hits", F.lit(0)).alias("n_hits"), "recall")
    return run


def _saved_ivf(spark, sf):
    """An IVF index written, read back and searched in full, with the default
    columns of the corpus."""
    import uuid
    root = f"{ensure_checkpoint_dir(spark)}/quarry-ivf-{uuid.uuid4().hex}"
    build_ivf(testdata_vector_segments(spark, sf), nlist=8).write(root)
    hits = ivf_search(IvfIndex.read(spark, root), _vector_queries(spark, sf), 10, nprobe=8)
    return hits.select("query_id", "rank", "partition_name", "id", "score", "distance", "file_id")


def _overlap(spark, sf):
    return overlap_at_k(_compare(spark, sf), "hybrid", "vector").withColumn("overlap", F.round("overlap", 6))


QUERIES.update({
    "ivf_full_probe": ivf(8, 8),
    "query_page_deep": _deep_page,
    "vector_pruned_cosine": pruned(32, "cosine"),
    "vector_pruned_l2": pruned(32, "l2"),
    "vector_pruned_ip": pruned(32, "ip"),
    "ivf_two_level_full_probe": _two_level_full_probe,
    "ivf_recall": recall(0.9, True, 16, 10),
    "sq8_search": ivf(1, 1, "sq8"),
    "ivf_sq8_full_probe": ivf(8, 8, "sq8"),
    "pq_recall": recall(0.5, False, 16, 16, "pq", m=8, nbits=8),
    "ivf_pq_rerank": recall(0.9, True, 16, 14, "pq", m=8, nbits=8, rerank=16),
    "ivf_recall_by_query": recall_by_query(16, 10),
    "pq_recall_by_query": recall_by_query(16, 16, "pq", m=8, nbits=8),
    "ivf_pq_rerank_by_query": recall_by_query(16, 14, "pq", m=8, nbits=8, rerank=16),
    "saved_ivf": _saved_ivf,
    "method_overlap": _overlap,
})


# ------------------------------------------------- JSON rows and schemas


def _json_rows(spark, sf):
    j = F.col("json")
    return to_json_rows(_seg(spark, sf)).select(
        F.get_json_object(j, "$.id").alias("id"), F.get_json_object(j, "$.file_id").alias("file_id"),
        F.get_json_object(j, "$.partition_name").alias("partition_name"),
        F.get_json_object(F.get_json_object(j, "$.metadata"), "$.lang").alias("lang"),
        F.json_array_length(F.get_json_object(j, "$.embedding")).cast("long").alias("n_dims"))


def _json_round_trip(spark, sf):
    seg = _seg(spark, sf)
    back = from_json_rows(to_json_rows(seg), seg.schema)
    emb = F.col("embedding")
    return back.select("id", "file_id", "partition_name", "content",
                       F.when(emb.isNotNull(), F.size(emb)).cast("long").alias("n_dims"),
                       F.round(F.aggregate(emb, F.lit(0.0), lambda a, x: a + x.cast("double")), 6).alias("v_sum"))


def _promote(spark, sf):
    seg = promote_metadata_field(promote_metadata_field(_seg(spark, sf), "lang"), "n_chars", "long")
    return seg.select("id", "lang", "n_chars")


def _promote_events(spark, sf):
    ev = read_table(spark, sf, "events")
    return promote_metadata_field(ev, "k", "long", source="props").select("event_id", "k")


def _set_metadata(spark, sf):
    lab = read_table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id"), "quality")
    seg = _seg(spark, sf).join(lab, "id", "left")
    m = set_metadata("metadata", "quality", F.col("quality"))
    return seg.select("id", m.alias("metadata")).select(
        "id", F.get_json_object("metadata", "$.lang").alias("lang"),
        F.get_json_object("metadata", "$.n_chars").cast("long").alias("n_chars"),
        F.get_json_object("metadata", "$.quality").cast("long").alias("quality"))


def _pack_dynamic(spark, sf):
    d = read_table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"),
                                                  F.col("text").alias("content"), F.col("source").alias("file_id"),
                                                  "lang", "n_chars")
    packed = pack_dynamic_fields(d, default_schema(64))
    dyn = F.col("dynamic_fields")
    return packed.select("id", F.get_json_object(dyn, "$.file_id").alias("file_id"),
                         F.get_json_object(dyn, "$.lang").alias("lang"),
                         F.get_json_object(dyn, "$.n_chars").cast("long").alias("n_chars"))


def _validate(spark, sf):
    batch = _seg(spark, sf).unionByName(_upsert_changes(spark, sf))
    _, bad = validate_batch(batch, segment_schema(64), allow_missing_vectors=False)
    return bad.select("partition_name", "id", F.explode("violations").alias("violation"))


QUERIES.update({
    "to_json_rows": _json_rows,
    "from_json_rows": _json_round_trip,
    "promote_metadata": _promote,
    "promote_event_props": _promote_events,
    "set_metadata": _set_metadata,
    "pack_dynamic": _pack_dynamic,
    "validate_batch": _validate,
})


# ------------------------------------------------------------- dispatch


def _dispatch(kind: str):
    def run(spark, sf):
        corpus = _embedded_corpus(spark, sf)
        req = SearchRequest(SearchType.parse(kind), 10, output_fields=("id",))
        out = search(corpus, _bench_queries(spark, sf), req, model=MODEL)
        return out.select("query_id", "rank", "partition_name", "id", "score", "distance")
    return run


QUERIES.update({
    "search_dispatch_vector": _dispatch(" Vector "),
    "search_dispatch_bm25": _dispatch("bm25"),
    "search_dispatch_hybrid": _dispatch("HYBRID"),
    "query_request": lambda s, sf: run_query(_seg(s, sf), QueryRequest(
        filter="file_id IN ('src1', 'src2')", offset=20, limit=100, output_fields=tuple(PAGE_COLS))),
})




def _typed_view(spark, sf):
    # A subclass view over the segment schema: file_id renamed to source_file,
    # a redeclared content field shadows the parent's.
    child = CollectionSpec("segment_view", (FieldSpec("file_id", "varchar", max_length=64, alias="source_file"),
                                            FieldSpec("content", "varchar", alias="text")))
    return typed_view(_seg(spark, sf), child, segment_schema(64))


def _auto_id(spark, sf):
    conv = read_table(spark, sf, "conversations")
    return with_auto_id(conv, ["conv_id", "turn"]).select("id", "conv_id", "turn")


QUERIES.update({
    "typed_view": _typed_view,
    "auto_id": _auto_id,
})


# ------------------------------------------------------------- streaming


def _stream_upsert(spark, sf):
    """Conversation turns arrive as a stream and are upserted, micro-batch by
    micro-batch, into a versioned copy of the segments table."""
    import uuid
    root = f"{ensure_checkpoint_dir(spark)}/quarry-stream-{uuid.uuid4().hex}"
    write_version(_seg(spark, sf), root)
    conv = read_table(spark, sf, "conversations")
    stream = (spark.readStream.schema(conv.schema).option("maxFilesPerTrigger", 1)
              .parquet(f"{sf.rstrip('/')}/conversations*.parquet"))
    changes = stream.select(
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string")).alias("id"),
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("file_id"),
        F.col("text").alias("content"), F.lit(None).cast("array<float>").alias("embedding"),
        F.to_json(F.struct("role")).alias("metadata"), partition_name("role").alias("partition_name"))
    q = upsert_stream(changes, root, f"{root}/_checkpoint")
    q.awaitTermination()
    return read_current(spark, root).select(*PAGE_COLS)


QUERIES["stream_upsert"] = _stream_upsert


def _hybrid_ivf(spark, sf):
    """Hybrid with the dense branch on an IVF index probed in full (equals
    exact hybrid by construction).  The embedded corpus feeds the index
    build, the IVF training and both branches, so it is written once."""
    corpus = materialize(_embedded_corpus(spark, sf), "embedded-corpus")
    return hybrid_search(corpus, build_bm25_index(corpus), _embedded_queries(spark, sf), 10, columns=[],
                         ivf_index=build_ivf(corpus, nlist=8), nprobe=8)


QUERIES["hybrid_ivf_full_probe"] = _hybrid_ivf


def _json_source(spark, sf):
    """Segments written as JSON files partitioned by partition name, then
    read back through the file source."""
    import uuid
    from ..sources.segments import read_segments
    path = f"{ensure_checkpoint_dir(spark)}/quarry-json-{uuid.uuid4().hex}"
    _seg(spark, sf).write.partitionBy("partition_name").json(path)
    back = read_segments(spark, path, "json")
    emb = F.col("embedding")
    return back.select("id", "file_id", "partition_name", "content",
                       F.when(emb.isNotNull(), F.size(emb)).cast("long").alias("n_dims"))


QUERIES["json_source"] = _json_source


def _stored_delete(spark, sf):
    """Delete by filter on a stored table; the current table is read back."""
    import uuid
    from ..sources.versions import delete_from_table
    root = f"{ensure_checkpoint_dir(spark)}/quarry-stored-{uuid.uuid4().hex}"
    write_version(_seg(spark, sf), root)
    delete_from_table(spark, root, pred="file_id IN ('src0', 'src1')")
    return read_current(spark, root).select(*ROW_COLS)


QUERIES["stored_delete"] = _stored_delete


def _seq_changes(spark, sf):
    """Every conversation turn as a change of its conversation's one row: the
    turn is the ``seq`` (NULL for turn 0), the partition is NULL, empty, 001
    or named, by conversation."""
    conv = read_table(spark, sf, "conversations")
    name = (F.when(F.col("conv_id") % 4 == 0, F.lit(None).cast("string")).when(F.col("conv_id") % 4 == 1, F.lit(""))
            .when(F.col("conv_id") % 4 == 2, F.lit("001")).otherwise(F.lit("partition_conv")))
    return conv.select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("id"),
                       F.col("role").alias("file_id"), F.col("text").alias("content"),
                       F.lit(None).cast("array<float>").alias("embedding"), F.lit("{}").alias("metadata"),
                       name.alias("partition_name"), F.when(F.col("turn") > 0, F.col("turn")).alias("seq"))


def _upsert_seq(spark, sf):
    return tb.upsert(_seg(spark, sf), _seq_changes(spark, sf)).select(*PAGE_COLS)


def _stored_upsert(spark, sf):
    """The same changes applied to a stored copy of the segments."""
    import uuid
    from ..sources.versions import upsert_table
    root = f"{ensure_checkpoint_dir(spark)}/quarry-upsert-{uuid.uuid4().hex}"
    write_version(_seg(spark, sf), root)
    upsert_table(spark, root, _seq_changes(spark, sf))
    return read_current(spark, root).select(*PAGE_COLS)


def _normalize_vectors(spark, sf):
    """FN-4 over every vector: its components summed and its length, rounded."""
    from ..functions.vectors import norm, normalize
    v = read_table(spark, sf, "embeddings").select("vec_id", normalize("embedding").alias("unit"))
    return v.select("vec_id", F.round(norm("unit"), 4).alias("length"),
                    F.round(F.element_at("unit", 1).cast("double"), 5).alias("first"),
                    F.size("unit").cast("long").alias("n_dims"))


QUERIES.update({"upsert_seq": _upsert_seq, "stored_upsert": _stored_upsert, "normalize_vectors": _normalize_vectors})


def _auto_index(spark, sf):
    """AUTOINDEX by name (served by IVF), probed in
    full: equals exact cosine search."""
    from .indexes import IndexSpec, build_index
    index = build_index(testdata_vector_segments(spark, sf), IndexSpec.auto(nlist=16))
    return ivf_search(index, _vector_queries(spark, sf), 10, nprobe=index.nlist, columns=[])


QUERIES["auto_index_full_probe"] = _auto_index


def _query_errors(spark, sf):
    """Every conversation turn as a BM25 query, the first turn blanked;
    turns that cannot run are reported with the reason, the rest would run."""
    from .search import query_errors
    conv = read_table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"),
        F.when(F.col("turn") > 0, F.col("text")).otherwise(F.lit("  ")).alias("text"))
    return query_errors(conv, SearchRequest.bm25())


QUERIES["query_errors"] = _query_errors


# ------------------------------------------- dynamic fields, late changes, errors


def _vector_dynamic(spark, sf):
    """Dense search filtered on, and returning, fields that the schema does not
    declare; they are stored in one VARIANT column."""
    docs, emb = read_table(spark, sf, "documents"), read_table(spark, sf, "embeddings").select("vec_id", "embedding")
    rows = emb.join(docs, docs.doc_id == emb.vec_id, "left").select(
        F.col("vec_id").cast("string").alias("id"), F.col("text").alias("content"), "embedding",
        F.coalesce(partition_name("lang"), partition_name(F.lit(""))).alias("partition_name"),
        F.col("source").alias("file_id"), "lang", "n_chars")
    corpus = materialize(pack_dynamic_fields(rows, default_schema(64), variant=True), "dynamic")
    corpus = with_dynamic_fields(corpus, {"file_id": "string", "lang": "string", "n_chars": "long"})
    return vector_search(corpus, _vector_queries(spark, sf), 10, columns=["file_id", "n_chars"],
                         pred="n_chars >= 300 AND lang <> 'de' AND file_id IN ('src1', 'src2', 'src3')")


def _stream_late(spark, sf):
    """Changes that arrive out of order: a first run of the stream brings the
    turns from 2 on, a second the earlier ones.  The table keeps ``seq``, so a
    late change replaces nothing that is newer than it."""
    import uuid
    root = f"{ensure_checkpoint_dir(spark)}/quarry-late-{uuid.uuid4().hex}"
    write_version(_seg(spark, sf).withColumn("seq", F.lit(None).cast("long")), f"{root}/table")
    changes = _seq_changes(spark, sf).withColumn("seq", F.col("seq").cast("long"))
    early = F.coalesce(F.col("seq") < 2, F.lit(True))
    for part in (changes.where(~early), changes.where(early)):
        part.write.mode("append").parquet(f"{root}/arrived")
        stream = spark.readStream.schema(changes.schema).parquet(f"{root}/arrived")
        upsert_stream(stream, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return read_current(spark, f"{root}/table").select(*PAGE_COLS)


def _embed_errors(spark, sf):
    """Every document's text embedded by a model that refuses batches with a
    text of over 200 tokens: the others have their vector, those a reason."""
    docs = _seg(spark, sf).withColumn("embedding", F.lit(None).cast("array<float>"))
    done = embed_documents(docs, HashEmbedder(max_tokens=200), errors_col="error",
                           tasks=spark.sparkContext.defaultParallelism)
    return done.select("partition_name", "id", F.when(F.col("embedding").isNotNull(), F.size("embedding"))
                       .cast("long").alias("n_dims"), "error")


def _validate_existing(spark, sf):
    """The change set checked against the stored rows: keys that exist already."""
    _, bad = validate_batch(_upsert_changes(spark, sf), segment_schema(64), existing=_seg(spark, sf))
    return bad.select("partition_name", "id", F.explode("violations").alias("violation"))


QUERIES.update({
    "vector_dynamic_filter": _vector_dynamic,
    "stream_upsert_late": _stream_late,
    "embed_errors": _embed_errors,
    "validate_existing": _validate_existing,
})
