"""DuckDB SQL for every named query that SQL can express.

Conventions shared with the Spark side: scores are rounded to 6 places
before ranking, ties go to the smaller id, counts are BIGINT.
"""

from __future__ import annotations

SEGMENTS = """segments AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id, d.source AS file_id, d.text AS content,
         e.embedding AS embedding, d.lang AS lang, d.n_chars AS n_chars,
         'partition_' || regexp_replace(d.lang, '[^a-zA-Z0-9]', '_', 'g') AS partition_name
  FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id)"""

# Every embedding, with its document's columns where it has one.
VSEGMENTS = """segments AS (
  SELECT CAST(e.vec_id AS VARCHAR) AS id, d.source AS file_id, e.embedding AS embedding,
         d.lang AS lang, d.n_chars AS n_chars,
         coalesce('partition_' || regexp_replace(d.lang, '[^a-zA-Z0-9]', '_', 'g'), '_default') AS partition_name
  FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id)"""

VQ = "vq AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def _vector(score_expr: str, dist_expr: str, where: str = "TRUE", k: int = 10, offset: int = 0,
            threshold: float = 0.0, extra: str = "") -> str:
    extra_sel = f", {extra}" if extra else ""
    return f"""WITH {VSEGMENTS}, {VQ},
c AS (SELECT partition_name, id, CAST(embedding AS DOUBLE[]) AS v{extra_sel} FROM segments
      WHERE embedding IS NOT NULL AND ({where})),
s AS (SELECT vq.query_id, c.partition_name, c.id, round({score_expr}, 6) AS score,
             round({dist_expr}, 6) AS distance{extra_sel.replace(', ', ', c.')} FROM vq, c),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id, partition_name) AS rank
      FROM s WHERE score IS NOT NULL)
SELECT query_id, CAST(rank AS BIGINT) AS rank, partition_name, id, score, distance{extra_sel}
FROM r WHERE rank > {offset} AND rank <= {offset + k} AND score >= {threshold}"""


COS = "list_cosine_similarity(vq.v, c.v)"
IP = "list_inner_product(vq.v, c.v)"
L2D = "list_distance(vq.v, c.v)"

ORACLE_SQL: dict[str, str] = {
    "vector_exact_cosine": _vector(COS, COS),
    "vector_exact_ip": _vector(IP, IP),
    "vector_exact_l2": _vector(f"1.0 / (1.0 + {L2D})", L2D),
    "vector_filtered": _vector(COS, COS, where="file_id IN ('src1', 'src2', 'src3')", extra="file_id"),
    "vector_partitions": _vector(COS, COS, where="partition_name IN ('partition_en', 'partition_fr')"),
    "vector_offset": _vector(COS, COS, k=5, offset=5),
    "vector_threshold": _vector(COS, COS, threshold=0.25),
}

SEG_ROWS = "SELECT id, file_id, partition_name FROM segments"
KIDS = """kids AS (SELECT DISTINCT knowledge_id FROM (
    SELECT concat_ws('-', lang, source) AS knowledge_id FROM documents
    UNION ALL SELECT concat_ws('_', lang, source) FROM documents))"""
CONV = """conv AS (SELECT 'conv_' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS id,
    'conv_' || CAST(conv_id AS VARCHAR) AS file_id, text AS content,
    'partition_' || regexp_replace(role, '[^a-zA-Z0-9]', '_', 'g') AS partition_name FROM conversations)"""
CHANGES = """changes AS (
    SELECT CAST(d.doc_id AS VARCHAR) AS id, d.source AS file_id, d.text || ' (rev)' AS content,
           'partition_' || regexp_replace(d.lang, '[^a-zA-Z0-9]', '_', 'g') AS partition_name
    FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)
    UNION ALL SELECT id, file_id, content, partition_name FROM conv)"""

ORACLE_SQL.update({
    "query_page": f"""WITH {SEGMENTS} SELECT id, file_id, partition_name, content FROM segments
        WHERE file_id IN ('src1', 'src2') ORDER BY id, partition_name LIMIT 100 OFFSET 20""",
    "query_columns": f"""WITH {SEGMENTS} SELECT id, file_id FROM segments
        WHERE partition_name = 'partition_de' ORDER BY id, partition_name LIMIT 100""",
    "get_by_ids": f"""WITH {SEGMENTS} {SEG_ROWS}
        WHERE id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 1)""",
    "get_by_ids_partition": f"""WITH {SEGMENTS} {SEG_ROWS}
        WHERE id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 1)
          AND partition_name = 'partition_en'""",
    "filter_eq": f"WITH {SEGMENTS} {SEG_ROWS} WHERE file_id = 'src3'",
    "filter_in": f"""WITH {SEGMENTS} {SEG_ROWS} WHERE file_id IN (
        SELECT source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))""",
    "count_all": f"WITH {SEGMENTS} SELECT CAST(count(*) AS BIGINT) AS count FROM segments",
    "count_partition": f"""WITH {SEGMENTS} SELECT CAST(count(*) AS BIGINT) AS count FROM segments
        WHERE partition_name = 'partition_en'""",
    "list_partitions": f"""WITH {SEGMENTS} SELECT partition_name, CAST(count(*) AS BIGINT) AS n_rows
        FROM segments GROUP BY partition_name""",
    "partition_name": f"""WITH {KIDS} SELECT knowledge_id,
        'partition_' || regexp_replace(knowledge_id, '[^a-zA-Z0-9]', '_', 'g') AS partition_name FROM kids""",
    "knowledge_id": f"""WITH {SEGMENTS} SELECT DISTINCT partition_name,
        CASE WHEN starts_with(partition_name, 'partition_') THEN substr(partition_name, 11)
             ELSE partition_name END AS knowledge_id FROM segments""",
    "partition_collisions": f"""WITH {KIDS}, p AS (SELECT knowledge_id,
        'partition_' || regexp_replace(knowledge_id, '[^a-zA-Z0-9]', '_', 'g') AS partition_name FROM kids)
        SELECT partition_name, knowledge_id, CAST(count(*) OVER (PARTITION BY partition_name) AS BIGINT) AS n_ids
        FROM p QUALIFY count(*) OVER (PARTITION BY partition_name) > 1""",
    "add": f"""WITH {SEGMENTS}, {CONV} SELECT id, file_id, partition_name, content FROM segments
        UNION ALL SELECT id, file_id, partition_name, content FROM conv""",
    "upsert": f"""WITH {SEGMENTS}, {CONV}, {CHANGES}
        SELECT id, file_id, partition_name, content FROM segments s
        WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE c.id = s.id AND c.partition_name = s.partition_name)
        UNION ALL SELECT id, file_id, partition_name, content FROM changes""",
    "delete_by_ids": f"""WITH {SEGMENTS} {SEG_ROWS}
        WHERE id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1)""",
    "delete_by_filter": f"WITH {SEGMENTS} {SEG_ROWS} WHERE NOT coalesce(file_id IN ('src0', 'src1'), FALSE)",
    "drop_partition": f"WITH {SEGMENTS} {SEG_ROWS} WHERE partition_name <> 'partition_en'",
    "compact": f"WITH {SEGMENTS} {SEG_ROWS}",
})

TOKENS = r"regexp_extract_all(lower(coalesce({0}, '')), '[\p{{L}}\p{{N}}]+')"
BM25_BASE = f"""docs AS (SELECT partition_name, id, {TOKENS.format('content')} AS toks FROM segments),
stats AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM docs),
post AS (SELECT term, partition_name, id, dl, count(*) AS tf FROM (
    SELECT partition_name, id, len(toks) AS dl, unnest(toks) AS term FROM docs) GROUP BY ALL),
terms AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM post GROUP BY term)"""


def _bm25_scored(queries: str, drop_ratio: float = 0.0, where: str = "TRUE") -> str:
    """CTEs up to ``scored(query_id, partition_name, id, score)``; ``queries``
    is a SELECT of (query_id, text)."""
    drop = (f"qd AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY query_id) AS n_terms, "
            f"row_number() OVER (PARTITION BY query_id ORDER BY weight, term) AS pos FROM qw) "
            f"WHERE pos > floor(n_terms * {drop_ratio}))") if drop_ratio else "qd AS (SELECT * FROM qw)"
    return f"""{BM25_BASE},
qt AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({TOKENS.format('text')}) AS term
    FROM ({queries}) WHERE text IS NOT NULL AND trim(text) <> '') GROUP BY ALL),
qw AS (SELECT qt.query_id, qt.term,
    ln(1.0 + ((SELECT n FROM stats) - terms.df + 0.5) / (terms.df + 0.5)) * qt.qtf AS weight
    FROM qt JOIN terms USING (term)),
{drop},
allowed AS (SELECT partition_name, id FROM segments WHERE {where}),
scored AS (SELECT qd.query_id, p.partition_name, p.id,
    sum(qd.weight * (p.tf * 2.2 / (p.tf + 1.2 * (1.0 - 0.75 + 0.75 * p.dl / (SELECT avgdl FROM stats))))) AS score
    FROM qd JOIN post p USING (term) JOIN allowed a ON a.id = p.id AND a.partition_name = p.partition_name
    GROUP BY ALL)"""


BENCH_Q = "SELECT item_id AS query_id, text FROM benchmark"


def _bm25(k: int = 10, offset: int = 0, drop_ratio: float = 0.0, where: str = "TRUE") -> str:
    return f"""WITH {SEGMENTS}, {_bm25_scored(BENCH_Q, drop_ratio, where)},
r AS (SELECT query_id, partition_name, id, round(score, 6) AS score,
      row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id, partition_name) AS rank
      FROM scored)
SELECT query_id, CAST(rank AS BIGINT) AS rank, partition_name, id, score, score AS distance
FROM r WHERE rank > {offset} AND rank <= {offset + k} AND score >= 0.0"""


ORACLE_SQL.update({
    "bm25_index": f"WITH {SEGMENTS}, {BM25_BASE} SELECT term, CAST(df AS BIGINT) AS df, CAST(cf AS BIGINT) AS cf FROM terms",
    "bm25_search": _bm25(),
    "bm25_filtered": _bm25(where="partition_name IN ('partition_en', 'partition_de') AND file_id <> 'src0'"),
    "bm25_offset": _bm25(k=5, offset=5),
    "bm25_drop_ratio": _bm25(drop_ratio=0.3),
})

HEX = "'0123456789abcdef'"


def _hash_vectors(name: str, source: str) -> str:
    """CTEs ``{name}_hn(key..., bucket, value)`` and ``{name}_hv(key..., v)``
    for the hash embedder over ``source`` = SELECT k1, k2, text."""
    return f"""{name}_tok AS (SELECT k1, k2, unnest({TOKENS.format('text')}) AS t FROM ({source})),
{name}_hb AS (SELECT k1, k2, md5(t) AS m FROM {name}_tok),
{name}_hs AS (SELECT k1, k2,
    ((instr({HEX}, substr(m, 1, 1)) - 1) * 16 + instr({HEX}, substr(m, 2, 1)) - 1) % 64 AS bucket,
    sum(CASE WHEN instr({HEX}, substr(m, 3, 1)) - 1 < 8 THEN 1.0 ELSE -1.0 END) AS v
    FROM {name}_hb GROUP BY ALL),
{name}_nn AS (SELECT *, sqrt(sum(v * v) OVER (PARTITION BY k1, k2)) AS nrm FROM {name}_hs),
{name}_hn AS (SELECT k1, k2, bucket, CAST(CAST(v / nrm AS FLOAT) AS DOUBLE) AS value FROM {name}_nn WHERE nrm > 0),
{name}_hv AS (SELECT g.k1, g.k2, list(coalesce(h.value, 0.0) ORDER BY g.bucket) AS v
    FROM (SELECT DISTINCT k1, k2, range AS bucket FROM {name}_hn, range(64)) g
    LEFT JOIN {name}_hn h USING (k1, k2, bucket) GROUP BY ALL)"""


EMB = f"""{_hash_vectors('d', "SELECT partition_name AS k1, id AS k2, content AS text FROM segments "
                              "WHERE embedding IS NULL AND content IS NOT NULL AND trim(content) <> ''")},
{_hash_vectors('q', "SELECT item_id AS k1, 0 AS k2, text FROM benchmark WHERE text IS NOT NULL AND trim(text) <> ''")},
cv AS (SELECT partition_name, id, CAST(embedding AS DOUBLE[]) AS v, file_id FROM segments WHERE embedding IS NOT NULL
       UNION ALL SELECT d_hv.k1, d_hv.k2, d_hv.v, s.file_id FROM d_hv
       JOIN segments s ON s.partition_name = d_hv.k1 AND s.id = d_hv.k2),
qv AS (SELECT k1 AS query_id, v FROM q_hv)"""


def _dense_ranked(where: str = "TRUE") -> str:
    return f"""SELECT query_id, partition_name, id, score, score AS distance,
      row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id, partition_name) AS rank FROM (
      SELECT qv.query_id, cv.partition_name, cv.id, round(list_cosine_similarity(qv.v, cv.v), 6) AS score
      FROM qv, cv WHERE {where}) WHERE score IS NOT NULL"""


def _bm25_ranked() -> str:
    return """SELECT query_id, partition_name, id, round(score, 6) AS score, round(score, 6) AS distance,
      row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id, partition_name) AS rank
      FROM scored"""


def _hybrid(wd: float = 0.5, ws: float = 0.5, k: int = 10, offset: int = 0, where: str = "TRUE",
            norm: str = "arctan") -> str:
    kk = k + offset
    if norm == "arctan":
        nd, ns = "(1.0 + score) / 2.0", "2.0 * atan(score) / pi()"
    else:
        mm = ("CASE WHEN max(score) OVER (PARTITION BY query_id) > min(score) OVER (PARTITION BY query_id) "
              "THEN (score - min(score) OVER (PARTITION BY query_id)) / (max(score) OVER (PARTITION BY query_id) "
              "- min(score) OVER (PARTITION BY query_id)) ELSE 1.0 END")
        nd = ns = mm
    seg_where = where.replace("file_id", "s.file_id").replace("partition_name", "s.partition_name")
    return f"""WITH {SEGMENTS}, {EMB}, {_bm25_scored(BENCH_Q.replace('FROM benchmark', "FROM benchmark WHERE text IS NOT NULL AND trim(text) <> ''"), 0.0, where)},
dense AS (SELECT * FROM ({_dense_ranked(where.replace('file_id', 'cv.file_id').replace('partition_name', 'cv.partition_name'))}) WHERE rank <= {kk}),
sparse AS (SELECT * FROM ({_bm25_ranked()}) WHERE rank <= {kk}),
fused AS (SELECT query_id, partition_name, id, sum(w) AS score FROM (
    SELECT query_id, partition_name, id, {wd} * ({nd}) AS w FROM dense
    UNION ALL SELECT query_id, partition_name, id, {ws} * ({ns}) AS w FROM sparse) GROUP BY ALL),
r AS (SELECT query_id, partition_name, id, round(score, 6) AS score,
      row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id, partition_name) AS rank FROM fused)
SELECT query_id, CAST(rank AS BIGINT) AS rank, partition_name, id, score, score AS distance
FROM r WHERE rank > {offset} AND rank <= {kk} AND score >= 0.0""".replace("{seg_where}", seg_where)


ORACLE_SQL.update({
    "embed_documents": f"""WITH {SEGMENTS}, {EMB}
        SELECT partition_name, id, CAST(ord - 1 AS BIGINT) AS bucket, round(CAST(value AS DOUBLE), 6) AS value
        FROM (SELECT partition_name, id, unnest(embedding) AS value,
                     generate_subscripts(embedding, 1) AS ord FROM segments WHERE embedding IS NOT NULL)
        WHERE value <> 0
        UNION ALL SELECT k1, k2, CAST(bucket AS BIGINT), round(value, 6) FROM d_hn WHERE value <> 0""",
    "text_vector_search": f"""WITH {SEGMENTS}, {EMB}
        SELECT query_id, CAST(rank AS BIGINT) AS rank, partition_name, id, score, distance
        FROM ({_dense_ranked()}) WHERE rank <= 10 AND score >= 0.0""",
    "hybrid_default": _hybrid(),
    "hybrid_weighted": _hybrid(0.7, 0.3),
    "hybrid_weighted_text": _hybrid(0.3, 0.7),
    "hybrid_filtered": _hybrid(offset=2, where="partition_name IN ('partition_en', 'partition_fr') AND file_id <> 'src1'"),
    "hybrid_minmax": _hybrid(norm="minmax"),
})


def _compare() -> str:
    body, _ = _hybrid().split("SELECT query_id, CAST(rank AS BIGINT) AS rank, partition_name, id, score, score AS distance\nFROM r")
    cols = "query_id, CAST(rank AS BIGINT) AS rank, partition_name, id, score"
    return (body + f"SELECT 'vector' AS method, {cols} FROM dense WHERE rank <= 10 AND score >= 0.0\n"
            f"UNION ALL SELECT 'bm25' AS method, {cols} FROM sparse WHERE rank <= 10 AND score >= 0.0\n"
            f"UNION ALL SELECT 'hybrid' AS method, {cols} FROM r WHERE rank <= 10 AND score >= 0.0")


ORACLE_SQL["compare_methods"] = _compare()

SQ8 = """sq_raw AS (SELECT partition_name, id, CAST(unnest(embedding) AS DOUBLE) AS x,
                   generate_subscripts(embedding, 1) AS i FROM segments WHERE embedding IS NOT NULL),
sq_dims AS (SELECT i, min(x) AS lo, max(x) AS hi FROM sq_raw GROUP BY i),
sq_enc AS (SELECT r.partition_name, r.id, r.i, d.lo, d.hi,
    CASE WHEN d.hi - d.lo > 0 THEN greatest(least(round((r.x - d.lo) / (d.hi - d.lo) * 255.0), 255.0), 0.0)
         ELSE 0.0 END AS code FROM sq_raw r JOIN sq_dims d USING (i)),
c AS (SELECT partition_name, id, list(lo + code / 255.0 * (hi - lo) ORDER BY i) AS v FROM sq_enc GROUP BY ALL)"""


def _sq8() -> str:
    return f"""WITH {VSEGMENTS}, {VQ}, {SQ8},
s AS (SELECT vq.query_id, c.partition_name, c.id, round({COS}, 6) AS score FROM vq, c),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id, partition_name) AS rank
      FROM s WHERE score IS NOT NULL)
SELECT query_id, CAST(rank AS BIGINT) AS rank, partition_name, id, score, score AS distance
FROM r WHERE rank <= 10 AND score >= 0.0"""


ORACLE_SQL.update({
    "ivf_full_probe": ORACLE_SQL["vector_exact_cosine"],
    "sq8_search": _sq8(),
    "ivf_sq8_full_probe": _sq8(),
})

ORACLE_SQL.update({
    "to_json_rows": f"""WITH {SEGMENTS} SELECT id, file_id, partition_name, lang,
        CAST(len(embedding) AS BIGINT) AS n_dims FROM segments""",
    "from_json_rows": f"""WITH {SEGMENTS} SELECT id, file_id, partition_name, content,
        CAST(len(embedding) AS BIGINT) AS n_dims, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS v_sum
        FROM segments""",
    "promote_metadata": f"WITH {SEGMENTS} SELECT id, lang, n_chars FROM segments",
    "promote_event_props": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "set_metadata": f"""WITH {SEGMENTS} SELECT s.id, s.lang, s.n_chars, CAST(l.quality AS BIGINT) AS quality
        FROM segments s LEFT JOIN labels l ON s.id = CAST(l.doc_id AS VARCHAR)""",
    "pack_dynamic": """SELECT CAST(doc_id AS VARCHAR) AS id, source AS file_id, lang, n_chars FROM documents""",
    "validate_batch": f"""WITH {SEGMENTS}, {CONV}, {CHANGES},
        batch AS (SELECT partition_name, id, file_id, content, embedding FROM segments
                  UNION ALL SELECT partition_name, id, file_id, content, NULL FROM changes),
        dup AS (SELECT partition_name, id FROM batch GROUP BY ALL HAVING count(*) > 1)
        SELECT partition_name, id, 'id: longer than 64 bytes' AS violation FROM batch WHERE strlen(id) > 64
        UNION ALL SELECT partition_name, id, 'file_id: longer than 64 bytes' FROM batch WHERE strlen(file_id) > 64
        UNION ALL SELECT partition_name, id, 'content: longer than 65535 bytes' FROM batch WHERE strlen(content) > 65535
        UNION ALL SELECT partition_name, id, 'embedding: missing vector' FROM batch
            WHERE embedding IS NULL OR len(embedding) = 0
        UNION ALL SELECT partition_name, id, 'embedding: dimension is not 64' FROM batch
            WHERE len(embedding) > 0 AND len(embedding) <> 64
        UNION ALL SELECT b.partition_name, b.id, 'id: duplicate key' FROM batch b JOIN dup USING (partition_name, id)""",
})

ORACLE_SQL.update({
    "search_dispatch_vector": ORACLE_SQL["text_vector_search"],
    "search_dispatch_bm25": ORACLE_SQL["bm25_search"],
    "search_dispatch_hybrid": ORACLE_SQL["hybrid_default"],
    "query_request": ORACLE_SQL["query_page"],
})

ORACLE_SQL.update({
    "typed_view": f"""WITH {SEGMENTS} SELECT file_id AS source_file, content AS text, id,
        '{{"lang":"' || lang || '","n_chars":' || CAST(n_chars AS VARCHAR) || '}}' AS metadata FROM segments""",
})

ORACLE_SQL["stream_upsert"] = ORACLE_SQL["add"]

ORACLE_SQL["auto_id"] = """SELECT substr(md5(concat_ws('|', coalesce(CAST(conv_id AS VARCHAR), ''),
    coalesce(CAST(turn AS VARCHAR), ''))), 1, 16) AS id, conv_id, turn FROM conversations"""

ORACLE_SQL["hybrid_ivf_full_probe"] = ORACLE_SQL["hybrid_default"]

ORACLE_SQL["json_source"] = f"""WITH {SEGMENTS} SELECT id, file_id, partition_name, content,
    CAST(len(embedding) AS BIGINT) AS n_dims FROM segments"""

ORACLE_SQL["stored_delete"] = ORACLE_SQL["delete_by_filter"]

ORACLE_SQL["auto_index_full_probe"] = ORACLE_SQL["vector_exact_cosine"]

ORACLE_SQL["query_errors"] = """SELECT conv_id * 1000 + turn AS query_id, 'text is empty' AS error
    FROM conversations WHERE text IS NULL OR trim(text) = '' OR turn = 0"""

ORACLE_SQL["upsert_seq"] = ORACLE_SQL["stored_upsert"] = f"""WITH {SEGMENTS},
ch AS (SELECT 'c' || conv_id AS id, role AS file_id, text AS content,
         CASE conv_id % 4 WHEN 2 THEN '001' WHEN 3 THEN 'partition_conv' ELSE '_default' END AS partition_name,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS newest FROM conversations)
SELECT id, file_id, partition_name, content FROM segments
UNION ALL SELECT id, file_id, partition_name, content FROM ch WHERE newest = 1"""

ORACLE_SQL["normalize_vectors"] = """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
n AS (SELECT vec_id, x, sqrt(list_inner_product(x, x)) AS l FROM v)
SELECT vec_id, round(CASE WHEN l > 0 THEN 1.0 ELSE 0.0 END, 4) AS length,
       round(CAST(CAST(CASE WHEN l > 0 THEN x[1] / l ELSE x[1] END AS FLOAT) AS DOUBLE), 5) AS "first",
       CAST(len(x) AS BIGINT) AS n_dims FROM n"""

ORACLE_SQL["vector_pruned_cosine"] = ORACLE_SQL["ivf_two_level_full_probe"] = ORACLE_SQL["vector_exact_cosine"]
ORACLE_SQL["vector_pruned_l2"], ORACLE_SQL["vector_pruned_ip"] = (ORACLE_SQL["vector_exact_l2"],
                                                                  ORACLE_SQL["vector_exact_ip"])

ORACLE_SQL["query_page_deep"] = f"""WITH {SEGMENTS}, n AS (SELECT id, file_id, partition_name,
    row_number() OVER (ORDER BY id, partition_name) AS place, count(*) OVER () AS total FROM segments)
SELECT id, file_id, partition_name FROM n WHERE place > total // 2 AND place <= total // 2 + 50"""

RECALL = """SELECT vec_id AS query_id, CAST(10 AS BIGINT) AS n_hits, TRUE AS scores_ok, TRUE AS recall_ok
FROM embeddings WHERE list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0"""
ORACLE_SQL["ivf_recall"] = ORACLE_SQL["pq_recall"] = ORACLE_SQL["ivf_pq_rerank"] = RECALL
ORACLE_SQL["saved_ivf"] = _vector(COS, COS, extra="file_id")
ORACLE_SQL["method_overlap"] = f"""WITH cmp AS ({ORACLE_SQL["compare_methods"]}),
h AS (SELECT query_id, partition_name, id FROM cmp WHERE method = 'hybrid'),
v AS (SELECT query_id, partition_name, id FROM cmp WHERE method = 'vector')
SELECT v.query_id, round(count(h.id) / count(*), 6) AS overlap
FROM v LEFT JOIN h ON v.query_id = h.query_id AND v.partition_name = h.partition_name AND v.id = h.id
GROUP BY v.query_id"""

ORACLE_SQL["vector_dynamic_filter"] = _vector(
    COS, COS, where="n_chars >= 300 AND lang <> 'de' AND file_id IN ('src1', 'src2', 'src3')", extra="file_id, n_chars")

ORACLE_SQL["stream_upsert_late"] = ORACLE_SQL["upsert_seq"]

ORACLE_SQL["embed_errors"] = f"""WITH {SEGMENTS},
t AS (SELECT partition_name, id, len({TOKENS.format('content')}) AS n FROM segments)
SELECT partition_name, id, CAST(CASE WHEN n BETWEEN 1 AND 200 THEN 64 END AS BIGINT) AS n_dims,
       CASE WHEN n > 200 THEN 'ValueError: more than 200 tokens' END AS error FROM t"""

ORACLE_SQL["validate_existing"] = f"""WITH {SEGMENTS}, {CONV}, {CHANGES},
    dup AS (SELECT partition_name, id FROM changes GROUP BY ALL HAVING count(*) > 1)
    SELECT partition_name, id, 'id: longer than 64 bytes' AS violation FROM changes WHERE strlen(id) > 64
    UNION ALL SELECT partition_name, id, 'file_id: longer than 64 bytes' FROM changes WHERE strlen(file_id) > 64
    UNION ALL SELECT partition_name, id, 'content: longer than 65535 bytes' FROM changes WHERE strlen(content) > 65535
    UNION ALL SELECT c.partition_name, c.id, 'id: duplicate key' FROM changes c JOIN dup USING (partition_name, id)
    UNION ALL SELECT c.partition_name, c.id, 'id: key exists' FROM changes c
        WHERE EXISTS (SELECT 1 FROM segments s WHERE s.partition_name = c.partition_name AND s.id = c.id)"""

ORACLE_SQL["bm25_pruned"] = ORACLE_SQL["bm25_search"]
ORACLE_SQL["bm25_pruned_filtered"] = ORACLE_SQL["bm25_filtered"]
