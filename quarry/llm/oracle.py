"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from .quality import BOILERPLATE, SENTENCE_RE, SEPARATOR_RE

WORD = r"[^\x20\x09-\x0D]+"


def _quality() -> str:
    phrases = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)
    sentence = SENTENCE_RE.replace("'", "''")
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
b AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws,
             [x for x in string_split(t, chr(10)) if regexp_matches(x, '{WORD}')] AS wl FROM d),
g AS (SELECT rid, unnest(range(1, len(ws) - 3)) AS i, ws FROM b WHERE len(ws) >= 5),
gg AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, array_to_string(ws[i:i + 4], ' ')) AS c FROM g),
r AS (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS p FROM gg WHERE c > 1),
rep AS (SELECT rid, sum(least(5, i - coalesce(p, i - 5))) AS n FROM r GROUP BY rid),
l AS (SELECT rid, unnest(wl) AS line FROM b),
lc AS (SELECT rid, len(regexp_extract_all(line, '{WORD}')) AS n, CASE
    WHEN {phrases} THEN 'boilerplate'
    WHEN len(regexp_extract_all(line, '{SEPARATOR_RE}')) >= 2
     AND 4 * len(regexp_extract_all(line, '{SEPARATOR_RE}')) >= len(regexp_extract_all(line, '{WORD}'))
    THEN 'navigation'
    WHEN NOT regexp_matches(line, '{sentence}') THEN 'punctuation' END AS rule FROM l),
ls AS (SELECT rid, sum(n) AS lost, count(*) FILTER (rule = 'boilerplate') AS nb,
              count(*) FILTER (rule = 'navigation') AS nn, count(*) FILTER (rule = 'punctuation') AS np
       FROM lc WHERE rule IS NOT NULL GROUP BY rid),
c AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(wl) - len(list_distinct(wl)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    len(ws) < 10 OR 100 * coalesce(rep.n, 0) > 20 * len(ws) AS base_failed,
    CAST(coalesce(lost, 0) AS BIGINT) AS lost_words, CAST(coalesce(nb, 0) AS BIGINT) AS n_boilerplate,
    CAST(coalesce(nn, 0) AS BIGINT) AS n_navigation, CAST(coalesce(np, 0) AS BIGINT) AS n_punctuation
  FROM b LEFT JOIN rep USING (rid) LEFT JOIN ls USING (rid))
SELECT *, NOT base_failed AND lost_words <= n_words * 0.5 AS kept FROM c"""


WARC = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
k AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keeper FROM k),
r AS (SELECT *, payload_bytes >= 1000 AND page_id <> keeper AS again FROM m)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN keeper END AS refers_to FROM r"""

LINE_DEDUP = r"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents),
u AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM u),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY rid, doc_id"""

NEAR_DEDUP = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, least(len(ws), 1)) + 1)) AS i FROM w),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g FROM i),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
b AS (SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS both_ FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id
      GROUP BY ALL),
l AS (SELECT u, v FROM b JOIN c cu ON cu.doc_id = u JOIN c cv ON cv.doc_id = v
      WHERE 100 * both_ >= 85 * (cu.n + cv.n - both_)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r AS (SELECT u AS d, v AS x FROM e UNION SELECT r.d, e.v FROM r JOIN e ON r.x = e.u),
m AS (SELECT d, min(x) AS x FROM r GROUP BY d),
f AS (SELECT w.doc_id, coalesce(c.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.x, w.doc_id)) AS component_id
      FROM w LEFT JOIN c ON c.doc_id = w.doc_id LEFT JOIN m ON m.d = w.doc_id)
SELECT *, doc_id = component_id AS kept FROM f"""

SUBSTRING_DEDUP = r"""WITH w AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20),
k AS (SELECT rid, i, array_to_string(ws[i:i + 19], ' ') AS key, doc_id::HUGEINT * 4294967296 + i AS place FROM s),
f AS (SELECT key, min(place) AS first FROM k GROUP BY key),
d AS (SELECT DISTINCT rid, unnest(range(i, i + 20)) AS pos FROM k JOIN f ON k.key = f.key WHERE place > first),
u AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
r AS (SELECT u.rid, count(*) FILTER (d.pos IS NOT NULL) AS n_removed,
             string_agg(word, ' ' ORDER BY u.pos) FILTER (d.pos IS NULL) AS kept
      FROM u LEFT JOIN d ON u.rid = d.rid AND u.pos = d.pos GROUP BY u.rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN r ON w.rid = r.rid"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": _quality(),
    "op4_warc": WARC,
    "op5_minmax_near_dedup": NEAR_DEDUP,
    "op10_line_dedup": LINE_DEDUP,
    "op13_substring_dedup": SUBSTRING_DEDUP,
}
