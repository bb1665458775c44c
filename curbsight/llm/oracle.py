"""The named queries of this subpackage as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from curbsight.llm.licences import NOT_WORD, RULES, SENTENCE_END, rule_rows


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


EXACT_COPIES = """
WITH folded AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM folded
WINDOW same AS (PARTITION BY text_sha256)
"""

CHAT_TEXTS = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), steps AS (
  SELECT conv_id, turn, md5(string_agg(role || chr(1) || text, chr(2) ORDER BY role, text)) AS step FROM turns GROUP BY conv_id, turn
), rolled AS (
  SELECT conv_id, turn, turn = max(turn) OVER (PARTITION BY conv_id) AS last,
         md5(string_agg(turn || ':' || step, '|') OVER (PARTITION BY conv_id ORDER BY turn)) AS prefix
  FROM steps
), kept AS (
  SELECT min(conv_id) AS conv_id, count(*) AS copies FROM rolled
  WHERE last AND prefix NOT IN (SELECT prefix FROM rolled WHERE NOT last)
  GROUP BY prefix
)
SELECT conv_id, turn // 64 AS part, count(*) AS n_turns,
       string_agg('<|im_start|>' || CASE role WHEN '' THEN 'unknown' ELSE lower(trim(role)) END || chr(10) || text || '<|im_end|>' || chr(10), ''
                  ORDER BY turn, role, text) AS text, any_value(copies) AS copies
FROM turns JOIN kept USING (conv_id)
GROUP BY conv_id, turn // 64
"""

NEAREST_VECTORS = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 20
"""

DAMAGED_RECORDS = """
WITH records AS (
  SELECT page_id, (page_id // 4096)::VARCHAR AS archive,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
         || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10)
         || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages
), placed AS (
  SELECT archive, record, octet_length(encode(record)) AS length,
         coalesce(sum(octet_length(encode(record))) OVER (PARTITION BY archive ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM records
), replicas AS (
  SELECT archive, place::BIGINT AS "offset", length::BIGINT AS length, sha256(record) AS hash, substr(sha256(record), 1, 2) AS chosen, record FROM placed
)
SELECT archive, "offset", CASE WHEN chosen < '04' THEN 'left only' ELSE 'changed' END AS status, length AS left_length,
       CASE WHEN chosen >= 'fc' THEN length + 1 END AS right_length, hash AS left_hash,
       CASE WHEN chosen >= 'fc' THEN sha256(record || '?') END AS right_hash
FROM replicas WHERE chosen < '04' OR chosen >= 'fc'
"""

LICENCES_FOUND = f"""
WITH rules(licence, place, size, raw) AS (VALUES {", ".join("(%s, %d, %d, %s)" % (quoted(n), p, z, quoted(s)) for n, p, z, s in rule_rows(RULES))}),
known AS (SELECT licence, place, size, trim(regexp_replace(lower(raw), '{NOT_WORD}', ' ', 'g')) AS sentence FROM rules),
split AS (
  SELECT doc_id, list_filter(list_transform(string_split_regex(coalesce(text, ''), '{SENTENCE_END}'),
         lambda s: trim(regexp_replace(lower(s), '{NOT_WORD}', ' ', 'g'))), lambda s: s <> '') AS found
  FROM documents
), sentences AS (
  SELECT doc_id, unnest(found) AS sentence, generate_subscripts(found, 1) - 1 AS n FROM split
), starts AS (
  SELECT doc_id, licence, n - place AS first, size, count(*) // size AS times
  FROM sentences JOIN known USING (sentence)
  GROUP BY doc_id, licence, n - place, size HAVING count(DISTINCT place) = size
), matches AS (SELECT doc_id, licence, first, first + size - 1 AS last, times FROM starts)
SELECT doc_id, licence, first::INTEGER AS first, last::INTEGER AS last, times FROM matches m
WHERE NOT EXISTS (
  SELECT 1 FROM matches o
  WHERE o.doc_id = m.doc_id AND o.first <= m.first AND o.last >= m.last AND o.last - o.first > m.last - m.first
)
"""



def _vector_codes(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    """Rounds written out one after the other; a distance and its entry make one number, so the least of them is the nearest, first entry."""
    steps = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor(4096 * c::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), cut AS MATERIALIZED (
  SELECT vec_id, label, p, x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] AS x FROM kept, range({parts}) AS t(p)
), book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM cut QUALIFY e < {entries}
)"""
    for k in range(rounds + 1):
        steps += f""", near{k} AS MATERIALIZED (
  SELECT vec_id, any_value(label) AS label, p, any_value(x) AS x,
         min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT * {entries} + e) AS best
  FROM cut JOIN book{k} USING (p) GROUP BY vec_id, p
)"""
        if k < rounds:
            steps += f""", sums{k} AS (
  SELECT p, best % {entries} AS e, i, sum(x[i]) AS s, count(*) AS n FROM near{k}, generate_series(1, len(x)) AS g(i) GROUP BY p, best % {entries}, i
), means{k} AS (
  SELECT p, e, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY i) AS c FROM sums{k} GROUP BY p, e
), book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN means{k} m USING (p, e)
)"""
    return steps + f""", coded AS MATERIALIZED (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', (best % {entries})::INTEGER), '' ORDER BY p) AS code, sum(best // {entries})::BIGINT AS error
  FROM near{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM coded
"""


VECTOR_CODES = _vector_codes()

ORACLES: dict[str, str] = {
    "op1_chat_formatting": CHAT_TEXTS,
    "op2_exact_top_k": NEAREST_VECTORS,
    "op3_warc_fixity": DAMAGED_RECORDS,
    "op4_licence_scan": LICENCES_FOUND,
    "op6_exact_dedup": EXACT_COPIES,
    "op12_vector_codes": VECTOR_CODES,
}
