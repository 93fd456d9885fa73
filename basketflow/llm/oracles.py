"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

HOST_RULES = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text FROM documents
),
words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM docs)
),
windows AS (
  SELECT doc_id, i, w, lead(w) OVER d AS w2, lead(w, 2) OVER d AS w3
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)
),
again AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, w3, count(*) OVER (PARTITION BY doc_id, w, w2, w3) AS times FROM windows
  ) WHERE times > 1 AND w3 IS NOT NULL
),
repeated AS (
  SELECT doc_id, count(DISTINCT i + o) AS n FROM again, (VALUES (0), (1), (2)) AS v(o) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
sizes AS (
  SELECT doc_id, count(*) AS n, sum(length(w)) AS chars FROM words GROUP BY doc_id
),
measured AS (
  SELECT d.doc_id, d.source, coalesce(s.n, 0) AS n_words, coalesce(s.chars, 0)::BIGINT AS word_chars,
    (length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(l.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM docs d LEFT JOIN sizes s USING (doc_id) LEFT JOIN lines l USING (doc_id) LEFT JOIN repeated r USING (doc_id)
),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
),
hosts AS (
  SELECT source, count(*) AS n_docs, sum(base_failed::INT) AS n_failed FROM judged
  WHERE source IS NOT NULL GROUP BY source
),
moments AS (
  SELECT sum(n_failed) / sum(n_docs) AS m, var_pop(n_failed / n_docs) AS v FROM hosts
),
prior AS (
  SELECT m, CASE WHEN v > 0 THEN greatest(m * (1 - m) / v - 1, 0.1) ELSE 100 END AS weight FROM moments
),
bad AS (
  SELECT source FROM hosts, prior WHERE (n_failed + m * weight) / (n_docs + weight) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(source IN (SELECT source FROM bad), false) AS kept
FROM judged
"""

_PATTERNS = [
    r"://([^/?#]*[.-])?(casino|free-bets|poker|cheap-pills|viagra|ads-track|xxx|porn)[.-]",
    r"://([^/?#]*\.)?ad\.doubleclick\.",
    r"/ads/[^?#]*\.(js|gif)([?#]|$)",
    r"[?&]click_?id=[^&#]+&([^#]*&)?aff(iliate)?_?id=",
]

URL_FILTERS = f"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
),
ruled AS (
  SELECT *, CASE
    WHEN ('.' || host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
    translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN {" OR ".join(f"regexp_matches(low, '{p}')" for p in _PATTERNS)} THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

#: DuckDB has SHA-1 in hex only: five hex digits are four base-32 ones.
ARCHIVES = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
),
digits AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((five >> (5 * (3 - j))) & 31)::INT, 1),
    '' ORDER BY i, j) AS b32
  FROM (SELECT DISTINCT hex, i, ('0x' || substr(hex, 1 + 5 * i, 5))::BIGINT AS five
        FROM payloads, range(8) AS r(i)), range(4) AS q(j)
  GROUP BY hex
),
firsts AS (SELECT hex, min(page_id) AS first_id FROM payloads GROUP BY hex)
SELECT page_id, strlen(html) AS payload_bytes, b32 AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM payloads JOIN digits USING (hex) JOIN firsts USING (hex)
"""

MINHASH_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words
),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
steps AS (SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT x AS doc_id, y AS other FROM steps
  UNION
  SELECT r.doc_id, s.y FROM reached r JOIN steps s ON r.other = s.x
),
least AS (SELECT doc_id, min(other) AS m FROM reached GROUP BY doc_id)
SELECT s.doc_id, len(s.s) AS n_shingles, least(s.doc_id, coalesce(l.m, s.doc_id)) AS component_id,
  least(s.doc_id, coalesce(l.m, s.doc_id)) = s.doc_id AS kept
FROM sets s LEFT JOIN least l USING (doc_id)
"""

PROJECTION_FOREST = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95
),
reached AS (
  SELECT x AS vec_id, y AS other FROM links
  UNION
  SELECT r.vec_id, l.y FROM reached r JOIN links l ON r.other = l.x
),
least AS (SELECT vec_id, min(other) AS m FROM reached GROUP BY vec_id),
degree AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, least(e.vec_id, coalesce(l.m, e.vec_id)) AS component_id,
  least(e.vec_id, coalesce(l.m, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN degree d USING (vec_id) LEFT JOIN least l USING (vec_id)
"""

STREAM_DEDUP = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM docs WINDOW same AS (PARTITION BY text)
"""

SQL = {
    "op4_host_rules": HOST_RULES,
    "op5_projection_forest": PROJECTION_FOREST,
    "op6_url_filters": URL_FILTERS,
    "op9_archives": ARCHIVES,
    "op10_minhash_join": MINHASH_JOIN,
    "op11_stream_dedup": STREAM_DEDUP,
}
