"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

MIX = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w,
         3 * source_size AS cap FROM s
), r AS (
  SELECT *, cap::DOUBLE / w AS ratio,
    ((sum(source_size) OVER ())::BIGINT - coalesce(sum(cap) OVER before, 0)::BIGINT)::DOUBLE
      / ((sum(w) OVER ())::BIGINT - coalesce(sum(w) OVER before, 0)::BIGINT) AS level,
    row_number() OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST) AS k
  FROM w
  WINDOW before AS (ORDER BY cap::DOUBLE / w, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT min(k) AS k, arg_min(level, k) AS level FROM r WHERE level <= ratio
), t AS (
  SELECT r.source, source_size,
         CASE WHEN r.k >= f.k THEN f.level * w ELSE cap::DOUBLE END AS target FROM r, f
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes
  FROM t
), q AS (
  SELECT *, floor(target)::BIGINT - passes * source_size AS rest FROM p
), g AS (
  SELECT source, h, sum(size)::BIGINT AS n FROM d GROUP BY source, h
), c AS (
  SELECT *, (sum(n) OVER (PARTITION BY source ORDER BY h))::BIGINT AS upto FROM g
)
SELECT d.doc_id, d.size, q.source_size, q.target,
       d.size * (q.passes + CASE WHEN c.upto <= q.rest THEN 1
                                 WHEN c.upto - c.n < q.rest AND c.upto - q.rest < q.rest - c.upto + c.n
                                 THEN 1 ELSE 0 END) AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h
"""

LINES = f"""
WITH l AS (
  SELECT doc_id, pos, line, translate(trim(line, {SPACES}), {UPPER}) AS key
  FROM (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))
), hot AS (
  SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (hot.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (hot.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN hot ON l.key = hot.key GROUP BY doc_id
"""

SUBSTRINGS = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents
), w AS (
  SELECT doc_id, i, md5(substr(hx, 2 * i + 1, 200)) AS k
  FROM (SELECT doc_id, hx, unnest(range(0, length(hx) // 2 - 99)) AS i FROM d)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM w)
  WHERE n > 1
), e AS (
  SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i - before > 100 THEN 1 ELSE 0 END)
           OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM r)
), s AS (
  SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM e GROUP BY doc_id, run
), c AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS upto FROM s
), p AS (
  SELECT d.doc_id, string_agg(substr(hx, 2 * upto + 1, 2 * (a - upto)), '' ORDER BY a) AS head,
         max(b) AS upto, sum(b - a) AS gone, count(*) AS n
  FROM d JOIN c ON d.doc_id = c.doc_id GROUP BY d.doc_id
)
SELECT d.doc_id, length(hx) // 2 AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed,
       coalesce(n, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(hx, 2 * coalesce(upto, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN p ON d.doc_id = p.doc_id
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top <> page_id THEN top END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND payload_bytes >= 1000
"""


def quality_rules(boilerplate: tuple[str, ...]) -> str:
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), x AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)
), y AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM x) WHERE n > 1
), z AS (
  SELECT doc_id, sum(least(8, i - coalesce(before, i - 8)))::BIGINT AS n FROM y GROUP BY doc_id
), l AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d
), m AS (
  SELECT doc_id, line, regexp_matches(line, '{WORD}') AS worded,
         length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
         len(regexp_extract_all(line, '{WORD}')) AS n FROM l
), v AS (
  SELECT *, NOT worded OR (regexp_matches(line, '[.!?…。！？]')
         AND len(regexp_extract_all(line, '[|»›•·>]')) * 4 < n
         AND len(regexp_extract_all(line, '[#*$%&|<>!]')) * 2 < n
         AND NOT regexp_matches(lower(line), '{"|".join(boilerplate)}')) AS good
  FROM m
), a AS (
  SELECT doc_id, sum(chars)::BIGINT AS word_chars, count(*) FILTER (NOT good) AS n_lines_removed,
         coalesce(sum(chars) FILTER (NOT good), 0)::BIGINT AS lost_chars,
         count(*) FILTER (worded) - count(DISTINCT line) FILTER (worded) AS n_dup_lines
  FROM v GROUP BY doc_id
), b AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, n_dup_lines,
         coalesce(z.n, 0) AS n_repeat_words, n_lines_removed, lost_chars
  FROM d JOIN a ON d.doc_id = a.doc_id LEFT JOIN z ON d.doc_id = z.doc_id
), c AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b
)
SELECT *, NOT base_failed AND NOT (100 * lost_chars > 50 * word_chars) AS kept FROM c
"""

DIVERGENCE = rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), o AS (
  SELECT lang, source, row, translate(unnest(words), {UPPER}) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= 10
), l AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY ALL
), t AS (
  SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * l.v))::BIGINT AS p,
    (1 + 1000000000::HUGEINT * (k.n + 2) // (l.total + 2 * l.v))::BIGINT AS q
  FROM g JOIN kept k USING (lang) JOIN l USING (lang) LEFT JOIN t USING (lang, source)
  LEFT JOIN c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), part AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
  FROM part)
WHERE part = 'pair' OR rank <= 10
"""
