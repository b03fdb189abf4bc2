"""DuckDB statements of the training-data operators that SQL can express."""

from __future__ import annotations


def _crc_table() -> list[int]:
    """The 256 steps of the reflected CRC-32 (polynomial EDB88320)."""
    steps = []
    for byte in range(256):
        for _ in range(8):
            byte = (byte >> 1) ^ (0xEDB88320 if byte & 1 else 0)
        steps.append(byte)
    return steps


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH RECURSIVE
poly AS MATERIALIZED (SELECT {_crc_table()}::BIGINT[] AS t),
runs AS (
  SELECT id, run, count(*) AS k FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all({LOWER.format('text')}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents)
  WHERE length(run) >= 6 GROUP BY id, run),
hexed AS (SELECT run, k, hex(encode(id || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, k, xor(list_reduce(list_transform(range(1, length(x) // 2 + 1), lambda i: ('0x' || substr(x, 2 * i - 1, 2))::BIGINT),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM hexed, poly),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
cut AS (
  SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hole, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
half AS (
  SELECT a.word AS one, a.n AS n1, b.word AS two, b.n AS n2 FROM cut a JOIN cut b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word),
pairs AS (SELECT one, n1, two, n2 FROM half UNION SELECT two, n2, one, n1 FROM half),
best AS (SELECT one, count(*) AS n_near, max(n2) AS m FROM pairs GROUP BY one),
first AS (SELECT p.one, min(p.two) AS two FROM pairs p JOIN best b ON p.one = b.one AND p.n2 = b.m GROUP BY p.one),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 5 * w.n THEN b.m END AS form_n, CASE WHEN b.m >= 5 * w.n THEN f.two END AS form
  FROM words w LEFT JOIN best b ON w.word = b.one LEFT JOIN first f ON w.word = f.one),
walk AS (
  SELECT word, form AS step FROM formed WHERE form IS NOT NULL
  UNION SELECT k.word, f.form FROM walk k JOIN formed f ON k.step = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT k.word, k.step AS root FROM walk k JOIN formed f ON k.step = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n FROM formed f LEFT JOIN ends e ON f.word = e.word
"""

OP12 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, id, i, parts[i] AS line, {LOWER.format("trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
  FROM (SELECT r, id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT r, id, string_split(text, chr(10)) AS parts FROM docs))),
owners AS (SELECT key, min(id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT l.r, l.i, l.line, coalesce(o.owner <> l.id, false) AS gone FROM lines l LEFT JOIN owners o ON l.key = o.key AND length(l.key) >= 10),
kept AS (
  SELECT r, count(*) AS n_lines, sum(CASE WHEN gone THEN 1 ELSE 0 END)::BIGINT AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text
  FROM marked GROUP BY r)
SELECT d.doc_id, k.n_lines, k.n_dropped, sha256(k.text) AS kept_sha256 FROM docs d JOIN kept k ON d.r = k.r
"""

OP13 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
terms AS (SELECT r, lang, source, unnest(regexp_extract_all({LOWER.format('text')}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM terms JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source),
groups AS (
  SELECT g.lang, g.source, coalesce(t.n, 0)::HUGEINT AS n, coalesce(s.v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN totals t USING (lang, source) LEFT JOIN sizes s USING (lang)),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, (1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (g.n + g.v))::BIGINT AS p
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
whole AS (
  SELECT lang, term, (1 + (1000000000::HUGEINT * (c + 1)) // (n + v))::BIGINT AS q
  FROM (SELECT lang, term, sum(c)::HUGEINT AS c FROM counts GROUP BY lang, term) JOIN (SELECT lang, sum(n) AS n, max(v) AS v FROM groups GROUP BY lang) USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p)::BIGINT AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source) d
  ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
term AS (
  SELECT s.lang, s.source, s.term AS item, (s.p - w.q) * (s.p - w.q) // w.q AS value
  FROM shares s JOIN whole w ON s.lang = w.lang AND s.term = w.term WHERE s.c > 0 AND s.p > w.q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM term)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLE: dict[str, str] = {"op11_gram_variants": OP11, "op12_mph_lines": OP12, "op13_chunk_divergence": OP13}
