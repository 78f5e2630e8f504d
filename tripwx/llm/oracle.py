"""DuckDB twins of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

# a turn comes back changed if it holds the end mark or what reads as an escape
_NEEDED = r"(contains({0}, '</s>') OR regexp_matches({0}, '[\[<]\\+(INST\]|/INST\]|/s>)'))"
_ESC = r"regexp_replace({0}, '([\[<])(\\*)(INST\]|/INST\]|/s>)', '\1\\\2\3', 'g')"

ORACLE["op2_chat_format"] = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, {_NEEDED.format('role')} OR {_NEEDED.format('text')} OR contains(role, '[/INST]') AS needed FROM t),
e AS (SELECT *, CASE WHEN needed THEN {_ESC.format('role')} ELSE role END AS er,
             CASE WHEN needed THEN {_ESC.format('text')} ELSE text END AS et FROM n)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('[INST]') + length(er) + length('[/INST]') + length(et) + length('</s>'))::BIGINT AS formatted_chars,
  true AS same
FROM e GROUP BY conv_id
"""

ORACLE["op12_source_audit"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents),
w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d),
k AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(ln) AS total FROM k GROUP BY ALL),
g AS (
  SELECT s.lang, s.source, coalesce(any_value(l.v), 0) AS v, coalesce(sum(c.n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN l USING (lang) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + g.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (k.ln + 1)) // (l.total + l.v)::HUGEINT AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
t AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM f
  UNION ALL SELECT lang, source, 'term', item, value FROM t)
SELECT lang, source, part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) ::INTEGER AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 200
"""

ORACLE["op13_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM n),
h AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3),
m AS (SELECT k.*, h.key IS NOT NULL AND k.doc_id IS DISTINCT FROM h.holder AS gone FROM k LEFT JOIN h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""
