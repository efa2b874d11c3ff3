"""DuckDB SQL of the text queries that SQL can express."""

from __future__ import annotations

from tissueloom.llm.quality import STOP_WORDS

#: The rules of the url query: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES_SQL = f"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (SELECT *, {LOWERED.format(f"trim(line, {WS})")} AS key FROM split),
owned AS (SELECT *, min(doc_id) OVER (PARTITION BY key) AS owner FROM keyed),
marked AS (SELECT *, length(key) >= 10 AND owner <> doc_id AS gone FROM owned)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

_STOP = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words}))

QUALITY_SQL = f"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT doc_id, t, list_filter(string_split_regex(t, '[ \\t\\n\\x0b\\f\\r]+'), lambda w: w <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: trim(x, {WS}) <> '') AS l FROM base),
wins AS (
  SELECT doc_id, i, w[i:i + 4] AS g FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM wins) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS p FROM again) GROUP BY doc_id),
m AS (
  SELECT s.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(l) AS n_lines, len(list_filter(w, lambda x: list_contains([{_STOP}], lower(x)))) AS stops,
    len(list_filter(l, lambda x: regexp_matches(x, '^[ \\t\\n\\x0b\\f\\r]*[-*•]'))) AS bullets,
    len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[ \\t\\n\\x0b\\f\\r]*$'))) AS cut
  FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id),
r AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    list_filter([
      CASE WHEN n_words > 0 AND (word_chars / n_words < 1.5 OR word_chars / n_words > 20) THEN 'word_length' END,
      CASE WHEN n_words > 0 AND n_symbols / n_words > 0.3 THEN 'symbols' END,
      CASE WHEN n_words > 0 AND stops / n_words < 0.02 THEN 'stop_words' END,
      CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.5 THEN 'repeated_lines' END,
      CASE WHEN n_lines > 0 AND bullets / n_lines > 0.9 THEN 'bullet_lines' END,
      CASE WHEN n_lines > 0 AND cut / n_lines > 0.3 THEN 'cut_lines' END], lambda x: x IS NOT NULL) AS bad
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND len(bad) = 0 AS kept, array_to_string(bad, ',') AS failed FROM r"""

NEAR_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex({LOWERED.format("coalesce(text, '')")}, '[ \\t\\n\\x0b\\f\\r]+'),
    lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM links JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT a, b FROM linked UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a),
least AS (SELECT a AS doc_id, least(a, min(b)) AS c FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, w.doc_id) AS component_id,
  coalesce(c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN least ON w.doc_id = least.doc_id"""

TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""

URLS_SQL = f"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
p AS (
  SELECT page_id, {LOWERED.format("regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)([^?#]*)', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
u AS (SELECT DISTINCT host, path FROM p),
fit AS (
  SELECT u.host, u.path, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY u.host, u.path ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS n
  FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN fit ON p.host = fit.host AND p.path = fit.path AND n = 1"""

RANK_SQL = f"""
WITH t AS (
  SELECT doc_id, rowid AS r, unnest(regexp_extract_all({LOWERED.format("text")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS rowid FROM documents)),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWERED.format("text")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark),
n AS (SELECT r, doc_id, count(*) AS n FROM t GROUP BY ALL),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM n),
f AS (SELECT r, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM i) GROUP BY ALL),
d AS (SELECT term, count(*) AS df FROM f GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM d, s),
scored AS (
  SELECT item_id, n.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // len)))) AS BIGINT) AS score
  FROM i JOIN w ON i.term = w.term JOIN f ON f.term = w.term JOIN n ON n.r = f.r, s GROUP BY item_id, n.r, n.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50"""
