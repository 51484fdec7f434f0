"""The corpus queries as DuckDB SQL over the same tables, where SQL can express them."""

from __future__ import annotations

from .license_scan import PERCENT, PHRASES, TEMPLATES

ASCII_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LOWER_TEXT = ASCII_LOWER.format("text")
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {}

ORACLES["op8_heavy_hitters"] = f"""
WITH d AS (SELECT doc_id, sha256({LOWER_TEXT}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

ORACLES["op10_filter_cascade"] = f"""
WITH parts AS (
  SELECT page_id, {ASCII_LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")} AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(rhost, rpath, rverdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.k = 1
"""

ORACLES["op6_fair_queueing"] = f"""
WITH d AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size, md5(doc_id::VARCHAR) AS k FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
run AS (
  SELECT *, 2 * source_size AS full_size,
         (sum(source_size) OVER () * 150 / 100.0 - coalesce(sum(2 * source_size) OVER b, 0))
         / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM per WINDOW b AS (ORDER BY 2 * source_size / w, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(level, full_size / w) AS l FROM run WHERE full_size / w >= level),
targets AS (SELECT source, source_size, least(full_size::DOUBLE, w * coalesce(l, 'inf'::DOUBLE)) AS target FROM run, level),
queue AS (
  SELECT doc_id, size, k, (turn * source_size + sum(size) OVER (PARTITION BY turn, d.source ORDER BY k, doc_id)) / target AS finish
  FROM d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source, (VALUES (0), (1)) AS turns(turn)),
placed AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY finish, k, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM queue WHERE size > 0 AND finish < 2),
taken AS (SELECT doc_id, sum(size)::BIGINT AS taken FROM placed WHERE upto <= (SELECT sum(target) FROM targets) GROUP BY doc_id)
SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(x.taken, 0) AS taken
FROM d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source LEFT JOIN taken x ON x.doc_id = d.doc_id
"""

ORACLES["op5_line_frequency"] = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, {WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
win AS (
  SELECT doc_id, i, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o] AS g,
         lead(i, 4) OVER o AS last
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win WHERE last IS NOT NULL) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM again) GROUP BY doc_id),
l AS (
  SELECT doc_id, source, t, {ASCII_LOWER.format(r"trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS line
  FROM (SELECT doc_id, source, t, unnest(lines) AS line FROM d)),
frequent AS (SELECT source, line FROM l GROUP BY source, line HAVING count(DISTINCT t) > 10),
chars AS (
  SELECT doc_id, sum(length(l.line))::BIGINT AS line_chars, coalesce(sum(length(f.line)), 0)::BIGINT AS lost_chars
  FROM l LEFT JOIN frequent f ON f.source IS NOT DISTINCT FROM l.source AND f.line = l.line GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(line_chars, 0) AS line_chars, coalesce(lost_chars, 0) AS lost_chars
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN chars USING (doc_id))
SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND line_chars - lost_chars >= line_chars * CAST(0.3 AS DOUBLE) AS kept
FROM m
"""

ORACLES["op1_keep_bitmaps"] = f"""
WITH l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
k AS (
  SELECT *, {ASCII_LOWER.format(r"trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
gone AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(g.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE g.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN gone g USING (key) GROUP BY doc_id
"""

ORACLES["op4_set_relations"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWER_TEXT}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(unnest(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) END)) AS g
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id, n.n
"""

ORACLES["op7_induced_sorting"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
p AS (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM d WHERE n >= 100),
w AS (SELECT doc_id, i, hash(substr(h, 2 * i + 1, 200)) AS k1, hash(substr(h, 2 * i + 1, 200) || 'x') AS k2 FROM p),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k1, k2 ORDER BY doc_id, i) AS o FROM w) WHERE o > 1),
e AS (SELECT doc_id, i, max(i + 100) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r),
g AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM e),
s AS (SELECT doc_id, k, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY doc_id, k),
t AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_ FROM s),
x AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS last,
         string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) AS kept
  FROM t JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)
"""

ORACLES["op11_aho_corasick"] = rf"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all({LOWER_TEXT}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWER_TEXT}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM d GROUP BY doc_id),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS total FROM n),
m AS (SELECT doc_id, 50 + ((50 * n * n_docs) // total) AS m FROM n, c),
tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM d WHERE term IN (SELECT term FROM i) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY term),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 50
"""

ORACLES["op12_rollup_phrases"] = f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex({LOWER_TEXT}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p), (VALUES (1), (2), (3)) AS sizes(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k AS size, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:size], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (
  SELECT lang, phrase, max(longer) AS longer FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a AS longer FROM cand WHERE size = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE size = 3) GROUP BY lang, phrase),
r AS (
  SELECT x.lang, row_number() OVER (PARTITION BY x.lang ORDER BY score DESC, a DESC, encode(x.phrase)) AS rank, x.phrase, a, l, r, score
  FROM lowest x LEFT JOIN around o ON o.lang = x.lang AND o.phrase = x.phrase WHERE o.longer IS NULL OR 100 * o.longer < 50 * a)
SELECT r.*, n FROM r JOIN n USING (lang) WHERE rank <= 2000
"""


def _values(rows) -> str:
    return ", ".join(f"({', '.join(repr(x) for x in row)})" for row in rows)


ORACLES["op13_license_join"] = rf"""
WITH d AS (SELECT doc_id, {LOWER_TEXT} AS t, regexp_extract_all({LOWER_TEXT}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
phrases AS (SELECT string_split(phrase, ' ') AS p, label FROM (VALUES {_values(PHRASES)}) AS v(phrase, label)),
places AS (
  SELECT doc_id, i - 1 AS place, label
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d), phrases WHERE w[i:i + len(p) - 1] = p),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place)::BIGINT AS first_word, max(place)::BIGINT AS last_word,
         list_sort(list_distinct(list(label))) AS base FROM places GROUP BY doc_id),
templates AS (SELECT label, list_distinct(string_split(words, ' ')) AS tw FROM (VALUES {_values(TEMPLATES)}) AS v(label, words)),
blocks AS (
  SELECT doc_id, regexp_extract_all(b, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS bw
  FROM (SELECT doc_id, unnest(string_split_regex(t, '
|[.!?][ 	-
]')) AS b FROM d)),
met AS (
  SELECT doc_id, label, len(list_intersect(tw, bw)) AS shared, len(tw) AS size FROM blocks, templates
  WHERE 100 * len(list_intersect(tw, bw)) >= {PERCENT} * len(tw)),
more AS (SELECT doc_id, list(label) AS more, max(shared / size) AS best FROM met GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(coalesce(base, []), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1 ELSE coalesce(best, 0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""
