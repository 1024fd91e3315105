"""DuckDB SQL with the same rows as the queries, written apart from the operators."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def url_filter_sql(rounds: int = 12) -> str:
    steps = []
    for name, a, b in (("trust", "source", "target"), ("distrust", "target", "source")):
        seed = "allowed" if name == "trust" else "blocked"
        steps.append(f"""
{name}_steps AS (
  SELECT {a} AS s, {b} AS t, pages * 1000000 // sum(pages) OVER (PARTITION BY {a}) AS share FROM links),
{name}_seed AS (
  SELECT host, {seed} * 1000000 // (SELECT sum({seed}) FROM counted WHERE 2 * {seed} > pages) * 1000000 AS mass
  FROM counted WHERE 2 * {seed} > pages),
{name}_0 AS (SELECT host, mass AS score FROM {name}_seed)""")
        for k in range(1, rounds + 1):
            steps.append(f"""
{name}_{k} AS (
  SELECT host, CAST(sum(score) AS BIGINT) AS score FROM (
    SELECT host, mass * 15 // 100 AS score FROM {name}_seed UNION ALL
    SELECT t, score * share // 1000000 * 85 // 100 FROM {name}_steps JOIN {name}_{k - 1} ON s = host) GROUP BY host)""")
    chain = ",".join(steps)
    return rf"""
WITH rules(rule, verdict) AS (VALUES
  ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'),
  ('net/fr/', 'block')),
parsed AS (SELECT rule, verdict, split_part(rule, '/', 1) AS h, substr(rule, instr(rule, '/')) AS p FROM rules),
rest AS (
  SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
  FROM pages),
urls AS (
  SELECT page_id, html, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
hits AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM urls JOIN parsed ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
counted AS (
  SELECT host, count(*) AS pages, count(*) FILTER (verdict = 'allow') AS allowed,
    count(*) FILTER (verdict = 'block') AS blocked
  FROM urls LEFT JOIN hits USING (page_id) WHERE host <> '' GROUP BY host),
found AS (
  SELECT DISTINCT page_id, host AS source, translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    AS target
  FROM (SELECT page_id, host, unnest(list_distinct(regexp_extract_all(coalesce(html, ''),
    '(?i)\bhref\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s<>]+)', 1))) AS l FROM urls)),
links AS (
  SELECT source, target, count(*) AS pages FROM found WHERE source <> '' AND source <> target GROUP BY 1, 2),{chain}
SELECT page_id, host, path, rule, coalesce(hits.verdict,
    CASE WHEN coalesce(d.score, 0) >= 1000 AND coalesce(d.score, 0) > 2 * coalesce(t.score, 0) THEN 'block'
      ELSE 'allow' END) AS verdict,
  coalesce(t.score, 0) AS trust, coalesce(d.score, 0) AS distrust
FROM urls LEFT JOIN hits USING (page_id) LEFT JOIN trust_{rounds} t USING (host)
LEFT JOIN distrust_{rounds} d USING (host)"""


QUALITY = rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, {WORDS} AS ws FROM documents),
lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM (
    SELECT doc_id, i, list_slice(ws, i, i + 7) AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d))),
again AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, range(8) r(k) WHERE n > 1 GROUP BY doc_id),
base AS (
  SELECT doc_id, lang, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(array_to_string(ws, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words,
    len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) AS stuttered
  FROM d JOIN lines USING (doc_id) LEFT JOIN again USING (doc_id)),
measured AS (
  SELECT doc_id, lang, source, n_words,
    unnest(['word_length', 'symbol_share', 'dup_line_share', 'stutter_share', 'repeat_share']) AS m,
    unnest([word_chars, n_symbols, n_dup_lines, stuttered, n_repeat_words]) * 10000
      // greatest(unnest([n_words, n_words, n_lines, n_words, n_words]), 1) AS v FROM base),
buckets AS (
  SELECT *, (v >> greatest(length(bin(v)) - 8, 0)) << greatest(length(bin(v)) - 8, 0) AS b FROM measured
  WHERE n_words > 0),
groups AS (
  SELECT 1 AS level, lang, source, m, b FROM buckets UNION ALL SELECT 2, lang, NULL, m, b FROM buckets
  UNION ALL SELECT 3, NULL, NULL, m, b FROM buckets),
placed AS (
  SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY level, lang, source, m) AS total FROM groups
  WINDOW w AS (PARTITION BY level, lang, source, m ORDER BY b)),
quant AS (
  SELECT level, lang, source, m, max(total) AS total, min(b) FILTER (place * 10 >= total) AS low,
    min(b) FILTER (place * 10 >= total * 5) AS mid, min(b) FILTER (place * 10 >= total * 9) AS high
  FROM placed GROUP BY ALL),
chosen AS (
  SELECT o.lang, o.source, o.m, CASE WHEN o.total >= 200 THEN o WHEN l.total >= 200 THEN l ELSE a END AS q
  FROM quant o JOIN quant l ON o.level = 1 AND l.level = 2 AND o.lang IS NOT DISTINCT FROM l.lang AND o.m = l.m
  JOIN quant a ON a.level = 3 AND a.m = o.m),
fences AS (
  SELECT lang, source, m,
    CASE WHEN m = 'word_length' THEN least(q.low - 3 * (q.high - q.low), q.mid - 20000) END AS floor,
    greatest(q.high + 3 * (q.high - q.low), q.mid + CASE m WHEN 'word_length' THEN 20000 WHEN 'symbol_share' THEN 1000
      WHEN 'dup_line_share' THEN 3000 WHEN 'repeat_share' THEN 1000 ELSE 2000 END) AS ceiling FROM chosen),
broken AS (
  SELECT x.doc_id, string_agg(x.m, ',' ORDER BY list_position(['word_length', 'symbol_share', 'dup_line_share',
    'stutter_share', 'repeat_share'], x.m)) AS failed
  FROM measured x JOIN fences f ON x.lang IS NOT DISTINCT FROM f.lang AND x.source IS NOT DISTINCT FROM f.source
    AND x.m = f.m WHERE x.v < f.floor OR x.v > f.ceiling GROUP BY x.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND failed IS NULL AS kept, coalesce(failed, '') AS failed
FROM base LEFT JOIN broken USING (doc_id)"""


def repeats_sql(size: int) -> str:
    """Whole texts of words are compared window by window; a document is known by its doc_id."""
    return rf"""
WITH d AS (SELECT doc_id, {WORDS} AS ws FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + {size - 1}), ' ')) AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {size - 2})) AS i FROM d)),
shared AS (SELECT doc_id, i FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
steps AS (
  SELECT doc_id, place, sum(n) AS n FROM (
    SELECT doc_id, i AS place, 1 AS n FROM shared UNION ALL SELECT doc_id, i + {size}, -1 FROM shared) GROUP BY 1, 2),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM d),
depth AS (
  SELECT doc_id, word, place, coalesce(sum(s.n) OVER (PARTITION BY doc_id ORDER BY place), 0) > 0 AS gone
  FROM words LEFT JOIN steps s USING (doc_id, place)),
spans AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY place), false) AS opens FROM depth),
cut AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
    coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT gone), '') AS kept FROM spans GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256,
  coalesce(n_spans, 0) AS n_spans FROM d LEFT JOIN cut USING (doc_id)"""


JACCARD = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s
  AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM met JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * common >= 75 * (a.n + b.n - common)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(min(y), d.doc_id)) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON reach.x = d.doc_id GROUP BY d.doc_id, n"""


WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: right('000' || bin(
    strpos('0123456789abcdef', substr(hex, i, 1)) - 1), 4)), '') AS b, max(page_id) OVER (PARTITION BY hex) AS last FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    list_sum(list_transform(range(5), lambda k: CAST(substr(b, i * 5 + k + 1, 1) AS INTEGER) << (4 - k))) AS INTEGER), 1)),
    '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to FROM bits"""


#: Lines meet on the rarest quarter of their words, as they must to be similar, and are compared in full.
LINES = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k FROM documents),
firsts AS (
  SELECT line, min((doc_id, k)) AS first, list_sort(list_distinct(regexp_extract_all(line, '[^ 	-
]+'))) AS ws
  FROM lines GROUP BY line),
long AS (SELECT * FROM firsts WHERE len(ws) >= 1),
tokens AS (SELECT line, first, len(ws) AS n, unnest(ws) AS w FROM long),
ranked AS (
  SELECT line, first, n, w, row_number() OVER (PARTITION BY line ORDER BY c, w) AS r
  FROM (SELECT *, count(*) OVER (PARTITION BY w) AS c FROM tokens)),
heads AS (SELECT * FROM ranked WHERE r <= n - CAST(ceil(n * 0.75) AS BIGINT) + 1),
pairs AS (
  SELECT DISTINCT a.line AS early, b.line AS late FROM heads a JOIN heads b ON a.w = b.w AND a.first < b.first
  AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)),
beaten AS (
  SELECT DISTINCT late FROM pairs JOIN long a ON a.line = early JOIN long b ON b.line = late
  WHERE 7 * len(list_intersect(a.ws, b.ws)) >= 3 * (len(a.ws) + len(b.ws))),
judged AS (
  SELECT l.doc_id, l.k, l.line, f.line IS NOT NULL AND (b.late IS NOT NULL OR (l.doc_id, l.k) > f.first) AS gone
  FROM lines l LEFT JOIN long f ON f.line = l.line LEFT JOIN beaten b ON b.late = l.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS text_sha256
FROM judged GROUP BY doc_id"""


#: CRC-32 of a list of bytes, from the table that its polynomial gives.
CRC_TABLE = """
crc_table AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                ORDER BY i) AS crcs
    FROM range(256) AS r (i)
)"""


def crc32(text: str) -> str:
    """The CRC-32 of an SQL text's UTF-8 bytes; ``crcs`` of CRC_TABLE has to be in scope."""
    code = f"hex(encode({text}))"
    read = f"list_transform(range(0, length({code}), 2), lambda k: concat('0x', substr({code}, k + 1, 2))::BIGINT)"
    step = "lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {read}), {step}), 4294967295)"


#: Pairs of near words by the patterns and words that leaving out one letter gives.
SPELLINGS = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[a-z\\x{{00C0}}-\\x{{00FF}}]{{7,}}')) AS run
    FROM documents
),
hashed AS (
    SELECT run, times, {crc32("id || ':' || run")} AS h
    FROM (SELECT id, run, count(*) AS times FROM runs GROUP BY ALL), crc_table
),
results AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, times
    FROM hashed
),
words AS (
    SELECT word, sum(times)::BIGINT AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
),
cut AS (
    SELECT word, n, k, substr(word, 1, k) AS head, substr(word, k + 2) AS tail
    FROM (SELECT word, n, unnest(range(length(word))) AS k FROM words)
),
replaced AS (
    SELECT a.word, b.word AS near, b.n AS near_n
    FROM cut AS a JOIN cut AS b ON a.k = b.k AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
),
deleted AS (
    SELECT DISTINCT cut.word AS longer, cut.n AS longer_n, words.word AS shorter, words.n AS shorter_n
    FROM cut JOIN words ON words.word = head || tail
),
near AS (
    SELECT * FROM replaced
    UNION ALL SELECT longer, shorter, shorter_n FROM deleted
    UNION ALL SELECT shorter, longer, longer_n FROM deleted
),
judged AS (
    SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS best, max(near_n) AS best_n FROM near GROUP BY word
),
forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form, CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
    FROM words LEFT JOIN judged USING (word)
),
chain AS (
    SELECT word, word AS at FROM words
    UNION ALL
    SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NOT NULL
)
SELECT forms.word, forms.form, chain.at AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN chain ON chain.word = forms.word JOIN forms AS ends ON ends.word = chain.at AND ends.form IS NULL
"""

#: Each node by the digests of its turns; totals by pairs of a node and each of its ancestors.
TRIE = f"""
WITH {CRC_TABLE},
turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS j
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT c, c - c % 20 AS base, {crc32("c::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT c FROM turns), crc_table
),
parts AS (
    SELECT convs.c, 0 AS part, j, role, text FROM convs JOIN turns ON turns.c = base AND j <= h
    UNION ALL
    SELECT c, 1, j, role, text FROM convs JOIN turns USING (c) WHERE j > h
),
rebuilt AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, j) AS d, md5(role) || md5(text) AS said,
           len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
    FROM parts
    UNION ALL
    SELECT c, 0, '', 0 FROM convs
),
paths AS (
    SELECT c, d, words, md5(string_agg(said, '') OVER (PARTITION BY c ORDER BY d)) AS node FROM rebuilt
),
nodes AS (SELECT d, node, min(c) AS c, count(*) AS n_convs, max(words) AS words FROM paths GROUP BY d, node),
placed AS (
    SELECT nodes.*, above.c AS parent
    FROM nodes LEFT JOIN paths ON paths.c = nodes.c AND paths.d = nodes.d - 1
    LEFT JOIN nodes AS above ON above.node = paths.node AND above.d = paths.d
),
counted AS (
    SELECT placed.*, coalesce(n_children, 0) AS n_children
    FROM placed LEFT JOIN (SELECT parent AS c, d - 1 AS d, count(*) AS n_children FROM placed GROUP BY ALL) USING (c, d)
),
totals AS (
    SELECT paths.node, paths.d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * counted.words)::BIGINT AS saved_tokens
    FROM counted JOIN paths ON paths.c = counted.c AND paths.d <= counted.d
    GROUP BY paths.node, paths.d
),
ends AS (
    SELECT node, d, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
    FROM (SELECT c, max(d) AS d FROM paths GROUP BY c) JOIN paths USING (c, d) GROUP BY node, d
)
SELECT c AS conv_id, d AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM counted JOIN totals USING (node, d) LEFT JOIN ends USING (node, d)
"""
