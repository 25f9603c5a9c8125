"""SQL twins of the queries that SQL can express; the others are tested against brute force."""

from tillflow.llm.license_texts import named_templates

SQL: dict[str, str] = {}

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"'[^\x20\x09-\x0D]+'"


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _windows(table: str, keys: str, width: int) -> str:
    """(keys, pos, win) for the runs of ``width`` words of a table with a list of words."""
    joined = " || ' ' || ".join(f"words[i + {j}]" for j in range(width))
    return f"""SELECT {keys}, i AS pos, {joined} AS win
        FROM (SELECT {keys}, words, unnest(range(1, len(words) - {width - 2})) AS i FROM {table})"""


SQL["op1_line_dedup"] = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
keyed AS (SELECT doc_id, line, pos, {_lower(f"trim(line, {_BLANKS})")} AS key FROM lines),
shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
    SELECT k.doc_id, k.line, k.pos, coalesce(s.keeper <> k.doc_id, false) AS gone
    FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_NOTICES = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in pair)) for pair in named_templates())
_PLAIN_WORD = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x{BF}\x{2000}-\x{206F}]+'"
SQL["op2_license_scan"] = f"""
WITH notices(license, text) AS (VALUES {_NOTICES}),
notice_words AS (SELECT license, regexp_extract_all({_lower("text")}, {_PLAIN_WORD}) AS words FROM notices),
parts AS (SELECT DISTINCT license, win FROM ({_windows("notice_words", "license", 5)})),
sizes AS (SELECT license, count(*) AS n_shingles FROM parts GROUP BY license),
doc_words AS (SELECT doc_id, regexp_extract_all({_lower("text")}, {_PLAIN_WORD}) AS words FROM documents WHERE text IS NOT NULL),
runs AS ({_windows("doc_words", "doc_id", 5)}),
shared AS (
    SELECT r.doc_id, p.license, count(DISTINCT r.win) AS n_shared, min(r.pos) - 1 AS first_word
    FROM runs r JOIN parts p ON r.win = p.win GROUP BY r.doc_id, p.license)
SELECT doc_id, license, n_shared, n_shingles, first_word
FROM shared JOIN sizes USING (license) WHERE 100 * n_shared >= 80 * n_shingles
"""

SQL["op3_decontamination"] = rf"""
WITH item_words AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS words FROM benchmark WHERE text IS NOT NULL),
parts AS (SELECT DISTINCT item_id, win FROM ({_windows("item_words", "item_id", 5)})),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM parts GROUP BY item_id),
doc_words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS words FROM documents WHERE text IS NOT NULL),
runs AS ({_windows("doc_words", "doc_id", 5)}),
shared AS (
    SELECT r.doc_id, p.item_id, count(DISTINCT r.win) AS n_shared
    FROM runs r JOIN parts p ON r.win = p.win GROUP BY r.doc_id, p.item_id)
SELECT doc_id, item_id, n_shared, n_shingles
FROM shared JOIN sizes USING (item_id) WHERE 100 * n_shared >= 80 * n_shingles
"""

SQL["op4_quality_rules"] = f"""
WITH worded AS (
    SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents),
runs AS ({_windows("worded", "doc_id", 5)}),
again AS (SELECT doc_id, win FROM runs GROUP BY doc_id, win HAVING count(*) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT r.doc_id, unnest(range(r.pos, r.pos + 5)) AS place FROM runs r JOIN again a ON r.doc_id = a.doc_id AND r.win = a.win)
    GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM worded),
same AS (
    SELECT doc_id, count(line) - count(DISTINCT line) AS n_dup_lines FROM lines
    WHERE trim(line, {_BLANKS}) <> '' GROUP BY doc_id),
measured AS (
    SELECT w.doc_id, w.source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM worded w LEFT JOIN same s ON w.doc_id = s.doc_id LEFT JOIN covered c ON w.doc_id = c.doc_id),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured),
hosts AS (
    SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM judged WHERE source IS NOT NULL GROUP BY source),
sums AS (SELECT sum(n) AS n, sum(f) AS f, sum(n * n) AS nn, sum(f * f / n) AS ff, count(*)::DOUBLE AS h FROM hosts),
fitted AS (
    SELECT f / n AS m, least(greatest(coalesce(
        ((ff - f * f / n) / nullif(f / n * (1 - f / n), 0) - (h - 1)) / nullif(n - nn / n - (h - 1), 0), 0), 1e-6), 1 - 1e-6) AS phi
    FROM sums),
bad AS (
    SELECT source FROM hosts, fitted
    WHERE (hosts.f + m * (1 / phi - 1)) / (hosts.n + 1 / phi - 1) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND b.source IS NULL AS kept
FROM judged j LEFT JOIN bad b ON j.source = b.source
"""


def _base32(hexed: str) -> str:
    digits = []
    for group in range(4):
        number = f"('0x' || substr({hexed}, {10 * group + 1}, 10))::BIGINT"
        digits += [
            f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({number} >> {shift}) & 31)::INT + 1, 1)" for shift in range(35, -1, -5)
        ]
    return " || ".join(digits)


SQL["op6_warc"] = f"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages),
found AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM payloads)
SELECT page_id, strlen(payload) AS payload_bytes, {_base32("digest")} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM found
"""

SQL["op8_near_dedup"] = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_WORD}) AS words FROM documents),
parts AS (
    SELECT DISTINCT doc_id, win FROM (
        SELECT doc_id, win FROM ({_windows("worded", "doc_id", 3)})
        UNION ALL SELECT doc_id, array_to_string(words, ' ') FROM worded WHERE len(words) IN (1, 2))),
sizes AS (SELECT doc_id, count(*) AS n FROM parts GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM parts a JOIN parts b ON a.win = b.win AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
    SELECT x, y FROM shared s JOIN sizes p ON s.x = p.doc_id JOIN sizes q ON s.y = q.doc_id
    WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.y, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(r.y, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN least r ON d.doc_id = r.x
"""


def _field(column: str) -> str:
    value = f"CAST({column} AS VARCHAR)"
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# crc32 by its definition, eight steps a byte; ids have up to 20 characters.
_CRC = """
crc_table AS (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256))::BIGINT AS b)),
crc_list AS (SELECT list(v ORDER BY b) AS t FROM crc_table)"""


def _crc(value: str) -> str:
    codes = f"list_transform(string_split({value}, ''), lambda c: ord(c)::BIGINT)"
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
        "lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295)"
    )


SQL["op12_merkle_manifest"] = f"""
WITH RECURSIVE {_CRC.strip()},
leaves AS (
    SELECT source, doc_id, {_leaf("text")} AS leaf,
           {_leaf("CASE WHEN " + _crc("CAST(doc_id AS VARCHAR)") + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS tampered,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS place
    FROM documents, crc_list),
nodes AS (
    SELECT source, 0 AS level, place, leaf AS node, count(*) OVER (PARTITION BY source) AS n FROM leaves
    UNION ALL
    SELECT source, level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (n + 2) // 3
    FROM nodes WHERE n > 1 GROUP BY source, level, place // 3, n),
subroots AS (
    SELECT source, level AS height, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM nodes WHERE n = 1),
tops AS (
    SELECT 0 AS level, place, node, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (n + 2) // 3
    FROM tops WHERE n > 1 GROUP BY level, place // 3, n),
steps AS (
    SELECT l.source, l.doc_id, s.level, s.place < l.place // (3 ** s.level)::BIGINT AS earlier, s.place, s.node
    FROM leaves l JOIN nodes s ON s.source IS NOT DISTINCT FROM l.source
        AND s.place // 3 = l.place // (3 ** (s.level + 1))::BIGINT AND s.place <> l.place // (3 ** s.level)::BIGINT
    UNION ALL
    SELECT l.source, l.doc_id, r.height + s.level, s.place < r.place // (3 ** s.level)::BIGINT, s.place, s.node
    FROM leaves l JOIN subroots r ON r.source IS NOT DISTINCT FROM l.source
        JOIN tops s ON s.place // 3 = r.place // (3 ** (s.level + 1))::BIGINT AND s.place <> r.place // (3 ** s.level)::BIGINT),
sides AS (
    SELECT source, doc_id, level,
           coalesce(string_agg(node, '' ORDER BY place) FILTER (WHERE earlier), '') AS b,
           coalesce(string_agg(node, '' ORDER BY place) FILTER (WHERE NOT earlier), '') AS a
    FROM steps GROUP BY source, doc_id, level),
heights AS (
    SELECT r.source, r.height + (SELECT max(level) FROM tops) AS height, r.node AS subroot, t.node AS root
    FROM subroots r, (SELECT node FROM tops WHERE n = 1) t),
folded AS (
    SELECT l.source, l.doc_id, 0 AS level, tampered AS node, '' AS proof FROM leaves l
    UNION ALL
    SELECT f.source, f.doc_id, f.level + 1, sha256(coalesce(s.b, '') || f.node || coalesce(s.a, '')),
           f.proof || coalesce(s.b, '') || coalesce(s.a, '')
    FROM folded f JOIN heights h ON h.source IS NOT DISTINCT FROM f.source AND f.level < h.height
        LEFT JOIN sides s ON s.source IS NOT DISTINCT FROM f.source AND s.doc_id = f.doc_id AND s.level = f.level)
SELECT l.doc_id, l.leaf, h.subroot, h.root, sha256(f.proof) AS proof_sha256, f.node AS folded_root, f.node = h.root AS verified
FROM leaves l JOIN heights h ON h.source IS NOT DISTINCT FROM l.source
    JOIN folded f ON f.source IS NOT DISTINCT FROM l.source AND f.doc_id = l.doc_id AND f.level = h.height
"""


SQL["op11_source_divergence"] = rf"""
WITH known AS (
    SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
    FROM documents),
found AS (
    SELECT row_id, lang, source, unnest(regexp_extract_all({_lower("text")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM known),
kept AS (
    SELECT lang, term, count(*) AS lang_n FROM found GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
counts AS (
    SELECT f.lang, f.source, f.term, count(*) AS n, any_value(k.lang_n) AS lang_n
    FROM found f JOIN kept k ON f.lang = k.lang AND f.term = k.term GROUP BY f.lang, f.source, f.term),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY lang, source),
groups AS (
    SELECT g.lang, g.source, coalesce(t.total, 0)::HUGEINT AS total, coalesce(l.v, 0)::HUGEINT AS v, l.lang_total
    FROM (SELECT DISTINCT lang, source FROM known) g
    LEFT JOIN totals t ON g.lang = t.lang AND g.source = t.source LEFT JOIN langs l ON g.lang = l.lang),
shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) AS p,
           1 + (1000000000::HUGEINT * (k.lang_n + 5)) // (g.lang_total + 5 * g.v) AS q
    FROM groups g JOIN kept k ON g.lang = k.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
compared AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(c.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN compared c ON c.lang = a.lang AND c.source = a.source AND c.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 50
"""
