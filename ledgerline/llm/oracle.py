"""DuckDB statements for the operators that SQL can express.

The others have no statement: op2 (a trained random field), op4 (trained language
models), op5 (an agenda with keyed drop-out), op6 (XXH64), op8 (an order by XXH64),
op9 (a tree builder) and the pipeline that holds op2 and op5; tests hold them
against brute-force versions, round trips and held-out rows.
"""

from __future__ import annotations

from ledgerline.llm.quality import MIN_GROUP, MIN_WORDS, REACH, REPEAT_PERCENT, RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACES = r"[\x20\x09-\x0D]"

OP1 = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
d AS (SELECT *, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS original FROM p)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(hex, 1 + 5 * CAST(floor(i / 4) AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < original THEN original END AS refers_to, url
FROM d
"""


def _op3() -> str:
    value = lambda r: f"CASE WHEN {r.bottom} > 0 THEN {r.scale} * {r.top} // {r.bottom} END"
    long = " UNION ALL ".join(
        f"SELECT lang, source, '{r.name}' AS rule, {value(r)} AS v FROM once WHERE {r.bottom} > 0" for r in RULES)

    def quart(name: str, keys: str) -> str:
        by = f"{keys}, rule" if keys else "rule"
        head = f"{keys}, " if keys else ""
        return f"""{name} AS (SELECT {head}rule, max(total) AS total, min(CASE WHEN 4 * up >= total THEN value END) AS q25,
            min(CASE WHEN 2 * up >= total THEN value END) AS q50 FROM (
            SELECT {head}rule, value, sum(n) OVER (PARTITION BY {by} ORDER BY value) AS up, sum(n) OVER (PARTITION BY {by}) AS total
            FROM (SELECT {head}rule, value, sum(n) AS n FROM sketch GROUP BY ALL)) GROUP BY ALL)"""

    pick = lambda q: f"CASE WHEN f.total >= {MIN_GROUP} THEN f.{q} WHEN l.total >= {MIN_GROUP} THEN l.{q} ELSE e.{q} END"
    slack = "CASE f.rule " + " ".join(f"WHEN '{r.name}' THEN {r.slack}" for r in RULES) + " END"
    broken = " OR ".join(f"coalesce({value(r)} > top_{r.name}, false)" for r in RULES)
    tops = ", ".join(f"max(CASE WHEN rule = '{r.name}' THEN top END) AS top_{r.name}" for r in RULES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{_SPACES}+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
tri AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT rid, count(DISTINCT j) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM tri) WHERE c > 1) GROUP BY rid),
b AS (SELECT w.rid, doc_id, lang, source, text, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(ls) AS BIGINT) AS n_lines, CAST(length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS BIGINT) AS n_capitals
    FROM w LEFT JOIN rep ON w.rid = rep.rid),
m AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM b),
once AS (SELECT DISTINCT lang, source, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals FROM m WHERE NOT base_failed),
long AS ({long}),
sketch AS (SELECT lang, source, rule, v - v % (1::BIGINT << greatest(length(bin(v)) - 6, 0)) AS value, count(*) AS n FROM long GROUP BY ALL),
{quart("fine", "lang, source")}, {quart("by_lang", "lang")}, {quart("every", "")},
cut AS (SELECT f.lang, f.source, f.rule, {pick("q50")} + greatest({REACH} * ({pick("q50")} - {pick("q25")}), {slack}) AS top
    FROM fine f LEFT JOIN by_lang l ON f.lang IS NOT DISTINCT FROM l.lang AND f.rule = l.rule LEFT JOIN every e ON f.rule = e.rule),
tops AS (SELECT lang, source, {tops} FROM cut GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({broken}) AS kept
FROM m LEFT JOIN tops t ON m.lang IS NOT DISTINCT FROM t.lang AND m.source IS NOT DISTINCT FROM t.source
"""


OP7 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM benchmark),
iw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, l, array_to_string(list_slice(ws, i, i + l - 1), ' ') AS win FROM (
    SELECT item_id, ws, least(10, len(ws)) AS l, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS i FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT l FROM iw),
dw AS (SELECT rid, i, l, array_to_string(list_slice(ws, i, i + l - 1), ' ') AS win FROM (
    SELECT rid, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM d, lens WHERE len(ws) >= l)),
m AS (SELECT dw.rid, dw.i, dw.l, iw.item FROM dw JOIN iw ON dw.win = iw.win AND dw.l = iw.l),
h AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + l)) AS j FROM m) GROUP BY rid),
o AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(o.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.rid = h.rid LEFT JOIN o ON d.rid = o.rid
"""

OP10 = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS s FROM c),
f AS (SELECT *, length(s) + length(s) - length(replace(s, '\', '')) + len(regexp_extract_all(s, '[\[<](?:/?INST\]|OUT\]|/?TURN|/?s>)')) AS body,
    CASE r WHEN 'user' THEN 15 WHEN 'assistant' THEN 10
    ELSE 16 + length(r) + length(r) - length(replace(r, '\', '')) + length(r) - length(replace(r, ']', ''))
        + len(regexp_extract_all(r, '[\[<](?:/?INST\]|OUT\]|/?TURN|/?s>)')) END AS marks FROM t)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(r || chr(10) || s || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)) AS turns_sha256,
    CAST(coalesce(sum(length(s)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(s, '' ORDER BY turn NULLS FIRST, text NULLS FIRST) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
    CAST(sum(body + marks) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

_TERMS = rf"""regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"""
OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ws FROM documents),
b AS (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS ws FROM benchmark),
c AS (SELECT count(*) AS total, sum(len(ws)) AS length FROM d WHERE len(ws) > 0),
q AS (SELECT item, t, count(*) AS times FROM (SELECT item, unnest(ws) AS t FROM b) GROUP BY ALL),
tf AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ws) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2.0 * total + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY t, total),
v AS (SELECT tf.rid, d.doc_id, tf.t, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(d.ws) * total) // length)) AS v
    FROM tf JOIN d ON tf.rid = d.rid, c),
s AS (SELECT q.item, v.rid, any_value(v.doc_id) AS doc_id, sum(w.w * q.times * v.v) AS score FROM q JOIN v ON q.t = v.t JOIN w ON w.t = q.t GROUP BY ALL),
r AS (SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r JOIN b ON r.item = b.item WHERE rank <= 20
"""

# crc32 of an id in decimal: eight shifts for each character
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(s) + 1),
    lambda k: CAST(ascii(substr(s, CAST(k AS INTEGER), 1)) AS BIGINT))), lambda c, b: list_reduce(
    list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda e, z: xor(e >> 1, 3988292384 * (e & 1)))))"""
# A run of period q holds at least 3 q - 2 equal three-word grams at distance q, next to each other: lags come from equal grams,
# runs are islands of such pairs, and a run inside one whose period divides its own is not of smallest period.
OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, CAST(doc_id AS VARCHAR) AS s,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACES}+'), lambda x: x <> '') AS ws FROM documents),
e AS (SELECT rid, doc_id, ws, len(ws) AS n, CASE WHEN s IS NOT NULL THEN {_CRC} END AS h FROM d),
f AS (SELECT *, (h // 10) % greatest(n, 1) AS a, 3 + (h // 10) % 8 AS parts FROM e),
w AS (SELECT rid, doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN
    list_transform(range(n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END + 1]) ELSE ws END AS ws FROM f),
word AS (SELECT rid, unnest(range(len(ws))) AS i, unnest(ws) AS x FROM w),
gram AS (SELECT rid, i, ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] AS g FROM (SELECT rid, ws, unnest(range(len(ws) - 2)) AS i FROM w WHERE len(ws) > 5)),
pair AS (SELECT a.rid, a.i, b.i - a.i AS q FROM gram a JOIN gram b ON a.rid = b.rid AND a.g = b.g AND a.i < b.i),
lag_ AS (SELECT rid, q FROM pair GROUP BY rid, q HAVING count(*) >= greatest(3 * q, 6 - q) - 2),
island AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS k FROM pair JOIN lag_ USING (rid, q)),
stretch AS (SELECT rid, min(i) AS start, count(*) + 2 + q AS length, q AS period FROM island GROUP BY rid, q, k HAVING count(*) + 2 + q >= greatest(6, 4 * q)),
run AS (SELECT * FROM stretch r WHERE NOT EXISTS (SELECT 1 FROM stretch s WHERE s.rid = r.rid AND s.period < r.period AND r.period % s.period = 0
    AND s.start <= r.start AND s.start + s.length >= r.start + r.length)),
best AS (SELECT rid, start, length, period FROM run QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length DESC, start, period) = 1),
runs AS (SELECT rid, count(*) AS n, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM run GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT rid, string_agg(x, ' ' ORDER BY i) AS collapsed FROM word ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, CAST(coalesce(runs.n, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
    CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
    sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM w LEFT JOIN best USING (rid) LEFT JOIN runs USING (rid) LEFT JOIN kept USING (rid)
"""

# The exact search; on the given tables the production factor finds all of it (and the tests hold its recall against a bound).
OP13 = """
WITH v AS (SELECT vec_id AS id, min(CAST(embedding AS DOUBLE[])) AS x FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(list_filter(embedding, lambda y: y <> 0)) > 0 GROUP BY vec_id),
s AS (SELECT q.id AS query_id, v.id AS vec_id, list_reduce(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * v.x[i]), lambda a, b: a + b) AS score
    FROM v q JOIN v ON q.id % 20 = 0 AND q.id <> v.id AND len(q.x) = len(v.x))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

ORACLE: dict[str, str] = {"op1_warc": OP1, "op3_quality_rules": _op3(), "op7_decontamination": OP7, "op10_chat_formatting": OP10,
                           "op11_periodic_runs": OP11, "op12_lexical_search": OP12,
                           "op13_nearest_neighbours": OP13}
