"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from convaudit.llm.quality import STOP_WORDS, THRESHOLDS
from convaudit.llm.secret_scan import BASE, RULES, Rule

SQL: dict[str, str] = {}


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


DOCS = "d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents)"


def _passes(name: str, measure: str, low, high, base: str | None) -> str:
    value, scale = (f"100 * {measure}", base) if base else (measure, "1")
    tests = ([f"{value} >= {low} * {scale}"] if low is not None else []) + ([f"{value} <= {high} * {scale}"] if high is not None else [])
    return " AND ".join(tests)


STOPS = "[" + ", ".join(quoted(s) for s in sorted({*STOP_WORDS, *(s[:1].upper() + s[1:] for s in STOP_WORDS)})) + "]"

SQL["op5_quality_rules"] = rf"""
WITH {DOCS},
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS k FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, sum(least(8, nxt - i)) AS n FROM (
          SELECT rid, i, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i), i + 8) AS nxt FROM dup) GROUP BY rid),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
             len(ls) AS n_lines, len(list_filter(ws, lambda x: list_contains({STOPS}, x))) AS n_stop_words,
             len(regexp_extract_all(t, '\p{{Lu}}{{2,}}')) AS n_shouted,
             len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) AS n_stutters
      FROM w LEFT JOIN cov USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       {" AND ".join(_passes(*r) for r in THRESHOLDS)} AS kept
FROM m"""


def _matches(order: int, rule: Rule) -> str:
    p = quoted(rule.pattern)
    return f"""SELECT rid, {order} AS ord, {quoted(rule.name)} AS rule, {rule.least} AS least, {rule.whole} AS whole, unnest(range(1, len(ms) + 1)) AS i, ps, ms, gs
 FROM (SELECT rid, string_split_regex(t, {p}) AS ps, regexp_extract_all(t, {p}, 0) AS ms, regexp_extract_all(t, {p}, {rule.group}) AS gs FROM d)"""


SQL["op6_secret_scans"] = f"""
WITH {DOCS},
m AS ({" UNION ALL ".join(_matches(i, r) for i, r in enumerate(RULES))}),
p AS (SELECT rid, ord, rule, length(gs[i]) >= least AND length(ms[i]) >= whole AS ok, length(ms[i]) AS size,
             sum(length(ps[i]) + length(ms[i])) OVER (PARTITION BY rid, ord ORDER BY i) AS e FROM m),
s AS (SELECT rid, ord, rule, e - size AS b, rule || ':' || CAST(e - size AS VARCHAR) || ':' || CAST(e AS VARCHAR) AS span FROM p WHERE ok),
a AS (SELECT rid, {", ".join(f"count(*) FILTER (rule = '{r}') AS n_{r}" for r in BASE)},
             string_agg(span, ',' ORDER BY b, ord) FILTER (ord < {len(BASE)}) AS base, string_agg(span, ',' ORDER BY b, ord) AS spans FROM s GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{r}, 0) AS n_{r}" for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (rid)"""

_NIBBLE = "(strpos('0123456789abcdef', h[{at}]) - 1)"
SQL["op7_warc"] = f"""
SELECT page_id, strlen(t) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + (((({_NIBBLE.format(at="(5 * k) // 4 + 1")} * 16 + {_NIBBLE.format(at="(5 * k) // 4 + 2")}) >> CAST(3 - (5 * k) % 4 AS BIGINT))) & 31), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, t, sha1(t) AS h, min(page_id) OVER (PARTITION BY t) AS first
      FROM (SELECT page_id, coalesce(html, '') AS t FROM pages))"""

SQL["op9_line_dedup"] = r"""
WITH l AS (SELECT doc_id, unnest(range(0, len(ls))) AS line, unnest(ls) AS raw
           FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
p AS (SELECT *, string_split_regex(raw, '[.!?][\x20\x09-\x0D]+') AS ps, regexp_extract_all(raw, '[.!?][\x20\x09-\x0D]+') AS gs,
             sum(length(raw) + 1) OVER (PARTITION BY doc_id ORDER BY line) - length(raw) - 1 AS pos FROM l),
q AS (SELECT *, unnest(range(1, len(ps) + 1)) AS s FROM p),
t AS (SELECT doc_id, line, s, raw, pos, len(ps) AS n, ps[s] || coalesce(substr(gs[s], 1, 1), '') AS sent, coalesce(substr(gs[s], 2), '') AS gap,
             sum(length(ps[s]) + length(coalesce(gs[s], ''))) OVER (PARTITION BY doc_id, line ORDER BY s) - length(ps[s]) - length(coalesce(gs[s], '')) AS a
      FROM q),
u AS (SELECT doc_id, line, 0 AS s, raw AS unit, 5 AS least FROM p UNION ALL SELECT doc_id, line, s, sent, 8 FROM t WHERE n > 1),
n AS (SELECT *, trim(regexp_replace(lower(unit), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS body FROM u),
g AS (SELECT doc_id, line, s FROM (
        SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, line, s) AS r FROM n
        WHERE body <> '' AND len(string_split(body, ' ')) >= least) WHERE r > 1),
k AS (SELECT t.*, gl.line IS NOT NULL AS lost, gs.line IS NOT NULL AS gone
      FROM t LEFT JOIN g gl ON gl.doc_id = t.doc_id AND gl.line = t.line AND gl.s = 0
             LEFT JOIN g gs ON gs.doc_id = t.doc_id AND gs.line = t.line AND gs.s = t.s),
r AS (SELECT doc_id, line, any_value(raw) AS raw, any_value(pos) AS pos, bool_or(lost) AS lost, bool_or(gone) AS cut,
             coalesce(string_agg(sent || gap, '' ORDER BY s) FILTER (NOT gone), '') AS rest, bool_or(gone AND s = n) AS end_gone,
             list(struct_pack(b := pos + a, e := pos + a + length(sent)) ORDER BY s) FILTER (gone) AS cuts FROM k GROUP BY doc_id, line),
v AS (SELECT *, CASE WHEN NOT cut THEN raw WHEN end_gone THEN rtrim(rest, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) ELSE rest END AS txt,
             CASE WHEN lost THEN [struct_pack(b := pos, e := pos + length(raw))] WHEN cut THEN cuts ELSE [] END AS spans FROM r),
a AS (SELECT doc_id, coalesce(string_agg(txt, chr(10) ORDER BY line)
               FILTER (NOT lost AND (NOT cut OR regexp_matches(txt, '[^\x20\x09-\x0D]'))), '') AS text,
             count(*) FILTER (regexp_matches(raw, '[^\x20\x09-\x0D]')) AS n_units, CAST(sum(len(spans)) AS BIGINT) AS n_removed,
             flatten(list(spans ORDER BY line)) AS every FROM v GROUP BY doc_id)
SELECT d.doc_id, a.text, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed,
       coalesce(array_to_string(list_transform(every, lambda x: CAST(x.b AS VARCHAR) || ':' || CAST(x.e AS VARCHAR)), ','), '') AS removed
FROM documents d LEFT JOIN a USING (doc_id)"""

# CRC-32 by its table: 256 entries of the reversed polynomial, made by eight shifts each
_CRC_TABLE = ("list_transform(range(0, 256), lambda x: list_reduce(range(0, 8), "
              "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x))")
_BYTES = ("flatten(list_transform(string_split({s}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] "
          "ELSE [CAST(195 AS BIGINT), CAST(unicode(c) - 64 AS BIGINT)] END))")
_UPPER = "".join(map(chr, range(65, 91)))

SQL["op12_spelling"] = f"""
WITH RECURSIVE t AS MATERIALIZED (SELECT {_CRC_TABLE} AS tab),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[a-zÀ-ÿ]+')) AS run
      FROM documents WHERE text IS NOT NULL),
d AS (SELECT doc_id, run, count(*) AS c FROM r GROUP BY doc_id, run),
h AS (SELECT run, c, xor(list_reduce({_BYTES.format(s="coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")},
             lambda acc, b: xor(acc >> 8, tab[(xor(acc, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM d, t),
x AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM h),
w AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM x WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
v AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
                   FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS MATERIALIZED (SELECT DISTINCT * FROM (
      SELECT a.word AS a, b.word AS b, b.n AS b_n FROM v a JOIN v b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION ALL SELECT v.word, w.word, w.n FROM v JOIN w ON v.rest = w.word
      UNION ALL SELECT w.word, v.word, v.n FROM v JOIN w ON v.rest = w.word)),
k AS (SELECT a, b, b_n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY b_n DESC, b) AS at FROM p),
f AS MATERIALIZED (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b_n >= 2 * n THEN b END AS form, CASE WHEN b_n >= 2 * n THEN b_n END AS form_n
      FROM w LEFT JOIN k ON k.a = w.word AND k.at = 1),
g AS (SELECT word, word AS here, form AS next FROM f UNION ALL SELECT g.word, f.word, f.form FROM g JOIN f ON g.next = f.word)
SELECT f.word, form, here AS root, n, n_near, form_n FROM f JOIN g ON f.word = g.word WHERE next IS NULL"""
