"""DuckDB SQL of the queries that SQL can express (2, 6 and 9).

1, 4, 8, 10: trained or hashed models and similarity joins, 5, 7: the tokenizer, 3:
DuckDB has no crc32.  These are tested against brute force in tests/llm.
"""

from __future__ import annotations

from .quality import BITS, PRIOR, RULES as QUALITY_RULES
from .urls import BIN, CLIP, MODEL_SQL, RULES as URL_RULES

_WORD = r"[^\x20\x09-\x0D]+"


def _quality() -> str:
    rounded = lambda v: f"(({v} >> greatest(0, length(bin({v})) - {BITS})) << greatest(0, length(bin({v})) - {BITS}))"
    ratio = lambda m: (f"CASE WHEN {QUALITY_RULES[m][1]} = 0 THEN 0 ELSE ({QUALITY_RULES[m][2]} * {QUALITY_RULES[m][0]}) // "  # noqa: E731
                       f"{QUALITY_RULES[m][1]} END")
    values = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS m, {rounded(f'CAST({ratio(m)} AS BIGINT)')} AS v FROM base WHERE NOT base_failed"
                                for m in QUALITY_RULES)
    width = "CASE m " + " ".join(
        f"WHEN '{m}' THEN " + (f"{reach} * (q3 - q1)" if spread == "quartiles" else f"CAST(floor({reach} * CAST(dev AS DOUBLE) / n) AS BIGINT)") + f" + {margin}"
        for m, (_, _, _, spread, reach, margin, _) in QUALITY_RULES.items()) + " END"
    two = ", ".join(f"'{m}'" for m, rule in QUALITY_RULES.items() if rule[-1])
    mean = lambda c: f"CAST(floor((o.n * CAST(o.{c} AS DOUBLE) + {PRIOR} * CAST(p.{c} AS DOUBLE)) / (o.n + {PRIOR})) AS BIGINT) AS {c}"
    tests = " UNION ALL ".join(f"SELECT rn, lang, source, '{m}' AS m, {ratio(m)} AS x FROM base" for m in QUALITY_RULES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, lang, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
l AS (SELECT rn, [x for x in string_split(t, chr(10)) if regexp_matches(x, '{_WORD}')] AS ls FROM d),
tri AS (SELECT rn, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS g
        FROM (SELECT rn, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
rep AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, g) AS n FROM tri) WHERE n > 1),
hit AS (SELECT rn, count(DISTINCT p) AS n FROM (SELECT rn, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rn),
counts AS (SELECT d.rn, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(hit.n, 0) AS n_repeat_words
    FROM d JOIN l ON l.rn = d.rn LEFT JOIN hit ON hit.rn = d.rn),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
v AS ({values}),
lv AS (SELECT 2 AS level, lang, source, m, v FROM v UNION ALL SELECT 1, lang, NULL, m, v FROM v UNION ALL SELECT 0, NULL, NULL, m, v FROM v),
q AS (SELECT level, lang, source, m, count(*) AS n, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.5) AS q2, quantile_disc(v, 0.75) AS q3
    FROM lv GROUP BY level, lang, source, m),
qd AS (SELECT q.level, q.lang, q.source, q.m, any_value(q.n) AS n, any_value(q1) AS q1, any_value(q2) AS q2, any_value(q3) AS q3, sum(abs(lv.v - q2)) AS dev
    FROM lv JOIN q ON lv.level = q.level AND lv.m = q.m AND lv.lang IS NOT DISTINCT FROM q.lang AND lv.source IS NOT DISTINCT FROM q.source
    GROUP BY q.level, q.lang, q.source, q.m),
own AS (SELECT level, lang, source, m, n, q2 + ({width}) AS hi, q2 - ({width}) AS lo FROM qd),
fl AS (SELECT o.lang, o.m, {mean('hi')}, {mean('lo')} FROM own o JOIN own p ON p.level = 0 AND p.m = o.m WHERE o.level = 1),
fs AS (SELECT o.lang, o.source, o.m, {mean('hi')}, {mean('lo')} FROM own o JOIN fl p ON p.m = o.m AND p.lang IS NOT DISTINCT FROM o.lang WHERE o.level = 2),
x AS ({tests}),
ok AS (SELECT x.rn, bool_and(coalesce(x.x <= fs.hi AND (x.x >= fs.lo OR x.m NOT IN ({two})), true)) AS fine FROM x
    LEFT JOIN fs ON fs.m = x.m AND fs.lang IS NOT DISTINCT FROM x.lang AND fs.source IS NOT DISTINCT FROM x.source GROUP BY x.rn)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND fine AS kept
FROM base JOIN ok USING (rn)"""


def _urls() -> str:
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    longest = sorted(URL_RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in longest)
    label = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in longest)
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH a AS (SELECT row_number() OVER () AS rn, page_id,
        CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substring(url, instr(url, '://') + 3) END AS rest FROM pages),
b AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
c AS (SELECT rn, page_id, {lower.format('rest')} AS rest, {lower.format('raw')} AS host,
        regexp_extract(substring(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
d AS (SELECT *, CASE {rule} END AS rule, CASE {label} END AS label,
        '^^' || regexp_replace(rest, '[^a-z0-9./?=&#%:_-]', '*', 'g') || '$' AS s FROM c),
e AS (SELECT rn, label, substring(s, i, 3) AS gram FROM (SELECT rn, label, s, unnest(range(1, length(s) - 1)) AS i FROM d)),
counts AS (SELECT label, gram, count(*) AS n FROM e GROUP BY 1, 2),
model AS ({MODEL_SQL.format(counts='counts')}),
scored AS (SELECT rn, CAST(floor(sum(llr) / count(*)) AS BIGINT) AS score FROM e JOIN model USING (gram) GROUP BY rn),
bins AS (SELECT d.*, score, greatest(-{CLIP}, least({CLIP}, CAST(floor(score / {BIN}) AS INT))) AS bin FROM d JOIN scored USING (rn)),
hist AS (SELECT bin, count(*) FILTER (label = 'allow') AS a, count(*) FILTER (label = 'block') AS b FROM bins WHERE label IS NOT NULL GROUP BY bin),
total AS (SELECT sum(a) AS a, sum(b) AS b FROM hist),
cut AS (SELECT bin FROM (SELECT h.bin, (SELECT coalesce(sum(a), 0) FROM hist k WHERE k.bin < h.bin) * t.b
          + (SELECT coalesce(sum(b), 0) FROM hist k WHERE k.bin >= h.bin) * t.a AS err FROM hist h, total t) ORDER BY err, abs(bin), bin LIMIT 1)
SELECT page_id, host, path, rule, coalesce(label, CASE WHEN bins.bin >= cut.bin THEN 'allow' ELSE 'block' END) AS verdict, score
FROM bins, cut"""


_DECONTAMINATION = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rn, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT rn, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT rn, i, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
words AS (SELECT rn, count(DISTINCT p) AS n_hit FROM (SELECT rn, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rn),
items AS (SELECT rn, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rn, item FROM hit) GROUP BY rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rn) LEFT JOIN items USING (rn)"""

ORACLE = {"op2_quality_rules": _quality(), "op6_url_filter": _urls(), "op9_decontamination": _DECONTAMINATION}
