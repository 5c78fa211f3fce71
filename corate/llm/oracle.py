"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

from . import quality_rules as q

_SPLIT = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _top(b: str) -> str:
    cut = f"greatest({b} // 32 - 1, 0)"
    return f"((({b} - {cut} * 32 + 1) << {cut}::INT) - 1)"


def _op4() -> str:
    names = list(q.MEASURES)
    value = {
        "symbols": "1000 * n_symbols // n_words", "dup_lines": "1000 * n_dup_lines // n_lines",
        "repeats": "1000 * n_repeat_words // n_words", "word_length": "1000 * word_chars // n_words",
    }
    least = " ".join(f"WHEN '{m}' THEN {least}" for m, (_, least) in q.MEASURES.items())
    cut = "greatest(length(bin(v)) - 6, 0)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, {_SPLIT} AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT r, i, list_aggregate(ws[i:i + 4], 'string_agg', ' ') AS gram
      FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1),
cover AS (SELECT r, sum(least(5, i - coalesce(before, -9))) AS n
          FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM twice) GROUP BY r),
b AS (SELECT d.r, doc_id, lang, source, len(ws)::BIGINT AS n_words,
        length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words
      FROM d JOIN w USING (r) LEFT JOIN cover USING (r)),
m AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
        {', '.join(f'coalesce({value[x]}, 0) AS m_{x}' for x in names)} FROM b),
v AS ({' UNION ALL '.join(f"SELECT lang, source, '{x}' AS measure, m_{x} AS v FROM m WHERE NOT base_failed" for x in names)}),
s AS (SELECT lang, source, measure, {cut} * 32 + (v >> {cut}::INT) AS bucket, count(*) AS n FROM v GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto,
        sum(n) OVER (PARTITION BY lang, source, measure) AS total FROM s),
f AS (SELECT lang, source, measure, min(bucket) FILTER (upto >= ceil({q.QUANTILES[0]} * total)) AS lo,
        min(bucket) FILTER (upto >= ceil({q.QUANTILES[1]} * total)) AS hi FROM c GROUP BY ALL),
t AS (SELECT lang, source, measure, greatest({_top('hi')} + {q.FENCE} * greatest({_top('hi')} - {_top('lo')}, {_top('(hi + 1)')} - {_top('hi')}),
        CASE measure {least} END) AS fence FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {' AND '.join(f"coalesce(m_{x} <= t_{x}.fence, true)" for x in names)} AS kept
FROM m {' '.join(f"LEFT JOIN t AS t_{x} ON t_{x}.measure = '{x}' AND t_{x}.lang IS NOT DISTINCT FROM m.lang AND t_{x}.source IS NOT DISTINCT FROM m.source" for x in names)}
"""


OP10 = f"""
WITH d AS (SELECT doc_id, source, len({_SPLIT})::BIGINT AS size,
    ('0x' || substr(md5('10|' || coalesce(doc_id::VARCHAR, 'null') || '|' || coalesce(text, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
k AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM p),
r AS (SELECT *, 3.0::DOUBLE * source_size / weight AS ratio FROM k),
z AS (SELECT *, 3.0::DOUBLE * coalesce(sum(source_size) OVER o, 0)::DOUBLE AS clamped, coalesce(sum(weight) OVER o, 0)::BIGINT AS ahead,
        sum(source_size) OVER ()::DOUBLE AS total, sum(weight) OVER ()::BIGINT AS weights
      FROM r WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - clamped) / (weights - ahead) AS level FROM z),
g AS (SELECT *, (SELECT level FROM l WHERE level * weight <= 3.0::DOUBLE * source_size ORDER BY ratio, source NULLS LAST LIMIT 1) AS final FROM l),
t AS (SELECT source, source_size, CASE WHEN level * weight <= 3.0::DOUBLE * source_size THEN final * weight ELSE 3.0::DOUBLE * source_size END AS target FROM g),
a AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t),
x AS (SELECT d.*, a.source_size, a.target, floor(rate)::BIGINT AS whole, (rate - floor(rate)) * a.source_size AS rest
      FROM d JOIN a ON d.source IS NOT DISTINCT FROM a.source),
e AS (SELECT source, u, doc_id, size, rest, sum(size)::BIGINT AS words FROM x GROUP BY ALL),
c AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY u, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        + words / 2.0::DOUBLE AS middle FROM e)
SELECT x.doc_id, x.size, x.source_size, x.target,
  x.size * (x.whole + CASE WHEN c.middle <= c.rest AND c.rest > 0 THEN 1 ELSE 0 END) AS taken
FROM x JOIN c ON x.source IS NOT DISTINCT FROM c.source AND x.u = c.u AND x.doc_id IS NOT DISTINCT FROM c.doc_id AND x.size = c.size
"""


OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
w AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
t AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
v AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 3),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM v GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT lang, source, sum(t.n)::HUGEINT AS n FROM t SEMI JOIN v USING (lang, term) GROUP BY ALL),
x AS (SELECT g.lang, g.source, v.term, coalesce(t.n, 0) AS n, v.n AS all_n,
        1 + 1000000000::HUGEINT * (coalesce(t.n, 0) + 1) // (coalesce(s.n, 0) + l.v) AS p,
        1 + 1000000000::HUGEINT * (v.n + 1) // (l.n + l.v) AS q
      FROM g JOIN v USING (lang) JOIN l USING (lang) LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
      LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = v.term),
pv AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
       FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pr AS (SELECT a.lang, a.source, b.source AS item, coalesce(pv.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
tv AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM x WHERE n > 0 AND p > q),
u AS (SELECT lang, source, 'pair' AS part, item, value FROM pr UNION ALL SELECT lang, source, 'term', item, value FROM tv)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
WHERE part = 'pair' OR rank <= 200
"""


OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
t AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
        ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(u)::BIGINT AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_quality_rules": _op4(), "op10_source_mix": OP10, "op11_source_audit": OP11, "op13_fill_in_middle": OP13}
