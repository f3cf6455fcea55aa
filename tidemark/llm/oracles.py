"""SQL that checks numbered operators whose results SQL can express."""

from __future__ import annotations

from . import mixing, quality_rules

_WORD = r"[^\x20\x09-\x0D]+"


def _rules() -> str:
    bad = []
    for r in quality_rules.RULES:
        if r.least is not None:
            bad.append(f"{r.metric} < {r.least}")
        if r.most is not None:
            bad.append(f"{r.metric} > {r.most}")
    return " OR ".join(bad)


_STOP = ", ".join(f"'{x}'" for x in sorted(set(quality_rules.STOP_FORMS)))

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
c AS (SELECT doc_id, count(*) AS n_words, CAST(sum(length(w)) AS BIGINT) AS word_chars, count(*) FILTER (WHERE w IN ({_STOP})) AS n_stop FROM w GROUP BY 1),
g AS (SELECT doc_id, i, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, a, b, c FROM g WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
spots AS (SELECT g.doc_id, g.i FROM g JOIN twice USING (doc_id, a, b, c)),
cover AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM spots, (SELECT unnest([0, 1, 2]) AS k) GROUP BY 1),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '{_WORD}') GROUP BY 1),
m AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_stop, 0) AS n_stop, length(t) AS n_chars, length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS n_upper
  FROM d LEFT JOIN c USING (doc_id) LEFT JOIN cover USING (doc_id) LEFT JOIN lines USING (doc_id)),
r AS (SELECT *, coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars, coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols_per_word, coalesce(n_stop / nullif(n_words, 0), 0) AS stop_word_ratio,
  coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio, coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_word_ratio, coalesce(n_upper / nullif(n_chars, 0), 0) AS upper_char_ratio FROM m),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({_rules()}) AS kept FROM v
"""


def _cycle(values: tuple, at: str) -> str:
    return "CASE " + " ".join(f"WHEN {at} % {len(values)} = {i} THEN {v}" for i, v in enumerate(values)) + " END"


def _position(at: str) -> str:
    t = f"(CASE WHEN slope = 0 THEN {at} / target ELSE (slope - 1 + sqrt((1 - slope) * (1 - slope) + 4 * slope * ({at} / target))) / (2 * slope) END)"
    return f"CAST(floor({t} * (SELECT a FROM sums) + ({t} * {t} - {t}) * (SELECT b FROM sums)) AS BIGINT)"


MIX = rf"""
WITH z AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM z GROUP BY 1),
rk AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM src),
wt AS (SELECT source, source_size, {_cycle(mixing.WEIGHTS, 'k')} AS weight, CAST({_cycle(mixing.SLOPES, 'k')} AS DOUBLE) AS slope, {mixing.MOST_REPEATS} * source_size AS cap FROM rk),
lv AS (SELECT *, (CAST({mixing.BUDGET} AS DOUBLE) * (SELECT sum(source_size) FROM src) - coalesce(sum(cap) OVER o, 0)) / ((SELECT sum(weight) FROM wt) - coalesce(sum(weight) OVER o, 0)) AS level, row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source) AS place
  FROM wt WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT level FROM lv WHERE weight * level <= cap ORDER BY place LIMIT 1),
tg AS (SELECT wt.*, least(weight * level, CAST(cap AS DOUBLE)) AS target FROM wt, chosen),
sums AS (SELECT sum(target) AS a, sum(target * slope) AS b FROM tg),
o AS (SELECT z.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('{mixing.SEED}' || coalesce(CAST(doc_id AS VARCHAR), 'null')), size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM z),
j AS (SELECT o.*, source_size, target, slope, CAST(round(target) AS BIGINT) AS goal FROM o JOIN tg ON o.source IS NOT DISTINCT FROM tg.source),
p AS (SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS passes FROM j),
q AS (SELECT *, greatest(0, least(size, goal - passes * source_size - before)) AS part FROM p),
s AS (SELECT *, CAST(passes * size + part AS BIGINT) AS taken FROM q)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN {_position('before')} END AS first_position,
  CASE WHEN (passes = 1 AND part > 0) OR (passes = 2 AND size > 0) THEN {_position('(before + source_size)')} END AS second_position FROM s
"""

INFILL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
r AS (SELECT *, [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) FOR k IN [0, 1, 2, 3]] AS h4 FROM d),
e AS (SELECT *, least(h4[1] % (n + 1), h4[2] % (n + 1)) AS p, greatest(h4[1] % (n + 1), h4[2] % (n + 1)) AS q, CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h4[3] % 100 >= 90 THEN 'plain' WHEN h4[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
s AS (SELECT *, substr(t, 1, p) AS a, substr(t, p + 1, q - p) AS m, substr(t, q + 1) AS z FROM e)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(p AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(q - p AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM s
"""


def _levels(name: str, base: str, depth: int) -> str:
    """CTEs of a tree over base(g, pos, node, n): the levels name0 and on, the siblings left and right of each node in name_s0 and on. A lone node stays as it is."""
    out = [f"{name}0 AS ({base})"]
    for k in range(depth):
        out.append(f"{name}_s{k} AS (SELECT a.g, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r, a.n FROM {name}{k} a JOIN {name}{k} b ON a.g = b.g AND a.pos // 16 = b.pos // 16 GROUP BY a.g, a.pos, a.n)")
        out.append(f"{name}{k + 1} AS (SELECT g, pos // 16 AS pos, CASE WHEN n = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node, (n + 15) // 16 AS n FROM {name}{k} GROUP BY g, pos // 16, n)")
    return ",\n".join(out)


def _merkle(rows: int = 5, groups: int = 3) -> str:
    """For groups of 16 ** rows leaves and 16 ** groups groups pos most."""
    enc = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256({' || '.join(enc(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} || {enc(text)})"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ways = [(f"t_s{k}", f"w.pos // {16**k}", "w.g") for k in range(rows)] + [(f"u_s{k}", f"w.top // {16**k}", "'all'") for k in range(groups)]
    joins = "\n".join(f"JOIN {t} s{i} ON s{i}.g = {g} AND s{i}.pos = {pos}" for i, (t, pos, g) in enumerate(ways))
    steps = []
    for i in range(len(ways)):
        steps.append(f"f{i + 1} AS (SELECT * REPLACE (CASE WHEN n[{i + 1}] = 1 THEN cur ELSE sha256(l[{i + 1}] || cur || r[{i + 1}]) END AS cur) FROM f{i})")
    every = lambda c: "[" + ", ".join(f"s{i}.{c}" for i in range(len(ways))) + "]"
    return f"""
WITH bits AS (SELECT list(list_reduce(list_prepend(CAST(i AS UBIGINT), [CAST(0 AS UBIGINT) FOR k IN range(8)]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(CAST(3988292384 AS UBIGINT), x // 2) ELSE x // 2 END) ORDER BY i) AS t FROM range(256) AS b(i)),
crc AS (SELECT doc_id AS crc_id, xor(CAST(4294967295 AS UBIGINT), list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), [CAST(ascii(c) AS UBIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda x, y: xor(x // 256, t[CAST(xor(x % 256, y) AS BIGINT) + 1]))) AS crc FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), bits),
d AS (SELECT documents.doc_id, coalesce('s' || source, 'n') AS g, {leaf('text')} AS leaf, CASE WHEN crc % 5 = 0 THEN {leaf(f"translate(text, '{upper}', '{upper.lower()}')")} ELSE {leaf('text')} END AS claim FROM documents LEFT JOIN crc ON doc_id = crc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
{_levels('t', 'SELECT g, pos, leaf AS node, n FROM o', rows)},
{_levels('u', f"SELECT 'all' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, node, count(*) OVER () AS n FROM t{rows}", groups)},
tops AS (SELECT g, node AS subroot, row_number() OVER (ORDER BY g) - 1 AS top FROM t{rows}),
w AS (SELECT o.*, subroot, top FROM o JOIN tops USING (g)),
f0 AS (SELECT w.doc_id, w.leaf, w.subroot, w.claim AS cur, {every('l')} AS l, {every('r')} AS r, {every('n')} AS n FROM w
{joins}),
{", ".join(steps)}
SELECT doc_id, leaf, subroot, root, sha256(array_to_string([l[k] || r[k] FOR k IN range(1, len(l) + 1)], '')) AS proof_sha256, cur AS folded_root, cur = root AS verified FROM f{len(ways)}, (SELECT node AS root FROM u{groups})
"""


MERKLE = _merkle()
