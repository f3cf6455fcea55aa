"""The SQL that checks the queries, for an engine that shares no code with them."""

from __future__ import annotations

from tidemark.functions.text import BLANKS
from tidemark.operators.packing import BATCH_SIZE, OUTPUT_TOKENS, SYSTEM

_WS = " || ".join(f"chr({ord(c)})" for c in BLANKS)
_STRIP = f"trim({{0}}, {_WS})"


def strip(x: str) -> str:
    return _STRIP.format(x)


def _cut(x: str, most: int) -> str:
    line = strip(f"replace({x}, chr(10), ' ')")
    return f"CASE WHEN length({line}) <= {most} THEN {line} ELSE substr({line}, 1, {most - 1}) || '…' END"


def _line(author: str, content: str) -> str:
    return f"'[' || {_cut(author, 40)} || '] ' || {_cut(content, 500)}"


def _double(source: str, text: str = "content") -> str:
    """The test double's labels of a relation."""
    d = lambda k: f"ascii(substr(md5(coalesce({text}, '')), {k}, 1))"
    pick = lambda names, k: "(CASE " + " ".join(f"WHEN {d(k)} % {len(names)} = {i} THEN '{n}'" for i, n in enumerate(names)) + " END)"
    from tidemark.operators.scoring import DIRECTED_AT, EMOTIONS, POLARITY, TOXICITY

    a, b = pick(EMOTIONS, 3), pick(EMOTIONS, 4)
    return f"""SELECT CAST(message_id AS VARCHAR) AS message_id, {pick(POLARITY, 1)} AS polarity, ({d(2)} - 75) / CAST(27 AS DOUBLE) AS polarity_score,
    CASE WHEN {a} = {b} THEN {a} ELSE {a} || ',' || {b} END AS emotions, {d(5)} % 4 = 0 AS sarcasm, {pick(TOXICITY, 6)} AS toxicity, {pick(DIRECTED_AT, 7)} AS directed_at,
    ({d(8)} - 48) / CAST(54 AS DOUBLE) AS confidence, 'digest ' || substr(md5(coalesce({text}, '')), 1, 6) AS rationale FROM {source}"""


_CONV = """conv AS (SELECT message_id, role AS member_id, channel_id, content, created_at, role AS author_name, coalesce('c' || CAST(channel_id % 9 AS VARCHAR), 'unknown') AS channel_name, CAST(length(content) AS INTEGER) AS content_len
FROM (SELECT conv_id * 1000 + turn AS message_id, role, CASE WHEN conv_id % 11 <> 3 THEN conv_id END AS channel_id, CASE WHEN turn % 7 = 2 THEN '' WHEN turn % 7 = 5 THEN chr(10) ELSE text END AS content, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(turn AS BIGINT)) AS created_at FROM conversations))"""

_LAGS = ", ".join(f"CASE WHEN channel_id IS NOT NULL THEN lag({c}, {i}) OVER w END AS {c[0]}{i}" for i in (1, 2, 3) for c in ("author_name", "content"))
_PRIOR = {i: f"CASE WHEN a{i} IS NOT NULL AND {strip(f'coalesce(c{i}, {chr(39)}{chr(39)})')} <> '' THEN {_line(f'a{i}', strip(f'c{i}'))} END" for i in (1, 2, 3)}
_WIN = f"""{_CONV}, lagged AS (SELECT *, {_LAGS} FROM conv WINDOW w AS (PARTITION BY channel_id ORDER BY created_at, message_id)),
win AS (SELECT message_id, member_id, channel_id, channel_name, author_name, content, created_at, content_len,
  concat_ws(chr(10), {_PRIOR[3]}, {_PRIOR[2]}, {_PRIOR[1]}, '>>> TARGET ' || {_line('author_name', 'content')}) AS context_text,
  CAST(({_PRIOR[1]}) IS NOT NULL AS INTEGER) + CAST(({_PRIOR[2]}) IS NOT NULL AS INTEGER) + CAST(({_PRIOR[3]}) IS NOT NULL AS INTEGER) AS n_priors,
  CAST(year(created_at) AS INTEGER) AS year, CASE WHEN content_len <= 20 THEN 'short' WHEN content_len <= 100 THEN 'medium' WHEN content_len <= 10000 THEN 'long' ELSE 'nan' END AS length_bucket
  FROM lagged WHERE {strip('content')} <> '')"""
_PACK = f"""{_WIN}, pack AS (SELECT *, row_number() OVER (ORDER BY channel_id NULLS LAST, created_at, message_id) - 1 AS ordinal FROM win),
packed AS (SELECT *, ordinal // {BATCH_SIZE} AS batch_id, ordinal % {BATCH_SIZE} AS position FROM pack)"""
_PROMPT = f"""{_PACK}, batches AS (SELECT batch_id, 'batch-' || CAST(arg_min(message_id, position) AS VARCHAR) AS key, CAST(count(*) AS INTEGER) AS size,
 'Label ' || CAST(count(*) AS VARCHAR) || ' message(s) as {{"results": [...]}}.' || chr(10) || chr(10) || string_agg('### ' || CAST(position + 1 AS VARCHAR) || chr(10) || 'id: ' || CAST(message_id AS VARCHAR) || chr(10) || 'channel: #' || channel_name || chr(10) || context_text || chr(10), chr(10) ORDER BY position) AS prompt FROM packed GROUP BY batch_id),
priced AS (SELECT *, CAST(greatest(1, length(prompt) // 4) AS BIGINT) AS prompt_tokens FROM batches)"""
_BEFORE = f"before AS ({_double('conv WHERE message_id % 3 <> 0')})"
_TODO = f"{_CONV}, {_BEFORE}, todo AS (SELECT * FROM conv WHERE {strip('content')} <> '' AND CAST(message_id AS VARCHAR) NOT IN (SELECT message_id FROM before))"
_ORDERS = f"""ord AS (SELECT o_orderkey AS message_id, 'member ' || CAST(o_custkey % 40 AS VARCHAR) AS author_name, o_orderpriority AS channel_name, concat_ws(' ', o_orderstatus, o_orderpriority, CAST(o_orderkey AS VARCHAR)) AS content, o_orderdate AS created_at FROM orders),
dbl AS ({_double('ord')}), s AS (SELECT ord.*, polarity, polarity_score, emotions, sarcasm, toxicity, directed_at, confidence, rationale FROM ord JOIN dbl ON CAST(ord.message_id AS VARCHAR) = dbl.message_id)"""
_RATE = lambda test: f"round(avg(CAST(({test}) AS INTEGER)), 9)"
_RESERVED = f"""{_WIN}, drawn AS (SELECT *, md5('42' || CAST(message_id AS VARCHAR)) AS draw FROM win), res AS (SELECT *, row_number() OVER (PARTITION BY channel_name ORDER BY draw, message_id) <= 5 AS reserved FROM drawn),
pool AS (SELECT channel_name, year, length_bucket, count(*) AS size FROM res WHERE NOT reserved GROUP BY ALL), k AS (SELECT greatest(0, 200 - count(*) FILTER (WHERE reserved)) AS slots FROM res),
al AS (SELECT pool.*, slots, CAST(round_even(CAST(size AS DOUBLE) / (SELECT sum(size) FROM pool) * slots, 0) AS BIGINT) AS a FROM pool, k),
dr AS (SELECT max(slots) - sum(a) AS drift FROM al), rk AS (SELECT al.*, drift, row_number() OVER (ORDER BY size DESC, channel_name, year, length_bucket) AS rk FROM al, dr),
alloc AS (SELECT channel_name, year, length_bucket, size, CAST(greatest(0, least(size, a + CASE WHEN rk <= abs(drift) THEN sign(drift) ELSE 0 END)) AS BIGINT) AS alloc FROM rk)"""
_STATUS = f"""{_CONV}, dbl AS ({_double('conv')}), st AS (SELECT *, CAST(message_id AS BIGINT) AS seq FROM dbl), lines AS (SELECT *, CASE WHEN seq % 37 = 0 THEN 'blank' WHEN seq % 41 = 0 THEN 'bad_json' WHEN seq % 43 = 0 THEN 'error' WHEN seq % 47 = 0 THEN 'no_text' WHEN seq % 53 = 0 THEN 'bad_payload' WHEN seq % 29 = 0 OR seq % 31 = 0 THEN 'invalid' ELSE 'ok' END AS status FROM st)"""

ORACLES = {
    "context_windows": f"WITH {_WIN} SELECT * FROM win",
    "messages_enriched": f"""WITH m AS (SELECT event_id AS message_id, user_id AS member_id, CASE WHEN event_id % 13 <> 0 THEN user_id % 30 END AS channel_id, CASE WHEN event_id % 17 <> 0 THEN props END AS content, ts AS created_at FROM events),
mem AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 1 THEN c_name END AS display_name, c_mktsegment AS user_name FROM customer WHERE c_custkey % 3 <> 0)
SELECT message_id, CAST(member_id AS VARCHAR) AS member_id, channel_id, coalesce(content, '') AS content, created_at, coalesce(display_name, user_name, CAST(member_id AS VARCHAR), 'unknown') AS author_name, user_name, coalesce(n_name, 'unknown') AS channel_name, CAST(length(coalesce(content, '')) AS INTEGER) AS content_len, coalesce(content, '') = '' AS is_empty
FROM m LEFT JOIN mem ON member_id = id LEFT JOIN nation ON channel_id = n_nationkey""",
    "unscored_anti": f"WITH {_TODO} SELECT message_id, channel_id, content_len FROM todo",
    "history_semi": f"WITH {_TODO}, t AS (SELECT * FROM todo) SELECT message_id, channel_id FROM conv WHERE channel_id IN (SELECT channel_id FROM t WHERE channel_id IS NOT NULL) OR (channel_id IS NULL AND message_id IN (SELECT message_id FROM t))",
    "nightly_targets": f"WITH {_WIN}, {_BEFORE} SELECT message_id, n_priors, context_text FROM win WHERE CAST(message_id AS VARCHAR) NOT IN (SELECT message_id FROM before)",
    "batch_packing": f"WITH {_PACK} SELECT message_id, ordinal, batch_id, position FROM packed",
    "batch_prompts": f"WITH {_PROMPT} SELECT batch_id, key, size, prompt_tokens, md5(prompt) AS prompt_md5 FROM priced",
    "chunk_assignment": f"WITH {_PACK} SELECT batch_id // 10 + 1 AS chunk_id, count(DISTINCT batch_id) AS lines, count(*) AS messages FROM packed GROUP BY 1",
    "cost_estimate": f"WITH {_PROMPT}, one AS (SELECT CAST(coalesce(sum(size), 0) AS BIGINT) AS n_messages, count(*) AS n_batches, CAST(coalesce(sum(prompt_tokens), 0) AS BIGINT) AS user_tokens FROM priced) SELECT *, user_tokens + {len(SYSTEM) // 4} * n_batches AS input_tokens, n_messages * {OUTPUT_TOKENS} AS output_tokens, CASE WHEN n_batches > 0 THEN user_tokens / n_batches ELSE 0 END AS mean_batch_tokens, CAST(round((user_tokens + {len(SYSTEM) // 4} * n_batches) * CAST(0.25 AS DOUBLE) + n_messages * {OUTPUT_TOKENS} * CAST(1.5 AS DOUBLE)) AS BIGINT) AS usd_live, CAST(round((user_tokens + {len(SYSTEM) // 4} * n_batches) * CAST(0.125 AS DOUBLE) + n_messages * {OUTPUT_TOKENS} * CAST(0.75 AS DOUBLE)) AS BIGINT) AS usd_batch FROM one",
    "cost_gate": f"WITH {_PROMPT}, u AS (SELECT (sum(prompt_tokens) + {len(SYSTEM) // 4} * count(*)) * CAST(0.25 AS DOUBLE) + sum(size) * {OUTPUT_TOKENS} * CAST(1.5 AS DOUBLE) AS micro FROM priced) SELECT CAST(round(micro) AS BIGINT) AS micro_usd, 0.05 * 1000000 / micro <= 2 AS passes FROM u",
    "stratified_allocation": f"WITH {_RESERVED} SELECT * FROM alloc",
    "stratified_sample": f"""WITH {_RESERVED}, pl AS (SELECT res.*, row_number() OVER (PARTITION BY reserved, channel_name, year, length_bucket ORDER BY draw, message_id) AS place FROM res),
tn AS (SELECT pl.*, CASE WHEN reserved THEN 0 WHEN place <= coalesce(alloc, 0) THEN 1 ELSE 2 END AS turn FROM pl LEFT JOIN alloc USING (channel_name, year, length_bucket))
SELECT message_id, channel_name, length_bucket FROM tn ORDER BY turn, draw, message_id LIMIT 200""",
    "parse_results": f"WITH {_STATUS} SELECT message_id, polarity, polarity_score, emotions, sarcasm, toxicity, directed_at, confidence, rationale FROM lines WHERE status = 'ok'",
    "parse_error_summary": f"WITH {_STATUS} SELECT status, count(*) AS n FROM lines GROUP BY status",
    "validate_results": f"WITH {_STATUS} SELECT seq, status FROM lines",
    "dedupe_keep_last": f"WITH {_CONV} SELECT CAST(message_id AS VARCHAR) AS message_id, 2 AS seq, 'mixed' AS polarity FROM conv",
    "upsert_merge": f"""WITH {_CONV}, dbl AS ({_double('conv')}), n AS (SELECT CAST(message_id AS BIGINT) AS id, polarity FROM dbl)
SELECT id AS message_id, polarity, CASE WHEN id % 2 = 0 AND id % 7 <> 0 THEN 'm2' ELSE 'm1' END AS model, CASE WHEN id % 3 <> 0 THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-03-01' END AS scored_at, CASE WHEN id % 2 = 0 AND id % 7 <> 0 THEN TIMESTAMP '2024-03-01' ELSE TIMESTAMP '2024-02-01' END AS updated_at
FROM n WHERE id % 3 <> 0 OR (id % 2 = 0 AND id % 7 <> 0)""",
    "fk_guard": f"WITH {_CONV} SELECT count(*) FILTER (WHERE message_id % 7 <> 0) AS written, count(*) FILTER (WHERE message_id % 7 = 0) AS skipped FROM conv",
    "coverage": f"WITH {_WIN} SELECT count(*) AS n_windows, count(*) FILTER (WHERE message_id % 3 <> 0) AS n_scored, count(*) FILTER (WHERE message_id % 3 = 0) AS n_missing FROM win",
    "corpus_profile": f"WITH {_CONV}, b AS (SELECT *, {strip('content')} = '' AS blank FROM conv) SELECT count(*) AS total, count(*) FILTER (WHERE blank) AS empty, count(*) FILTER (WHERE NOT blank) AS scorable, min(created_at) AS mn, max(created_at) AS mx, avg(content_len) FILTER (WHERE NOT blank) AS mean_length, count(DISTINCT channel_id) AS channels, count(DISTINCT member_id) AS members FROM b",
    "length_histogram": f"WITH {_CONV} SELECT least(least(content_len, 300) * 40 // 300, 39) AS bin, count(*) AS n FROM conv GROUP BY 1",
    "channel_counts": f"WITH {_CONV} SELECT channel_name, count(*) AS n FROM conv GROUP BY 1 ORDER BY n DESC, channel_name LIMIT 15",
    "overview": f"WITH {_ORDERS} SELECT count(*) AS n, round(avg(polarity_score), 9) AS avg_score, {_RATE('sarcasm')} AS sarcasm_rate FROM s",
    "date_range": f"WITH {_ORDERS} SELECT count(DISTINCT author_name) AS members, count(DISTINCT channel_name) AS channels, min(created_at) AS mn, max(created_at) AS mx FROM s",
    "polarity_mix": f"WITH {_ORDERS} SELECT polarity, count(*) AS n FROM s GROUP BY 1",
    "toxicity_mix": f"WITH {_ORDERS} SELECT toxicity, count(*) AS n FROM s GROUP BY 1",
    "by_channel": f"WITH {_ORDERS} SELECT channel_name, count(*) AS n, round(avg(polarity_score), 9) AS avg_score, {_RATE('sarcasm')} AS sarcasm_rate, count(*) FILTER (WHERE polarity = 'positive') AS pos, count(*) FILTER (WHERE polarity = 'negative') AS neg FROM s GROUP BY 1",
    "by_member": f"WITH {_ORDERS} SELECT author_name AS author, count(*) AS n, round(avg(polarity_score), 9) AS avg_score, {_RATE('sarcasm')} AS sarcasm_rate, {_RATE(chr(39).join(['toxicity <> ', 'none', '']))} AS tox_rate, {_RATE(chr(39).join(['polarity = ', 'positive', '']))} AS pos_rate, {_RATE(chr(39).join(['polarity = ', 'negative', '']))} AS neg_rate FROM s GROUP BY 1 HAVING count(*) >= 200",
    "by_year": f"WITH {_ORDERS} SELECT CAST(year(created_at) AS INTEGER) AS yr, count(*) AS n, round(avg(polarity_score), 9) AS avg_score FROM s GROUP BY 1",
    "by_month": f"WITH {_ORDERS} SELECT strftime(created_at, '%Y-%m') AS ym, round(avg(polarity_score), 9) AS avg_score FROM s WHERE year(created_at) >= 1999 GROUP BY 1",
    "member_compare": f"WITH {_ORDERS}, l AS (SELECT max(created_at) - INTERVAL 365 DAY AS c FROM s) SELECT author_name AS author, count(*) AS n_life, round(avg(polarity_score), 9) AS life, nullif(count(*) FILTER (WHERE created_at >= c), 0) AS n_year, round(avg(polarity_score) FILTER (WHERE created_at >= c), 9) AS year FROM s, l GROUP BY 1 HAVING count(*) >= 100",
    "sarcastic_top": f"WITH {_ORDERS} SELECT message_id, author_name AS author, channel_name, rationale FROM s WHERE sarcasm ORDER BY confidence DESC, message_id LIMIT 8",
    "channel_extremes": f"""WITH {_ORDERS}, c AS (SELECT channel_name, avg(polarity_score) AS a, avg(CAST(sarcasm AS INTEGER)) AS r FROM s GROUP BY 1 HAVING count(*) >= 100)
SELECT (SELECT channel_name FROM c ORDER BY a DESC, 1 LIMIT 1) AS chillest, (SELECT channel_name FROM c ORDER BY a, 1 LIMIT 1) AS saltiest, (SELECT channel_name FROM c ORDER BY r DESC, 1 LIMIT 1) AS most_sarcastic""",
    "gold_template": f"WITH {_WIN} SELECT message_id, channel_name, author_name, '' AS gold_polarity, '' AS gold_sarcasm, '' AS gold_toxicity FROM win ORDER BY message_id LIMIT 50",
    "eval_metrics": f"""WITH d AS (SELECT doc_id AS message_id, text AS content FROM documents), p AS ({_double('d')}),
g AS (SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS gp, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE quality <> 1 END AS gs, CASE WHEN doc_id % 4 = 0 THEN NULL WHEN toxic = 1 THEN 'severe' ELSE 'none' END AS gt FROM labels WHERE doc_id % 10 <> 0),
b AS (SELECT g.*, p.polarity AS pp, p.sarcasm AS ps, p.toxicity AS pt FROM g JOIN p ON g.id = p.message_id),
n AS (SELECT count(*) FILTER (WHERE gs AND ps) AS tp, count(*) FILTER (WHERE gs IS NOT NULL AND gs <> ps) AS w FROM b)
SELECT count(*) AS n_labeled, round(avg(CAST(gp = pp AS INTEGER)), 9) AS polarity_accuracy, round(avg(CAST(gs = ps AS INTEGER)), 9) AS sarcasm_accuracy, (SELECT round(CAST(2 * tp AS DOUBLE) / (2 * tp + w), 9) FROM n) AS sarcasm_f1, round(avg(CAST(gt = pt AS INTEGER)), 9) AS toxicity_accuracy FROM b""",
    "usage_rollup": "SELECT *, CAST(round(input_tokens * CAST(0.25 AS DOUBLE) + output_tokens * CAST(1.5 AS DOUBLE)) AS BIGINT) AS usd_live, CAST(round(input_tokens * CAST(0.125 AS DOUBLE) + output_tokens * CAST(0.75 AS DOUBLE)) AS BIGINT) AS usd_batch FROM (SELECT count(*) AS requests, count(*) FILTER (WHERE event_id % 19 = 0) AS failures, CAST(sum(event_id % 1000) AS BIGINT) AS input_tokens, CAST(sum(coalesce(nullif(CASE WHEN event_id % 3 <> 0 THEN event_id % 50 END, 0), nullif(event_id % 70, 0), 0)) AS BIGINT) AS output_tokens FROM events)",
    "seeded_sample": f"WITH {_WIN} SELECT message_id FROM win ORDER BY md5('7' || CAST(message_id AS VARCHAR)), message_id LIMIT 100",
    "pending_windows": f"WITH {_WIN} SELECT message_id FROM win WHERE message_id % 3 = 0 AND message_id % 5 <> 0",
    "review_join": f"WITH {_WIN}, {_BEFORE} SELECT win.message_id, channel_name, polarity, sarcasm, toxicity FROM win LEFT JOIN before ON CAST(win.message_id AS VARCHAR) = before.message_id",
    "review_summary": f"""WITH {_WIN}, {_BEFORE}, r AS (SELECT polarity, sarcasm, toxicity FROM win LEFT JOIN before ON CAST(win.message_id AS VARCHAR) = before.message_id)
SELECT 'polarity' AS field, polarity AS label, count(*) AS n, CAST(NULL AS DOUBLE) AS share FROM r GROUP BY 2 UNION ALL SELECT 'toxicity', toxicity, count(*), NULL FROM r WHERE toxicity IS NOT NULL GROUP BY 2
UNION ALL SELECT 'sarcasm', 'true', count(sarcasm), round(avg(CAST(sarcasm AS INTEGER)), 9) FROM r""",
    "model_compare": f"""WITH {_CONV}, a AS ({_double('conv')}), b AS ({_double('conv', "content || '!'")})
SELECT count(*) AS n, {_RATE('a.polarity = b.polarity')} AS polarity_agreement, {_RATE('a.sarcasm = b.sarcasm')} AS sarcasm_agreement, {_RATE('a.toxicity = b.toxicity')} AS toxicity_agreement, round(avg(abs(a.polarity_score - b.polarity_score)), 9) AS mean_gap FROM a JOIN b USING (message_id)""",
    "messages_per_year": "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1",
    "most_toxic_member": f"WITH {_ORDERS}, m AS (SELECT author_name AS author, avg(CAST(toxicity <> 'none' AS INTEGER)) AS r FROM s GROUP BY 1 HAVING count(*) >= 100) SELECT first(author ORDER BY r DESC, author) AS author, round(max(r), 9) AS tox_rate FROM m",
    "result_count": f"WITH {_CONV} SELECT count(*) AS n FROM conv WHERE message_id % 3 <> 0",
    "scored_ids": f"WITH {_CONV} SELECT CAST(message_id AS VARCHAR) AS message_id FROM conv",
    "finished_jobs": "SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CAST(o_orderdate AS TIMESTAMP) AS create_time FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '1995-01-01'",
    "upsert_spellings": f"""WITH {_CONV}, dbl AS ({_double('conv')}), n AS (SELECT CAST(message_id AS BIGINT) AS id, polarity FROM dbl)
SELECT id AS message_id, CASE WHEN id % 4 = 0 THEN 'mixed' ELSE polarity END AS polarity, 'm2' AS model, CASE WHEN id % 3 <> 0 THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-03-01' END AS scored_at, TIMESTAMP '2024-03-01' AS updated_at FROM n""",
    "results_store": f"""WITH {_CONV}, dbl AS ({_double('conv')}), n AS (SELECT CAST(message_id AS BIGINT) AS id, polarity FROM dbl)
SELECT id AS message_id, CASE WHEN id % 7 <> 0 AND id % 4 = 0 THEN 'mixed' ELSE polarity END AS polarity, CASE WHEN id % 7 <> 0 THEN 'm2' ELSE 'm1' END AS model, CASE WHEN id % 3 <> 0 THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-03-01' END AS scored_at, CASE WHEN id % 7 <> 0 THEN TIMESTAMP '2024-03-01' ELSE TIMESTAMP '2024-02-01' END AS updated_at
FROM n WHERE id % 3 <> 0 OR id % 7 <> 0""",
    "incremental_windows": f"WITH {_WIN} SELECT message_id, n_priors, context_text, length_bucket FROM win",
    "eval_metrics_strict": f"""WITH d AS (SELECT doc_id AS message_id, text AS content FROM documents), p AS ({_double('d')}),
g AS (SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS gp, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE quality <> 1 END AS gs, CASE WHEN doc_id % 4 = 0 THEN NULL WHEN toxic = 1 THEN 'severe' ELSE 'none' END AS gt FROM labels WHERE doc_id % 10 <> 0),
b AS (SELECT g.*, coalesce(gs, true) AS yt, p.polarity AS pp, p.sarcasm AS ps, p.toxicity AS pt FROM g JOIN p ON g.id = p.message_id),
n AS (SELECT count(*) FILTER (WHERE yt AND ps) AS tp, count(*) FILTER (WHERE ps AND NOT yt) AS fp, count(*) FILTER (WHERE yt AND NOT ps) AS fn FROM b),
r AS (SELECT CAST(tp AS DOUBLE) / (tp + fp) AS pr, CAST(tp AS DOUBLE) / (tp + fn) AS rc FROM n)
SELECT count(*) AS n_labeled, round(avg(CAST(gp = pp AS INTEGER)), 9) AS polarity_accuracy, round(avg(CASE WHEN gs = ps THEN 1 ELSE 0 END), 9) AS sarcasm_accuracy, (SELECT round(2 * pr * rc / (pr + rc), 9) FROM r) AS sarcasm_f1, round(avg(CAST(gt = pt AS INTEGER)), 9) AS toxicity_accuracy FROM b""",
    "dedupe_appends": f"""WITH {_CONV}, dbl AS ({_double('conv')}), r AS (SELECT *, CAST(message_id AS BIGINT) AS n FROM dbl), a AS (
SELECT message_id, 1 AS seq, 5 AS position, polarity FROM r UNION ALL SELECT message_id, 2, 5, 'mixed' FROM r WHERE n % 2 = 0 UNION ALL SELECT message_id, 3, 1, 'first' FROM r WHERE n % 3 = 0 UNION ALL SELECT message_id, 3, 2, 'second' FROM r WHERE n % 9 = 0)
SELECT message_id, seq, position, polarity FROM a QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY seq DESC, position DESC) = 1""",
    "recovered_results": f"WITH {_STATUS} SELECT seq AS message_id, polarity, sarcasm, CASE WHEN seq % 4 = 1 THEN replace(rationale, 'digest ', 'later ') ELSE rationale END AS rationale, 'late' AS model, TIMESTAMP '2024-03-01' AS scored_at FROM lines WHERE status = 'ok'",
}
