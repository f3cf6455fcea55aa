"""Queries on the test tables for each operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import analytics, evaluate, packing, sampling, scoring, store, windows
from tidemark.sources import messages as src
from tidemark.sources import keyed
from tidemark.sources.shared import scratch
from tidemark.streaming import incremental, jobs


def _conv(spark: SparkSession, d: str) -> DataFrame:
    return src.conversation_messages(spark, d)


def _scored_before(spark: SparkSession, d: str) -> DataFrame:
    """Result rows of the test double for two thirds of the turns."""
    return scoring.doubled(_conv(spark, d).where("message_id % 3 <> 0"))


def _series(spark: SparkSession, d: str) -> DataFrame:
    m = src.order_messages(spark, d)
    return analytics.scored(m, scoring.doubled(m))


def context_windows(spark, d):
    return windows.build_windows(_conv(spark, d))


def messages_enriched(spark, d):
    return src.enrich(*src.event_messages(spark, d))


def unscored_anti(spark, d):
    return windows.unscored(_conv(spark, d), _scored_before(spark, d)).select("message_id", "channel_id", "content_len")


def history_semi(spark, d):
    m = _conv(spark, d)
    return windows.history(m, windows.unscored(m, _scored_before(spark, d))).select("message_id", "channel_id")


def nightly_targets(spark, d):
    return windows.nightly_targets(_conv(spark, d), _scored_before(spark, d)).select("message_id", "n_priors", "context_text")


def batch_packing(spark, d):
    return packing.packed(windows.build_windows(_conv(spark, d))).select("message_id", "ordinal", "batch_id", "position")


def batch_prompts(spark, d):
    return packing.prompts(packing.packed(windows.build_windows(_conv(spark, d)))).select("batch_id", "key", "size", "prompt_tokens", F.md5("prompt").alias("prompt_md5"))


def chunk_assignment(spark, d):
    p = packing.packed(windows.build_windows(_conv(spark, d)), lines_per_chunk=10)
    return p.groupBy("chunk_id").agg(F.countDistinct("batch_id").alias("lines"), F.count(F.lit(1)).alias("messages"))


def _micro(df: DataFrame) -> DataFrame:
    """Prices as whole millionths of a dollar."""
    return df.withColumns({c: F.round(F.col(c) * 1e6).cast("long") for c in ("usd_live", "usd_batch")})


def cost_estimate(spark, d):
    return packing.cost(packing.prompts(packing.packed(windows.build_windows(_conv(spark, d))))).transform(_micro)


def cost_gate(spark, d):
    gate = packing.cost_gate(packing.cost(packing.prompts(packing.packed(windows.build_windows(_conv(spark, d))))), 0.05)
    return gate.select(F.round(F.col("usd_live") * 1e6).cast("long").alias("micro_usd"), "passes")


def seeded_sample(spark, d):
    return sampling.seeded_sample(windows.build_windows(_conv(spark, d)), 100, "7").select("message_id")


def pending_windows(spark, d):
    m = _conv(spark, d)
    checkpoint = scoring.doubled(m.where("message_id % 5 = 0"))
    return windows.pending(windows.build_windows(m), _scored_before(spark, d), checkpoint).select("message_id")


def review_join(spark, d):
    return evaluate.review(windows.build_windows(_conv(spark, d)), _scored_before(spark, d)).select("message_id", "channel_name", "polarity", "sarcasm", "toxicity")


def review_summary(spark, d):
    return _rounded(evaluate.review_summary(evaluate.review(windows.build_windows(_conv(spark, d)), _scored_before(spark, d))), "share")


def model_compare(spark, d):
    """Two scorers, of which the second sees a mark after each text."""
    m = _conv(spark, d)
    both = evaluate.compare(scoring.doubled(m), scoring.doubled(m.withColumn("content", F.concat("content", F.lit("!")))))
    return _rounded(both, "polarity_agreement", "sarcasm_agreement", "toxicity_agreement", "mean_gap")


def messages_per_year(spark, d):
    return analytics.messages_per_year(src.order_messages(spark, d))


def most_toxic_member(spark, d):
    return _rounded(analytics.most_toxic_member(_series(spark, d), 100), "tox_rate")


def result_count(spark, d):
    return store.row_count(_scored_before(spark, d))


def scored_ids(spark, d):
    return store.scored_ids(_appended(spark, d), spark)


def finished_jobs(spark, d):
    """Orders as jobs: those that succeeded since a day."""
    o = src.table(spark, d, "orders")
    listed = o.select(F.col("o_orderkey").cast("string").alias("job_id"), F.when(F.col("o_orderstatus") == "F", "succeeded").when(F.col("o_orderstatus") == "O", "running").otherwise("failed").alias("state"), F.col("o_orderdate").cast("timestamp_ntz").alias("create_time"), F.lit("").alias("path"))
    return jobs.finished(listed, "1995-01-01 00:00:00").select("job_id", "create_time")


def stratified_allocation(spark, d):
    return sampling.allocation(windows.build_windows(_conv(spark, d)), 200, 5).select(*sampling.STRATUM, "size", "alloc")


def stratified_sample(spark, d):
    return sampling.stratified_sample(windows.build_windows(_conv(spark, d)), 200, 5).select("message_id", "channel_name", "length_bucket")


def _answers(spark, d) -> DataFrame:
    """Answer lines of the test double, with one line of each kind of fault."""
    r = scoring.doubled(_conv(spark, d))
    seq = F.col("message_id").cast("long")
    row = F.struct(
        "message_id", F.when(seq % 29 == 0, "POSITIVE").otherwise(F.col("polarity")).alias("polarity"), F.when(seq % 31 == 0, "1.5").otherwise(F.col("polarity_score").cast("string")).alias("polarity_score"),
        F.split("emotions", ",").alias("emotions"), F.col("sarcasm").cast("string").alias("sarcasm"), "toxicity", "directed_at", F.col("confidence").cast("string").alias("confidence"), "rationale",
    )
    text = F.to_json(F.struct(F.array(row).alias("results")))
    inner = F.struct(F.array(F.struct(F.struct(F.array(F.struct(text.alias("text"))).alias("parts")).alias("content"))).alias("candidates"))
    line = F.when(seq % 37 == 0, "").when(seq % 41 == 0, "{broken").when(seq % 43 == 0, '{"error":{"code":500}}').when(seq % 47 == 0, '{"response":{}}').when(seq % 53 == 0, '{"response":{"text":"no json"}}')
    return r.select(seq.alias("seq"), line.otherwise(F.to_json(F.struct(inner.alias("response")))).alias("value"))


def parse_results(spark, d):
    rows = scoring.result_rows(scoring.parse_lines(_answers(spark, d)))
    return rows.select("message_id", "polarity", "polarity_score", "emotions", "sarcasm", "toxicity", "directed_at", "confidence", "rationale")


def parse_error_summary(spark, d):
    return analytics.mix(scoring.parse_lines(_answers(spark, d)), "status")


def validate_results(spark, d):
    return scoring.parse_lines(_answers(spark, d)).select("seq", "status")


def _appended(spark, d) -> DataFrame:
    r = scoring.doubled(_conv(spark, d))
    first = r.where("cast(message_id as long) % 2 = 0").withColumns({"seq": F.lit(1), "position": F.lit(0)})
    return first.unionByName(r.withColumns({"seq": F.lit(2), "position": (F.col("message_id").cast("long") % 2).cast("int"), "polarity": F.lit("mixed")}))


def dedupe_keep_last(spark, d):
    return store.keep_last(_appended(spark, d)).select("message_id", "seq", "polarity")


def dedupe_appends(spark, d):
    """Three appends, the last with ids twice in it: the last row of each id in append order."""
    r = scoring.doubled(_conv(spark, d)).withColumns({"seq": F.lit(1), "position": F.lit(5)})
    n = F.col("message_id").cast("long")
    later = r.where(n % 2 == 0).withColumns({"seq": F.lit(2), "polarity": F.lit("mixed")})
    last = r.where(n % 3 == 0).withColumns({"seq": F.lit(3), "position": F.lit(1), "polarity": F.lit("first")}).unionByName(r.where(n % 9 == 0).withColumns({"seq": F.lit(3), "position": F.lit(2), "polarity": F.lit("second")}))
    return store.keep_last(last.unionByName(later).unionByName(r)).select("message_id", "seq", "position", "polarity")


def recovered_results(spark, d):
    """The results table after the recovery of two finished jobs, one in a folder of the other, of which the later one answers some messages again."""
    m, base = _conv(spark, d), scratch(spark, "recovery")
    lines, folder = _answers(spark, d), f"{base}/a job's answers"
    again = F.replace(F.col("value"), F.lit("digest "), F.lit("later "))
    lines.select("value").write.text(folder)
    lines.where("seq % 4 = 1").select(again.alias("value")).write.text(f"{folder}/50% more")
    listed = spark.createDataFrame([("one", "succeeded", folder, "2024-02-01 00:00:00"), ("two", "succeeded", f"{folder}/50% more", "2024-02-02 00:00:00"), ("three", "failed", "none", "2024-02-03 00:00:00")], "job_id string, state string, path string, at string")
    jobs.recover(listed.select("job_id", "state", F.col("at").cast("timestamp_ntz").alias("create_time"), "path"), m, f"{base}/results", "late", "2024-03-01 00:00:00")
    return keyed.read(spark, f"{base}/results").table().select("message_id", "polarity", "sarcasm", "rationale", "model", "scored_at")


def upsert_merge(spark, d):
    m = _conv(spark, d)
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    old = store.normalised(scoring.doubled(m.where("message_id % 3 <> 0")), "m1").withColumns({"scored_at": at, "updated_at": at})
    new = store.normalised(scoring.doubled(m.where("message_id % 2 = 0")), "m2")
    known = m.where("message_id % 7 <> 0")
    return store.upserted(old, new, known, "2024-03-01 00:00:00").select("message_id", "polarity", "model", "scored_at", "updated_at")


def fk_guard(spark, d):
    m = _conv(spark, d)
    return store.guard(scoring.doubled(m), m.where("message_id % 7 <> 0"))


def coverage(spark, d):
    return store.coverage(windows.build_windows(_conv(spark, d)), _scored_before(spark, d))


def corpus_profile(spark, d):
    return analytics.corpus_profile(_conv(spark, d))


def length_histogram(spark, d):
    return analytics.length_histogram(_conv(spark, d))


def channel_counts(spark, d):
    return analytics.channel_counts(_conv(spark, d))


def overview(spark, d):
    o = analytics.overview(_series(spark, d))
    return o.select("n", F.round("avg_score", 9).alias("avg_score"), F.round("sarcasm_rate", 9).alias("sarcasm_rate"))


def date_range(spark, d):
    return analytics.date_range(_series(spark, d))


def polarity_mix(spark, d):
    return analytics.mix(_series(spark, d), "polarity")


def toxicity_mix(spark, d):
    return analytics.mix(_series(spark, d), "toxicity")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in names})


def by_channel(spark, d):
    return _rounded(analytics.by_channel(_series(spark, d)), "avg_score", "sarcasm_rate")


def by_member(spark, d):
    return _rounded(analytics.by_member(_series(spark, d)), "avg_score", "sarcasm_rate", "tox_rate", "pos_rate", "neg_rate")


def by_year(spark, d):
    return _rounded(analytics.by_year(_series(spark, d)), "avg_score")


def by_month(spark, d):
    return _rounded(analytics.by_month(_series(spark, d), 1999), "avg_score")


def member_compare(spark, d):
    return _rounded(analytics.member_compare(_series(spark, d), 100), "life", "year")


def sarcastic_top(spark, d):
    return analytics.sarcastic_top(_series(spark, d)).select("message_id", "author", "channel_name", "rationale")


def channel_extremes(spark, d):
    return analytics.channel_extremes(_series(spark, d), 100)


def gold_template(spark, d):
    return evaluate.gold_template(windows.build_windows(_conv(spark, d)), 50).select("message_id", "channel_name", "author_name", "gold_polarity", "gold_sarcasm", "gold_toxicity")


def _gold(spark, d) -> tuple[DataFrame, DataFrame]:
    """Labels as gold, in the odd forms that hand-made files have."""
    docs = src.table(spark, d, "documents").select(F.col("doc_id").alias("message_id"), F.col("text").alias("content"))
    gold = src.table(spark, d, "labels").select(
        F.col("doc_id").alias("message_id"), F.when(F.col("doc_id") % 10 == 0, "").when(F.col("quality") == 1, " Positive").otherwise("NEGATIVE").alias("gold_polarity"),
        F.when(F.col("doc_id") % 6 == 0, "maybe").when(F.col("quality") == 1, "No").otherwise("TRUE").alias("gold_sarcasm"), F.when(F.col("doc_id") % 4 == 0, None).when(F.col("toxic") == 1, "severe").otherwise("None").alias("gold_toxicity"),
    )
    return scoring.doubled(docs), gold


def eval_metrics(spark, d):
    return _rounded(evaluate.evaluate(*_gold(spark, d)), "polarity_accuracy", "sarcasm_accuracy", "sarcasm_f1", "toxicity_accuracy")


def eval_metrics_strict(spark, d):
    """The same with labels that are no booleans counted as of old."""
    return _rounded(evaluate.evaluate(*_gold(spark, d), strict=True), "polarity_accuracy", "sarcasm_accuracy", "sarcasm_f1", "toxicity_accuracy")


def usage_rollup(spark, d):
    e = src.table(spark, d, "events")
    log = e.select((F.col("event_id") % 19 == 0).alias("failed"), (F.col("event_id") % 1000).alias("input_tokens"), F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 50).alias("candidate_tokens"), (F.col("event_id") % 70).alias("response_tokens"))
    return _micro(analytics.usage(log))


def _spelled(spark, d) -> DataFrame:
    """Answers in append order: each id as it is, and those of every fourth message again, spelled with zeros before."""
    r = scoring.doubled(_conv(spark, d))
    first = r.withColumns({"seq": F.lit(0), "position": F.lit(0)})
    again = r.where("cast(message_id as long) % 4 = 0").withColumns({"message_id": F.concat(F.lit("00"), "message_id"), "polarity": F.lit("Mixed"), "seq": F.lit(1), "position": F.lit(0)})
    return again.unionByName(first)


def upsert_spellings(spark, d):
    """One row an id, of the last answer, however its number is spelled, over rows that were there."""
    m, at = _conv(spark, d), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    old = store.normalised(scoring.doubled(m.where("message_id % 3 <> 0")), "m1").withColumns({"scored_at": at, "updated_at": at})
    return store.upserted(old, store.latest(_spelled(spark, d), "m2"), m, "2024-03-01 00:00:00").select("message_id", "polarity", "model", "scored_at", "updated_at")


def results_store(spark, d):
    """The results table after two upserts into its buckets, read by the last commit."""
    m, base = _conv(spark, d), scratch(spark, "results")
    store.upsert(spark, base, store.normalised(scoring.doubled(m.where("message_id % 3 <> 0")), "m1"), m, "2024-02-01 00:00:00", 8)
    store.upsert(spark, base, store.latest(_spelled(spark, d), "m2"), m.where("message_id % 7 <> 0"), "2024-03-01 00:00:00")
    return keyed.read(spark, base).bucketed().select("message_id", "polarity", "model", "scored_at", "updated_at")


def incremental_windows(spark, d):
    """The windows of messages that came in two batches, the second built from the tails of the first."""
    m, base = _conv(spark, d), scratch(spark, "nightly")
    early = F.col("created_at") < F.lit("2024-01-01 00:04:00").cast("timestamp_ntz")
    incremental.take_in(m.where(early), base, 0, buckets=8)
    incremental.take_in(m.where(~early), base, 1)
    return keyed.read(spark, f"{base}/pending").table().select("message_id", "n_priors", "context_text", "length_bucket")


QUERIES = {f.__name__: f for f in (
    context_windows, messages_enriched, unscored_anti, history_semi, nightly_targets, batch_packing, batch_prompts, chunk_assignment, cost_estimate, cost_gate, stratified_allocation, stratified_sample,
    parse_results, parse_error_summary, validate_results, dedupe_keep_last, upsert_merge, fk_guard, coverage, corpus_profile, length_histogram, channel_counts, overview, date_range, polarity_mix, toxicity_mix,
    by_channel, by_member, by_year, by_month, member_compare, sarcastic_top, channel_extremes, gold_template, eval_metrics, usage_rollup,
    seeded_sample, pending_windows, review_join, review_summary, model_compare, messages_per_year, most_toxic_member, result_count, scored_ids, finished_jobs,
    upsert_spellings, results_store, incremental_windows, eval_metrics_strict, dedupe_appends, recovered_results,
)}
