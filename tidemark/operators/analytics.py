"""The aggregates behind the report. `scored` is messages joined with results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import display_name, is_blank
from tidemark.operators.packing import PRICES

#: Authors that the report leaves out, in lower case.
EXCLUDED = ("unknown", "bot", "system")


def scored(messages: DataFrame, results: DataFrame) -> DataFrame:
    r = results.withColumnRenamed("message_id", "_id")
    return messages.join(r, F.col("message_id").cast("string") == F.col("_id").cast("string")).drop("_id")


def _share(test):
    return F.avg(test.cast("double"))


def overview(s: DataFrame) -> DataFrame:
    return s.agg(F.count(F.lit(1)).alias("n"), F.avg("polarity_score").alias("avg_score"), _share(F.col("sarcasm")).alias("sarcasm_rate"))


def date_range(s: DataFrame) -> DataFrame:
    return s.agg(F.countDistinct("author_name").alias("members"), F.countDistinct("channel_name").alias("channels"), F.min("created_at").alias("mn"), F.max("created_at").alias("mx"))


def mix(s: DataFrame, column: str) -> DataFrame:
    return s.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def by_channel(s: DataFrame) -> DataFrame:
    p = F.col("polarity")
    return s.where("channel_name is not null").groupBy("channel_name").agg(F.count(F.lit(1)).alias("n"), F.avg("polarity_score").alias("avg_score"), _share(F.col("sarcasm")).alias("sarcasm_rate"), F.count_if(p == "positive").alias("pos"), F.count_if(p == "negative").alias("neg"))


def by_member(s: DataFrame, least: int = 200) -> DataFrame:
    p = F.col("polarity")
    out = s.where("author_name is not null").groupBy(F.col("author_name").alias("author")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("polarity_score").alias("avg_score"), _share(F.col("sarcasm")).alias("sarcasm_rate"),
        _share(F.col("toxicity") != "none").alias("tox_rate"), _share(p == "positive").alias("pos_rate"), _share(p == "negative").alias("neg_rate"),
    )
    return out.where(F.col("n") >= least)


def by_year(s: DataFrame) -> DataFrame:
    return s.groupBy(F.year("created_at").alias("yr")).agg(F.count(F.lit(1)).alias("n"), F.avg("polarity_score").alias("avg_score"))


def by_month(s: DataFrame, since: int) -> DataFrame:
    return s.where(F.year("created_at") >= since).groupBy(F.date_format("created_at", "yyyy-MM").alias("ym")).agg(F.avg("polarity_score").alias("avg_score"))


def member_compare(s: DataFrame, least: int = 500, excluded: tuple[str, ...] = EXCLUDED) -> DataFrame:
    """Lifetime against the last 365 days of each author, in one pass; the year's side is null for the inactive."""
    name = F.lower(F.trim(display_name(F.col("author_name"))))
    kept = s.where(F.col("author_name").isNotNull() & ~name.isin("", "nan", *excluded))
    last = s.agg(F.max("created_at").alias("_last"))  # one row
    recent = F.col("created_at") >= F.col("_last") - F.expr("INTERVAL 365 DAYS")
    out = kept.join(F.broadcast(last), F.lit(True)).groupBy(F.col("author_name").alias("author")).agg(
        F.count(F.lit(1)).alias("n_life"), F.avg("polarity_score").alias("life"), F.nullif(F.count_if(recent), F.lit(0)).alias("n_year"), F.avg(F.when(recent, F.col("polarity_score"))).alias("year"),
    )
    return out.where(F.col("n_life") >= least)


def sarcastic_top(s: DataFrame, n: int = 8) -> DataFrame:
    return s.where("sarcasm and channel_name is not null and author_name is not null and content is not null").orderBy(F.desc("confidence"), F.col("message_id").asc()).limit(n).select("message_id", "content", F.col("author_name").alias("author"), "channel_name", "rationale", "confidence")


def channel_extremes(s: DataFrame, least: int = 500) -> DataFrame:
    """One row: the channels of highest and lowest mean score and of most sarcasm among those with enough messages; ties go to the first name."""
    c = by_channel(s).where(F.col("n") >= least)
    top = lambda v: F.min_by("channel_name", F.struct(v.alias("v"), F.col("channel_name").alias("c")))
    return c.agg(top(-F.col("avg_score")).alias("chillest"), top(F.col("avg_score")).alias("saltiest"), top(-F.col("sarcasm_rate")).alias("most_sarcastic"))


def most_toxic_member(s: DataFrame, least: int = 500) -> DataFrame:
    """One row: the author with the largest share of messages that are not free of toxicity; ties go to the first name."""
    return by_member(s, least).agg(F.min_by(F.struct("author", "tox_rate"), F.struct(-F.col("tox_rate"), "author")).alias("m")).select("m.author", "m.tox_rate")


def messages_per_year(m: DataFrame) -> DataFrame:
    return m.groupBy(F.year("created_at").alias("year")).agg(F.count(F.lit(1)).alias("n"))


def corpus_profile(m: DataFrame) -> DataFrame:
    blank = is_blank(F.col("content"))
    return m.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(blank).alias("empty"), F.count_if(~blank).alias("scorable"), F.min("created_at").alias("mn"), F.max("created_at").alias("mx"),
        F.avg(F.when(~blank, F.col("content_len"))).alias("mean_length"), F.countDistinct("channel_id").alias("channels"), F.countDistinct("member_id").alias("members"),
    )


def length_histogram(m: DataFrame, most: int = 300, bins: int = 40) -> DataFrame:
    """Counts of lengths clipped at `most`; the last bin holds its right edge."""
    at = F.least(F.floor(F.least(F.col("content_len"), F.lit(most)) * bins / F.lit(most)), F.lit(bins - 1)).cast("long")
    return m.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def channel_counts(m: DataFrame, n: int = 15) -> DataFrame:
    return mix(m, "channel_name").orderBy(F.desc("n"), "channel_name").limit(n)


def usage(requests: DataFrame) -> DataFrame:
    """Totals of a request log and their price, live and batch; a missing or zero candidate count falls back to the response count."""
    out = F.coalesce(F.nullif("candidate_tokens", F.lit(0)), F.nullif("response_tokens", F.lit(0)), F.lit(0))
    t = requests.agg(F.count(F.lit(1)).alias("requests"), F.count_if("failed").alias("failures"), F.sum("input_tokens").alias("input_tokens"), F.sum(out).alias("output_tokens"))
    return t.withColumns({f"usd_{k}": (F.col("input_tokens") * F.lit(i) + F.col("output_tokens") * F.lit(o)) / F.lit(1e6) for k, (i, o) in PRICES.items()})
