"""Predictions against gold labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import strip, to_boolean


def _label(c: str):
    low = F.lower(strip(F.col(c).cast("string")))
    return F.when(~low.isin("", "nan"), low)


def _narrow(text: Column) -> Column:
    """true/false, yes/no, 1/0 in any case; null for anything else."""
    low = F.lower(strip(text))
    return F.when(low.isin("true", "1", "yes"), True).when(low.isin("false", "0", "no"), False)


def evaluate(predictions: DataFrame, gold: DataFrame, strict: bool = False) -> DataFrame:
    """One row: n_labeled, accuracies of polarity, sarcasm and toxicity, and the F1 of sarcasm; null where nothing is labelled.

    A sarcasm label that is no boolean is left out. With strict it counts, as in tables of old: as a miss of the accuracy unless the prediction is the same text, and
    in the F1 as true, or as false if it is empty; just true/false, yes/no and 1/0 are booleans then, and a missing label alone is left out.
    """
    p = predictions.select(F.col("message_id").cast("string").alias("id"), _label("polarity").alias("pp"), F.col("sarcasm").cast("string").alias("ps"), _label("toxicity").alias("pt"))
    g = gold.select(F.col("message_id").cast("string").alias("id"), _label("gold_polarity").alias("gp"), F.col("gold_sarcasm").cast("string").alias("gs"), _label("gold_toxicity").alias("gt"))
    both = g.join(p, "id").where("gp is not null")
    if strict:
        s, t, told = _narrow(F.col("gs")), _narrow(F.col("ps")), F.col("gs").isNotNull()
        same = F.when(s.isNotNull() & t.isNotNull(), s == t).when(s.isNull() & t.isNull(), F.coalesce(F.col("gs") == F.col("ps"), F.lit(False))).otherwise(F.lit(False))
        truth = lambda known, raw: F.coalesce(known, raw != "", F.lit(True))
        both = both.select("*", F.when(told, truth(s, F.col("gs"))).alias("s"), truth(t, F.col("ps")).alias("t"), F.when(told, same).alias("same"))
    else:
        both = both.select("*", to_boolean(F.col("gs")).alias("s"), F.coalesce(to_boolean(F.col("ps")), F.lit(False)).alias("t")).withColumn("same", F.col("s") == F.col("t"))
    hit = lambda a, b: F.avg(F.when(a.isNotNull(), (a == F.coalesce(b, F.lit(""))).cast("double")))
    s, t = F.col("s"), F.col("t")
    tp, wrong = F.count_if(s & t), F.count_if(s.isNotNull() & (s != t))
    return both.agg(
        F.count(F.lit(1)).alias("n_labeled"), hit(F.col("gp"), F.col("pp")).alias("polarity_accuracy"), F.avg(F.col("same").cast("double")).alias("sarcasm_accuracy"),
        F.when(F.count("s") > 0, F.when(2 * tp + wrong > 0, 2 * tp / (2 * tp + wrong)).otherwise(0.0)).alias("sarcasm_f1"), hit(F.col("gt"), F.col("pt")).alias("toxicity_accuracy"),
    )


def passes_bar(metrics: DataFrame, least: float = 0.75) -> DataFrame:
    """metrics with passes: whether the polarity accuracy reaches the bar; null where nothing is labelled."""
    return metrics.withColumn("passes", F.col("polarity_accuracy") >= least)


_REVIEWED = ("polarity", "polarity_score", "emotions", "sarcasm", "toxicity", "confidence", "rationale")


def review(sample: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every row of sample with its prediction, or nulls; ids are compared as text."""
    p = predictions.select(F.col("message_id").cast("string").alias("_id"), *_REVIEWED)
    return sample.join(p, F.col("message_id").cast("string") == F.col("_id"), "left").drop("_id")


def review_summary(reviewed: DataFrame) -> DataFrame:
    """field, label, n and share: labels of polarity, null included, of toxicity, null left out, and the rate of sarcasm over the rows that have it."""
    field = lambda c: reviewed.groupBy(F.col(c).alias("label")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("field"), "label", "n", F.lit(None).cast("double").alias("share"))
    rate = reviewed.agg(F.count("sarcasm").alias("n"), F.avg(F.col("sarcasm").cast("double")).alias("share")).select(F.lit("sarcasm").alias("field"), F.lit("true").alias("label"), "n", "share")
    return field("polarity").unionByName(field("toxicity").where("label is not null")).unionByName(rate)


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row on the messages that both scorers answered: how many, how often their labels agree, and the mean gap of their scores."""
    of = lambda df, k: df.select(F.col("message_id").cast("string").alias("id"), *[F.col(c).alias(f"{c}_{k}") for c in ("polarity", "polarity_score", "sarcasm", "toxicity")])
    both = of(a, "a").join(of(b, "b"), "id")
    same = lambda c: F.avg(F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")).cast("double")).alias(f"{c}_agreement")
    return both.agg(F.count(F.lit(1)).alias("n"), same("polarity"), same("sarcasm"), same("toxicity"), F.avg(F.abs(F.col("polarity_score_a") - F.col("polarity_score_b"))).alias("mean_gap"))


def write_gold_template(sample: DataFrame, path: str, n: int = 200) -> None:
    """gold_template as one CSV file with a header under path; n rows are one task."""
    gold_template(sample, n).coalesce(1).write.mode("overwrite").options(header=True, escape="\"", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def gold_template(sample: DataFrame, n: int = 200) -> DataFrame:
    """The first n rows by id with empty gold columns, ready for labelling."""
    base = [c for c in ("message_id", "channel_name", "author_name", "content", "context_text") if c in sample.columns]
    preds = [F.col(c).alias(f"pred_{c}") for c in ("polarity", "sarcasm", "toxicity") if c in sample.columns]
    return sample.orderBy("message_id").limit(n).select(*base, *preds, *[F.lit("").alias(f"gold_{c}") for c in ("polarity", "sarcasm", "toxicity")])
