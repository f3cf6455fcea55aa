"""Mixing sources to target weights over a time-varying curriculum.

A source's weight at training time t in [0, 1] is target * (1 + g * (2t - 1)): it rises, stays or
falls with g. The integral over time is the words the mix has asked of the source by then,
target * (t + g * (t*t - t)), which is `target` at the end. A source's documents stand in a
seeded random order; the time at which the demand reaches a document, found by inverting that
integral, is when it is taken, and the demand of all sources at that time is its position.

Targets share a budget by weight; a target is at most MOST_REPEATS times its source's size, the
excess goes to the others by weight until none is above. Whole passes over a source are taken
first, then its documents in order until the target is met; the last one is taken in part.

Defined results: a null text has size 0; a null source is a source, ordered last; sources with size
0 have target 0; documents that are not taken have no position; repeated rows are separate documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import ranked, running_sum, shuffled_by
from .tables import stored, words

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_REPEATS = 2
#: Slopes g of the sources' weights, repeating like WEIGHTS.
SLOPES = (-0.5, 0.0, 0.5)
SEED = "mix"


def _cycle(values: tuple, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """(source, source_size, weight, slope, target) of sizes(source, size)."""
    sources = ranked(sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")), "source", "_rank")
    sources = stored(sources.select("source", "source_size", _cycle(weights, F.col("_rank")).alias("weight"), _cycle(SLOPES, F.col("_rank")).alias("slope")), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    cap, share = F.col("source_size") * MOST_REPEATS, F.lit(0.0)
    level, held = 0.0, -1
    while True:  # ends: the set of sources at their cap only grows
        over = F.col("weight") * F.lit(level) > cap
        row = sources.agg(F.coalesce(F.sum(F.when(over, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)), F.coalesce(F.sum(over.cast("int")), F.lit(0))).first()
        if row[2] == held or not row[1]:
            break
        held, level = row[2], (budget * total - row[0]) / row[1]
    share = F.least(F.col("weight") * F.lit(level), cap.cast("double"))
    return sources.withColumn("target", share)


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, first_position and second_position of each row, in order of position."""
    sizes = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("size")), "sizes")
    goal = targets(sizes, weights, budget)
    placed = running_sum(sizes.withColumn("_order", shuffled_by(SEED, "doc_id")), "source", "_order", "size", "_before", ties=("size",))
    goal = goal.withColumnRenamed("source", "_source").withColumn("_goal", F.round("target").cast("long"))
    total = goal.agg(F.sum("target"), F.sum(F.col("target") * F.col("slope"))).first()
    out = placed.join(goal, F.col("source").eqNullSafe(F.col("_source")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("_goal") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("_goal") - F.col("_passes") * F.col("source_size")
    out = out.withColumn("_passes", passes).withColumn("_part", F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before"))))
    out = out.withColumn("taken", (F.col("_passes") * F.col("size") + F.col("_part")).cast("long"))

    def position(at: Column) -> Column:
        y, g = at / F.col("target"), F.col("slope")
        t = F.when(g == 0, y).otherwise((g - 1 + F.sqrt((1 - g) * (1 - g) + 4 * g * y)) / (2 * g))
        return F.floor(t * F.lit(total[0] or 0.0) + (t * t - t) * F.lit(total[1] or 0.0)).cast("long")

    again = ((F.col("_passes") == 1) & (F.col("_part") > 0)) | ((F.col("_passes") == 2) & (F.col("size") > 0))
    out = out.withColumns({"first_position": F.when(F.col("taken") > 0, position(F.col("_before"))), "second_position": F.when(again, position(F.col("_before") + F.col("source_size")))})
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", "first_position", "second_position")


def in_order(mixed: DataFrame) -> DataFrame:
    """Rows dealt out by range of first position and sorted inside each range."""
    n = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartitionByRange(n, F.col("first_position").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("first_position").asc_nulls_last(), "doc_id")


def keep(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """The rows of docs that the mix takes, once for each time they are taken, in training order, with the columns of docs.

    A document that is taken in part stays whole. Rows that agree in doc_id share their decision.
    """
    plan = mix(docs, text, source, doc_id).where("taken > 0").select(F.col("doc_id").alias("_id"), F.col("source").alias("_src"), F.array_compact(F.array("first_position", "second_position")).alias("_at"))
    plan = plan.groupBy("_id", "_src").agg(F.max("_at").alias("_at"))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(doc_id).alias("_i"), F.col(source).alias("_s"))
    out = held.join(plan, F.col("_i").eqNullSafe(F.col("_id")) & F.col("_s").eqNullSafe(F.col("_src"))).select("_row", F.explode("_at").alias("_position"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartitionByRange(n, "_position").sortWithinPartitions("_position").select("_row.*")
