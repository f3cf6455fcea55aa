"""Reproducible stratified samples of exact size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranges import how_many, ordinals

STRATUM = ("channel_name", "year", "length_bucket")


def draw_order(seed: str):
    return F.md5(F.concat(F.lit(seed), F.col("message_id").cast("string")))


def seeded_sample(windows: DataFrame, n: int, seed: str = "42") -> DataFrame:
    """min(n, rows) rows without replacement, the same for the same ids and seed however the rows are dealt out."""
    return windows.withColumn("_draw", draw_order(seed)).orderBy("_draw", "message_id").limit(n).drop("_draw")


def _leaders(windows: DataFrame, most: int, floor: int, seed: str) -> DataFrame:
    """The first `most` + `floor` rows of each stratum in drawing order, with reserved: whether a row is among the first `floor` of its channel.

    A row that is reserved in its channel is among the first `floor` of its stratum, and a row that is drawn has `floor` reserved and `most` drawn rows of its stratum before it at most,
    so these rows are all that a sample of `most` can hold. Every task cuts its strata to that many rows before they are shuffled, so a hot stratum or channel sends few.
    """
    by = lambda *c: Window.partitionBy(*c).orderBy("_draw", "message_id")
    drawn = windows.withColumn("_draw", draw_order(seed)).withColumn("_first", F.row_number().over(by(*STRATUM))).where(F.col("_first") <= most + floor).drop("_first")
    return drawn.withColumn("reserved", F.row_number().over(by("channel_name")) <= floor)


def _allocated(windows: DataFrame, leaders: DataFrame, n: int) -> DataFrame:
    # strata are compared null-safe: counts of all rows less the reserved ones
    held = leaders.where("reserved").groupBy(*STRATUM).agg((-F.count(F.lit(1))).alias("size"))
    every = windows.groupBy(*STRATUM).agg(F.count(F.lit(1)).alias("size"))
    pool = every.unionByName(held).groupBy(*STRATUM).agg(F.sum("size").alias("size")).where("size > 0")
    kept = leaders.agg(F.coalesce(F.sum(F.col("reserved").cast("long")), F.lit(0)).alias("kept"))
    total = pool.agg(F.sum("size").alias("total"))
    slots = F.greatest(F.lit(0), F.lit(n) - F.col("kept"))
    # the two one-row tables are joined by a broadcast of one row
    rounded = pool.join(F.broadcast(kept), F.lit(True)).join(F.broadcast(total), F.lit(True)).select(*STRATUM, "size", slots.alias("slots"), F.bround(F.col("size") / F.col("total") * slots, 0).cast("long").alias("_alloc"))
    drift = rounded.agg((F.max("slots") - F.sum("_alloc")).alias("drift"))
    # null strata are last, as the ranks of the largest first ask for
    places = [-F.col("size")] + [x for c in STRATUM for x in (F.col(c).isNull(), F.col(c))]
    out = ordinals(rounded.join(F.broadcast(drift), F.lit(True)), places, "_rank", how_many(windows))
    step = F.when(F.col("_rank") < F.abs("drift"), F.signum("drift").cast("long")).otherwise(F.lit(0))
    return out.select(*STRATUM, "size", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_alloc") + step)).cast("long").alias("alloc"))


def allocation(windows: DataFrame, n: int = 1000, floor: int = 15, seed: str = "42") -> DataFrame:
    """Size and share of each stratum of the rows that no channel has reserved: half-even rounding, its drift settled from the largest stratum on, within 0 and the size."""
    return _allocated(windows, _leaders(windows, n, floor, seed), n)


def stratified_sample(windows: DataFrame, n: int = 1000, floor: int = 15, seed: str = "42") -> DataFrame:
    """min(n, rows) rows of windows: each channel's reserve, then each stratum's share, then the next rows in drawing order."""
    rows = _leaders(windows, n, floor, seed)
    share = _allocated(windows, rows, n).select(*[F.col(c).alias(f"_{c}") for c in STRATUM], "alloc")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in STRATUM]
    place = F.row_number().over(Window.partitionBy("reserved", *STRATUM).orderBy("_draw", "message_id"))
    rows = rows.withColumn("_place", place).join(share, same[0] & same[1] & same[2], "left")
    turn = F.when(F.col("reserved"), 0).when(F.col("_place") <= F.coalesce("alloc", F.lit(0)), 1).otherwise(2)
    return rows.withColumn("_turn", turn).orderBy("_turn", "_draw", "message_id").limit(n).select(*windows.columns)
