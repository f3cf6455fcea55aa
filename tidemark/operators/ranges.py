"""Splitting a total order into ranges of about as many rows each, so that work in order is dealt to many tasks.

The bounds are keys of rows, taken at even distances from a sample of SAMPLE keys a range. The sample is the keys of smallest hash, so it is the same however often and wherever
it is drawn, and no action runs when a frame is built: the bounds are a table of one row that is broadcast, of `ranges` keys at most. Where the bounds
lie changes how evenly tasks are loaded, never a result. Rows that agree in the whole key stay in one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Input of a range by the planner's estimate, and keys of the sample a range.
RANGE_BYTES, SAMPLE = 64 << 20, 32


def how_many(df: DataFrame, ranges: int | None = None) -> int:
    """Ranges for df: as given, or one for each RANGE_BYTES of the planner's estimate, four times the shuffle partitions at most."""
    if ranges is not None:
        return max(1, ranges)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, min(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES)))


def bounds(df: DataFrame, key: Column, ranges: int) -> DataFrame:
    """One row: `_bounds`, ascending keys that part df into `ranges` ranges at most."""
    drawn = df.select(key.alias("k")).orderBy(F.xxhash64("k"), "k").limit(SAMPLE * ranges)
    keys = drawn.agg(F.sort_array(F.collect_list("k")).alias("all"))
    at = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("all", F.floor(i * F.size("all") / ranges).cast("int")))
    return keys.select(F.array_distinct(F.filter(at, lambda k: k.isNotNull())).alias("_bounds"))


def place(key: Column, ranges: int) -> Column:
    """How many of the column _bounds are at most key, by halving."""
    steps = [1 << b for b in range(max(1, ranges).bit_length(), -1, -1)]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda n, s: F.when(F.get("_bounds", n + s - 1) <= key, n + s).otherwise(n))


def order_key(order: Sequence[Column]) -> Column:
    """A struct that sorts like the columns: each ascending, null first."""
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])


def dealt(df: DataFrame, order: Sequence[Column], ranges: int) -> DataFrame:
    """df with _range, the place of its rows in the order, and _bounds."""
    key = order_key(order)
    return df.join(F.broadcast(bounds(df, key, ranges)), F.lit(True)).withColumn("_range", place(key, ranges))  # one row is joined


def ordinals(df: DataFrame, order: Sequence[Column], into: str, ranges: int | None = None) -> DataFrame:
    """df with `into`, each row's number from 0 in the order: rows are numbered inside their range, which starts at the sum of the counts of the ranges before it.

    df is computed up to three times if it is large; write it first where that costs much. Rows that agree in the whole order get any of their numbers.
    """
    n = how_many(df, ranges)
    if n == 1:
        return df.withColumn("_range", F.lit(0)).withColumn(into, (F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1).cast("long")).drop("_range")
    rows = dealt(df, order, n).drop("_bounds")
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = rows.groupBy(F.col("_range").alias("_r")).agg(F.count(F.lit(1)).alias("_n")).select("_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    placed = rows.withColumn("_inside", inside).join(F.broadcast(starts), F.col("_range") == F.col("_r"))
    return placed.withColumn(into, (F.col("_start") + F.col("_inside")).cast("long")).drop("_range", "_r", "_start", "_inside")
