"""Running sums over a shuffled order inside groups of any size, without one task for a group.

Rows are ordered by the hexadecimal digest in `order`. Its first SHARD_DIGITS digits split each
group into shards of even size; the sums of the shards are few (16 ** SHARD_DIGITS a group at most)
and are summed up first, then rows are summed inside their shard and offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_DIGITS = 3


def shuffled_by(seed: str, key: str) -> Column:
    """A digest that orders rows at random, the same in every run."""
    return F.md5(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("null"))))


def running_sum(df: DataFrame, group: str, order: str, value: str, into: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """df with `into`: the sum of `value` over the rows before, in the order of `order` and `ties` inside `group` (null is a group)."""
    df = df.withColumn("_shard", F.substring(order, 1, SHARD_DIGITS))
    shards = df.groupBy(F.col(group).alias("_g"), F.col("_shard").alias("_s")).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy("_g").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("_g", "_s", F.coalesce(F.sum("_sum").over(before), F.lit(0)).cast("long").alias("_offset"))
    inside = Window.partitionBy(group, "_shard").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    own = df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)).cast("long"))
    return own.join(shards, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_shard") == F.col("_s"))).withColumn(into, F.col("_offset") + F.col("_inside")).drop("_shard", "_g", "_s", "_sum", "_offset", "_inside")


def ranked(df: DataFrame, column: str, into: str) -> DataFrame:
    """df, whose `column` is distinct, with `into`: the row's number from 0 in ascending order, null last.

    Rows are dealt out by range; the counts of the ranges (one row a partition) give the offsets.
    """
    from .tables import stored

    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = stored(df.repartitionByRange(n, F.col(column).asc_nulls_last()).withColumn("_p", F.spark_partition_id()), "ranked")
    counts = {r["_p"]: r["n"] for r in dealt.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], 0
    for p in sorted(counts):
        offsets += [F.lit(p), F.lit(total)]
        total += counts[p]
    if not offsets:
        return df.withColumn(into, F.lit(0).cast("long"))
    w = Window.partitionBy("_p").orderBy(F.col(column).asc_nulls_last())
    return dealt.withColumn(into, (F.row_number().over(w) - 1 + F.create_map(*offsets)[F.col("_p")]).cast("long")).drop("_p")
