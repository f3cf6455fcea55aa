"""Messages and their dimensions: readers, the export join, and views of the test tables as messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import is_blank

MESSAGES = T.StructType([
    T.StructField("message_id", T.LongType()), T.StructField("member_id", T.StringType()), T.StructField("channel_id", T.LongType()),
    T.StructField("content", T.StringType()), T.StructField("created_at", T.TimestampNTZType()), T.StructField("author_name", T.StringType()),
    T.StructField("user_name", T.StringType()), T.StructField("channel_name", T.StringType()), T.StructField("content_len", T.IntegerType()), T.StructField("is_empty", T.BooleanType()),
])


def require_columns(df: DataFrame, names) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **options: str) -> DataFrame:
    """A database table read in parallel by ranges of its key."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=lower, upperBound=upper, numPartitions=partitions, **options).load()


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGES).parquet(path)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """A label file, every cell a string; empty cells are null, the word none is a label."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return raw.select(*[F.when(F.trim(F.col(f"`{c}`")) == "", None).otherwise(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def enrich(messages: DataFrame, members: DataFrame, channels: DataFrame) -> DataFrame:
    """messages with author and channel names, length and blank flag. Names fall back to the user name, then the id, then "unknown".

    The joins are plain left joins: the planner broadcasts a dimension whose size allows it.
    """
    require_columns(messages, ["message_id", "member_id", "channel_id", "content", "created_at"])
    people = members.select(F.col("id").cast("string").alias("_m"), "display_name", "user_name")
    rooms = channels.select(F.col("id").alias("_c"), "channel_name")
    out = messages.join(people, F.col("member_id").cast("string") == F.col("_m"), "left").join(rooms, F.col("channel_id") == F.col("_c"), "left")
    content = F.coalesce("content", F.lit(""))
    return out.select(
        "message_id", F.col("member_id").cast("string").alias("member_id"), "channel_id", content.alias("content"), "created_at",
        F.coalesce("display_name", "user_name", F.col("member_id").cast("string"), F.lit("unknown")).alias("author_name"), "user_name",
        F.coalesce("channel_name", F.lit("unknown")).alias("channel_name"), F.length(content).alias("content_len"), is_blank(content).alias("is_empty"),
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _minutes(start: str, n: Column) -> Column:
    return F.expr(f"timestamp_ntz'{start}'") + F.make_dt_interval(mins=n.cast("int"))


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as messages; some blank ones and some without a channel, so that their rules are exercised."""
    c = table(spark, sf_dir, "conversations")
    blank = F.when(F.col("turn") % 7 == 2, "").when(F.col("turn") % 7 == 5, "\n").otherwise(F.col("text"))
    channel = F.when(F.col("conv_id") % 11 != 3, F.col("conv_id"))
    return c.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("message_id"), F.col("role").alias("member_id"), channel.alias("channel_id"), blank.alias("content"),
        _minutes("2024-01-01 00:00:00", F.col("turn")).alias("created_at"), F.col("role").alias("author_name"), F.coalesce(F.concat(F.lit("c"), (channel % 9).cast("string")), F.lit("unknown")).alias("channel_name"),
        F.length(blank).alias("content_len"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events as raw messages, with customers as members (some missing) and nations as channels."""
    e = table(spark, sf_dir, "events")
    channel = F.when(F.col("event_id") % 13 != 0, F.col("user_id") % 30)
    messages = e.select(F.col("event_id").alias("message_id"), F.col("user_id").alias("member_id"), channel.alias("channel_id"), F.when(F.col("event_id") % 17 != 0, F.col("props")).alias("content"), F.col("ts").alias("created_at"))
    members = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 == 1, F.col("c_name")).alias("display_name"), F.col("c_mktsegment").alias("user_name"))
    channels = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("channel_name"))
    return messages, members, channels


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as messages over several years."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("message_id"), F.concat(F.lit("member "), (F.col("o_custkey") % 40).cast("string")).alias("author_name"), F.col("o_orderpriority").alias("channel_name"),
        F.concat_ws(" ", F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderkey").cast("string")).alias("content"), F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
    )
