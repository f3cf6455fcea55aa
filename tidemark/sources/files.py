"""Tables and files at rest: messages, windows and samples as parquet, answer files as lines in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import windows as win
from tidemark.sources.messages import MESSAGES, require_columns


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, hint: str = "write it first", schema=None) -> DataFrame:
    """A parquet table, all of it or some columns. FileNotFoundError with the hint where nothing is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(f"nothing at {path}: {hint}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if columns is None else require_columns(df, columns).select(*columns)


def write_messages(messages: DataFrame, path: str) -> None:
    """Messages as parquet, in the column types of MESSAGES; what was there goes."""
    require_columns(messages, MESSAGES.names).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MESSAGES]).write.mode("overwrite").parquet(path)


def read_messages(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return read_table(spark, path, columns, "export the messages first", MESSAGES)


def write_windows(messages: DataFrame, path: str, context_size: int = 3, max_chars: int = 500) -> None:
    """The context windows of messages as parquet; what was there goes."""
    win.build_windows(messages, context_size, max_chars).write.mode("overwrite").parquet(path)


def read_windows(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return read_table(spark, path, columns, "build the windows first")


def write_sample(sample: DataFrame, folder: str, name: str) -> None:
    sample.write.mode("overwrite").parquet(f"{folder}/{name}")


def read_sample(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}", None, f"draw the sample {name} first")


def read_answers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, seq and value of each line of answer files. seq is a struct that orders the lines of a path; bytes that are no UTF-8 become U+FFFD."""
    lines = spark.read.text(paths).select(F.make_valid_utf8("value").alias("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    # a block of a file is read by one task from its start on, so ids of rows rise inside it
    return lines.select("path", F.struct("block", F.monotonically_increasing_id().alias("row")).alias("seq"), "value")
