"""Results at rest: deduplication, keyed upsert, versioned tables, checkpoints, coverage."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources import keyed
from tidemark.sources.keyed import file_system

VALUES = ("polarity", "polarity_score", "emotions", "sarcasm", "toxicity", "directed_at", "confidence", "rationale")
#: A stored result: what an answer says, who said it and when. `create` makes a table of it.
STORED = "message_id long, polarity string, polarity_score double, emotions string, sarcasm boolean, toxicity string, directed_at string, confidence double, rationale string, model string, scored_at timestamp_ntz, updated_at timestamp_ntz"


class DuplicateKeys(ValueError):
    """Two rows of one upsert have the same message_id."""


def create(spark: SparkSession, base: str, buckets: int = keyed.BUCKETS) -> keyed.Version:
    """The results table at base, made if it is not there; a table without buckets is dealt into buckets."""
    found = keyed.create(spark, base, StructType.fromDDL(STORED), "message_id", buckets)
    return found if found.plain is None else keyed.rebucket(spark, base, "message_id", buckets)


def keep_last(rows: DataFrame, key: str = "message_id", order: tuple[str, ...] = ("seq", "position")) -> DataFrame:
    """The last row of each key in append order."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def normalised(results: DataFrame, model: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Results as stored: ids that are 64-bit numbers, lower-case labels, rationales of 255 characters at most; the columns of order stay.

    Several spellings of a number are one id, so rows are deduplicated after this, not before: see `latest`.
    """
    ok = F.col("message_id").rlike("^[0-9]{1,20}$")
    rows = results.withColumn("_id", F.when(ok, F.col("message_id").try_cast("bigint"))).where("_id is not null")
    low = lambda c: F.lower(F.trim(c)).alias(c)
    return rows.select(F.col("_id").alias("message_id"), low("polarity"), "polarity_score", "emotions", "sarcasm", low("toxicity"), low("directed_at"), "confidence", F.substring("rationale", 1, 255).alias("rationale"), F.lit(model).alias("model"), *order)


def latest(results: DataFrame, model: str, order: tuple[str, ...] = ("seq", "position")) -> DataFrame:
    """Results as stored, the last of each id in append order, however its number is spelled."""
    return keep_last(normalised(results, model, order), order=order).drop(*order)


def merged(old: DataFrame, new: DataFrame, now: str) -> DataFrame:
    """old with new written over it by message_id: values and updated_at change, scored_at stays. One join; raises where new has an id twice."""
    at = F.lit(now).cast("timestamp_ntz")
    twice = F.count(F.lit(1)).over(Window.partitionBy("message_id")) > 1
    said = F.concat(F.lit("two new rows have message_id "), F.col("message_id").cast("string"))
    fresh = new.select("message_id", *[F.col(c).alias(f"_{c}") for c in (*VALUES, "model")], F.when(twice, F.raise_error(said).cast("boolean")).otherwise(F.lit(True)).alias("_new"))
    both = old.join(fresh, "message_id", "full")
    values = [F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in (*VALUES, "model")]
    return both.select("message_id", *values, F.coalesce("scored_at", at).alias("scored_at"), F.when(F.col("_new"), at).otherwise(F.col("updated_at")).alias("updated_at"))


def _ids(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("message_id").cast("long").alias("message_id")).distinct()


def upserted(old: DataFrame, new: DataFrame, messages: DataFrame, now: str) -> DataFrame:
    """`merged`, of the new rows that have a message; the others are left out."""
    return merged(old, new.join(_ids(messages), "message_id", "left_semi"), now)


def guard(new: DataFrame, messages: DataFrame) -> DataFrame:
    """One row: how many rows of new an upsert writes, and how many it skips for want of a message."""
    known = _ids(messages).withColumn("hit", F.lit(1))
    return new.select(F.col("message_id").cast("long").alias("message_id")).join(known, "message_id", "left").agg(F.count("hit").alias("written"), F.count_if(F.col("hit").isNull()).alias("skipped"))


def upsert(spark: SparkSession, base: str, new: DataFrame, messages: DataFrame, now: str, buckets: int = keyed.BUCKETS, attempts: int = 20) -> dict[str, int]:
    """Writes new over the results table at base, which is made if it is not there, and tells how many rows were written and skipped.

    new is computed once, into a folder of its own; then the buckets that it touches are read, merged and written, and a commit names them with the other
    buckets as they are. A writer that finds another one's commit in the place of its own reads anew and merges again, so no row of either is lost.
    DuplicateKeys if new has an id twice: nothing is written then.
    """
    n = create(spark, base, buckets).buckets
    known = new.join(_ids(messages).withColumn("_known", F.lit(True)), "message_id", "left")
    staged = keyed.stage(known.withColumn("_known", F.coalesce("_known", F.lit(False))), base, "message_id", n)
    try:
        rows = staged.bucketed().groupBy("message_id").agg(F.count(F.lit(1)).alias("n"), F.max("_known").alias("known"))
        told = rows.agg(F.count_if("known").alias("written"), F.count_if(~F.col("known")).alias("skipped"), F.max("n").alias("most")).first()
        if (told["most"] or 0) > 1:
            raise DuplicateKeys(f"{base}: an id stands in {told['most']} new rows")
        if told["written"]:
            keyed.replace_buckets(base, staged, lambda old, rows: merged(old, rows.where("_known"), now), attempts=attempts)
    finally:
        staged.forget()
        keyed.drop_folders(spark, base, staged.parts)
    return {"written": told["written"], "skipped": told["skipped"]}


def scored_ids(results: DataFrame | None, spark: SparkSession) -> DataFrame:
    """The ids that have a result, as text; none where there is no table yet. They are a side of an anti-join and stay on the executors."""
    if results is None:
        return spark.createDataFrame([], "message_id string")
    return results.select(F.col("message_id").cast("string").alias("message_id")).distinct()


def row_count(results: DataFrame) -> DataFrame:
    return results.agg(F.count(F.lit(1)).alias("n"))


_fs = file_system


def _commits(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the commit files, the highest first."""
    return keyed.commits(spark, base)


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    """The version of the highest commit, or None. A commit without a name is one whose writer died; the one before it holds."""
    return keyed.read(spark, base).table()


def write_version(table: DataFrame, base: str, after: int | None = None) -> str:
    """Writes a whole table, without buckets, as the version after number `after`, the one that it was made from, and returns its folder's name; nothing is ever deleted, so readers see the old or the new version.

    Of two writers that started from one version, the second gets keyed.Conflict and has changed nothing. Without `after` the table replaces whatever is there.
    """
    spark, name = table.sparkSession, f"version-{uuid.uuid4().hex}"
    found = keyed.read(spark, base)
    table.write.parquet(f"{base}/{name}")
    try:
        keyed.commit(found if after is None else replace(found, number=after), f"{name}\n")
    except keyed.Conflict:
        keyed.drop_folders(spark, base, [(0, name)])
        raise
    return name


def append_checkpoint(results: DataFrame, base: str, chunk: int) -> None:
    """One immutable folder a chunk; a chunk that is written again is replaced as a whole."""
    results.withColumn("seq", F.lit(chunk).cast("long")).write.mode("overwrite").parquet(f"{base}/chunk={chunk:06d}")


def read_checkpoint(spark: SparkSession, base: str) -> DataFrame:
    return keep_last(spark.read.parquet(base), order=("seq", "position"))


def finalize(spark: SparkSession, base: str, path: str) -> int:
    """The checkpoint's last row of each id, written as one table; how many. FileNotFoundError where there is no checkpoint."""
    fs, folder = file_system(spark, base)
    if not fs.exists(folder):
        raise FileNotFoundError(f"no checkpoint at {base}: score some chunks first")
    read_checkpoint(spark, base).drop("seq", "position", "chunk").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).count()


def coverage(windows: DataFrame, results: DataFrame) -> DataFrame:
    """One row: windows, those with a result, and those without."""
    ids = windows.select(F.col("message_id").cast("string").alias("id")).distinct()
    done = results.select(F.col("message_id").cast("string").alias("id")).distinct().withColumn("hit", F.lit(1))
    n = ids.join(done, "id", "left").agg(F.count(F.lit(1)).alias("n_windows"), F.count("hit").alias("n_scored"))
    return n.withColumn("n_missing", F.col("n_windows") - F.col("n_scored"))
