"""A scoring run in chunks that survives a crash: what was asked, what was answered and what was checkpointed are tables of the run.

A run has a name and a folder. Its windows are packed once; then chunk after chunk is asked, its answers are written, parsed and checkpointed. A second run of the name goes on where the
first one stopped: chunks that are whole are not touched, answers that are there are not asked for again, and batches that failed are. Every attempt is a row of the request log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import analytics, packing, scoring, store
from tidemark.sources.keyed import file_system, write_text
from tidemark.streaming.nightly import written

#: Batches that are asked between two checkpoints.
EVERY = 100


class ScoringFailed(RuntimeError):
    """A batch has failed in a run that stops at failures. What was answered before, in its chunk as well, is checkpointed."""


def run(
    windows: DataFrame, base: str, name: str, scorer: scoring.Scorer, every: int = EVERY, batch_size: int = packing.BATCH_SIZE, on_failure: str = "continue", resume: bool = True,
    attempts: int = 3, pause: Callable[[int], float] | None = scoring.linear(),
) -> dict[str, int | float]:
    """Scores windows under base/name, `every` batches a chunk, and tells chunks, batches, failed_batches and rows of the whole run, and the usage of all its requests.

    on_failure: "continue" counts a failed batch and goes on; "raise" stops after its chunk with ScoringFailed. Without resume the run begins anew, and what it had goes.
    A chunk is one job; the driver holds one row a chunk.
    """
    if on_failure not in ("continue", "raise"):
        raise ValueError("on_failure is continue or raise")
    spark, home = windows.sparkSession, f"{base}/{name}"
    if not resume:
        fs, p = file_system(spark, home)
        fs.delete(p, True)
    asked_path = f"{home}/asked"
    if not written(spark, asked_path):
        packing.packed(windows, batch_size, every).write.mode("overwrite").partitionBy("chunk_id").parquet(asked_path)
    asked = _asked(spark, home)
    failed = 0
    chunks = [r["chunk_id"] for r in asked.select("chunk_id").distinct().orderBy("chunk_id").collect()]
    for chunk in chunks:
        done = f"{home}/done/chunk={chunk:06d}"
        if written(spark, done):
            continue
        mine = asked.where(F.col("chunk_id") == chunk)
        whole, batches = _chunk(spark, home, chunk, mine, scorer, attempts, pause)
        short = batches.join(whole.select(F.col("seq").alias("batch_id")).distinct(), "batch_id", "left_anti").join(_answers(spark, home, chunk), "key", "left")
        told = short.agg(F.countDistinct("key").alias("n"), F.min_by(F.coalesce("error", F.lit("the answer is not valid")), "batch_id").alias("first")).first()
        failed += told["n"]
        if not told["n"]:
            write_text(spark, f"{done}/_SUCCESS", "")
        elif on_failure == "raise":
            raise ScoringFailed(f"chunk {chunk} of {name}: {told['n']} batches failed, the first with {told['first']}")
    counts = asked.agg(F.countDistinct("batch_id").alias("batches")).first()
    rows = results(spark, base, name).count() if chunks else 0
    return {"chunks": len(chunks), "batches": counts["batches"], "failed_batches": failed, "rows": rows, **usage(spark, base, name).first().asDict()}


def _asked(spark: SparkSession, home: str) -> DataFrame:
    fs, p = file_system(spark, f"{home}/asked")
    if not any(s.getPath().getName().startswith("chunk_id=") for s in fs.listStatus(p)):  # no windows, no files
        return spark.createDataFrame([], "chunk_id long, batch_id long, position long, message_id long, channel_name string, context_text string")
    return spark.read.parquet(f"{home}/asked").withColumn("chunk_id", F.col("chunk_id").cast("long"))


def _answers(spark: SparkSession, home: str, chunk: int) -> DataFrame:
    """The last answer of each batch of a chunk, or its last error."""
    kept = spark.read.parquet(f"{home}/answers/chunk={chunk:06d}")
    return kept.groupBy("key").agg(F.max_by("answer", F.struct(F.col("error").isNull(), F.col("answer").isNotNull(), "turn")).alias("answer"), F.max_by("error", F.struct(F.col("error").isNull(), F.col("answer").isNotNull(), "turn")).alias("error"))


def _whole(spark: SparkSession, home: str, chunk: int, asked: DataFrame, batches: DataFrame) -> DataFrame:
    """The rows of a chunk's answers that are valid and have each id that their batch asked for; seq is the batch."""
    said = _answers(spark, home, chunk).where("answer is not null").join(batches.select("key", "batch_id"), "key")
    lines = said.select(F.col("batch_id").alias("seq"), F.to_json(F.struct(F.struct(F.col("answer").alias("text")).alias("response"))).alias("value"))
    return scoring.complete(scoring.result_rows(scoring.parse_lines(lines)), asked)


def _chunk(spark: SparkSession, home: str, chunk: int, asked: DataFrame, scorer, attempts: int, pause) -> tuple[DataFrame, DataFrame]:
    """Asks what is open of a chunk, and checkpoints what is answered: the rows of whole answers, and the chunk's batches."""
    path, batches, turn = f"{home}/answers/chunk={chunk:06d}", packing.prompts(asked), 0
    todo = batches
    if written(spark, path):
        turn = spark.read.parquet(path).agg(F.max("turn")).first()[0]
        turn = 0 if turn is None else turn + 1
        todo = batches.join(_whole(spark, home, chunk, asked, batches).select(F.col("seq").alias("batch_id")).distinct(), "batch_id", "left_anti")
    # an answer is written before it is read, and its turn tells it from those of earlier calls
    scoring.ask(todo, scorer, attempts, pause).withColumn("turn", F.lit(turn)).write.mode("append").parquet(path)
    store.append_checkpoint(_whole(spark, home, chunk, asked, batches).withColumn("batch_id", F.col("seq")), f"{home}/checkpoint", chunk)
    return spark.read.parquet(f"{home}/checkpoint/chunk={chunk:06d}").withColumn("seq", F.col("batch_id")), batches


def results(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The checkpointed rows of a run, the last of each id."""
    return store.read_checkpoint(spark, f"{base}/{name}/checkpoint").drop("batch_id", "chunk")


def usage(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One row: requests, failures, tokens and USD of all attempts of a run, also of those before a crash or a second call."""
    fs, p = file_system(spark, f"{base}/{name}/answers")
    log = spark.read.option("basePath", p.toString()).parquet(p.toString()) if fs.exists(p) else spark.createDataFrame([], f"key string, attempts {scoring.ATTEMPTS}")
    return analytics.usage(scoring.request_log(log)).na.fill(0, ["input_tokens", "output_tokens"]).na.fill(0.0, ["usd_live", "usd_batch"])
