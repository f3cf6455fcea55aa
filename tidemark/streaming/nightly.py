"""The nightly job: unscored messages to windows, prompts, answers and stored results; once, or over a folder of new files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import packing, scoring, store, windows
from tidemark.operators.store import STORED  # noqa: F401  its name of old
from tidemark.sources.keyed import file_system
from tidemark.sources.messages import MESSAGES


def run(messages: DataFrame, base: str, scorer: scoring.Scorer, model: str, now: str, limit: int | None = None) -> dict[str, int]:
    """Scores what has no result yet and upserts it into the table at `base`; a second run finds nothing to do.

    An answer counts for the ids that its batch asked for, and a batch that leaves one out is void: its ids stay unscored and are asked for
    again in the next run. A run that is repeated with the same `now` after a crash asks only for batches that have no answer yet. What other writers store
    meanwhile stays: the table is read again when the answers are merged into it.
    """
    return score(messages.sparkSession, lambda old: windows.nightly_targets(messages, old, limit), messages, base, scorer, model, now)


def score(spark: SparkSession, targets, messages: DataFrame, base: str, scorer: scoring.Scorer, model: str, now: str) -> dict[str, int]:
    """Scores the windows targets(stored results), of which messages has the ids, as `run` tells."""
    stamp = stamp_of(now)
    asked_path, answers = f"{base}/_asked-{stamp}", f"{base}/_answers-{stamp}"
    if not written(spark, asked_path):
        packing.packed(targets(store.create(spark, base).bucketed())).write.mode("overwrite").parquet(asked_path)  # ids keep their batches in a repeated run
    asked = spark.read.parquet(asked_path)
    if asked.isEmpty():
        return {"batches": 0, "written": 0}
    batches = packing.prompts(asked)
    todo = batches
    if written(spark, answers):
        todo = batches.join(spark.read.parquet(answers).where("answer is not null").select("key"), "key", "left_anti")
    scoring.score_batches(todo, scorer).write.mode("append").parquet(answers)  # a scorer is asked once, and its answers last
    said = spark.read.parquet(answers).where("answer is not null").join(batches.select("key", "batch_id", "size"), "key")
    lines = said.select(F.col("batch_id").alias("seq"), F.to_json(F.struct(F.struct(F.col("answer").alias("text")).alias("response"))).alias("value"))
    whole = scoring.complete(scoring.result_rows(scoring.parse_lines(lines)), asked)
    fresh = f"{base}/_fresh-{stamp}"
    whole.write.mode("overwrite").parquet(fresh)  # parsed once, for the table and the counts
    whole = spark.read.parquet(fresh)
    counts = store.upsert(spark, base, store.latest(whole, model), messages, now)
    sizes = batches.select(F.col("batch_id").alias("seq"), "size").join(whole.select("seq").distinct().withColumn("_whole", F.lit(1)), "seq", "left")
    n = sizes.agg(F.count(F.lit(1)).alias("batches"), F.count_if(F.col("_whole").isNull()).alias("failed"), F.coalesce(F.sum(F.when(F.col("_whole").isNull(), F.col("size"))), F.lit(0)).alias("missing")).first()
    return {"batches": n["batches"], "failed_batches": n["failed"], "missing_ids": n["missing"], "written": counts["written"]}


def stamp_of(now: str) -> str:
    """A time as part of a file's name."""
    return now.replace(" ", "T").replace(":", "")


def written(spark: SparkSession, path: str) -> bool:
    """Whether a write to path has ended."""
    fs, done = file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(done)


def follow(spark: SparkSession, folder: str, history: str, checkpoint: str, each):
    """Every new message file once: appended to `history`, then `each(all messages, batch number)`; stops when none is left."""

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{history}/batch={number:08d}")
        each(spark.read.schema(MESSAGES).parquet(history), number)

    return spark.readStream.schema(MESSAGES).parquet(folder).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
