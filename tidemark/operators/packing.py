"""Batches of windows for scoring requests, their prompts, and what they cost."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import estimated_tokens
from tidemark.operators.ranges import ordinals
from tidemark.operators.scoring import output_schema
from tidemark.sources.keyed import file_system
from tidemark.sources.messages import require_columns

BATCH_SIZE, LINES_PER_CHUNK, OUTPUT_TOKENS = 15, 2500, 90
TEMPERATURE = 0.2
#: USD a million tokens: input and output, live and batch.
PRICES = {"live": (0.25, 1.50), "batch": (0.125, 0.75)}
SYSTEM = "You label chat messages. Judge only the marked target line of each item, use the lines before it as context, and answer with one JSON object a target in the given order."


def numbered(windows: DataFrame, ranges: int | None = None) -> DataFrame:
    """windows with `ordinal`, their place in the order of channel, time and id, without one task for all rows, a channel or a day of one.

    The channel null is last, the time null first. A large table is dealt by ranges of that order, see `ranges.ordinals`.
    """
    return ordinals(windows, [F.col("channel_id").isNull(), F.col("channel_id"), F.col("created_at"), F.col("message_id")], "ordinal", ranges)


def packed(windows: DataFrame, batch_size: int = BATCH_SIZE, lines_per_chunk: int = LINES_PER_CHUNK, ranges: int | None = None) -> DataFrame:
    """windows with ordinal, batch_id, position in the batch, and chunk_id from 1."""
    require_columns(windows, ["message_id", "channel_name", "context_text"])
    batch = F.floor(F.col("ordinal") / batch_size)
    return numbered(windows, ranges).withColumns({"batch_id": batch.cast("long"), "position": (F.col("ordinal") % batch_size).cast("long"), "chunk_id": (F.floor(batch / lines_per_chunk) + 1).cast("long")})


def prompts(packed_windows: DataFrame) -> DataFrame:
    """One row a batch: its key, size, prompt, estimated prompt tokens, and the ids that it asks for, as text."""
    block = F.concat(
        F.lit("### "), (F.col("position") + 1).cast("string"), F.lit("\nid: "), F.col("message_id").cast("string"),
        F.lit("\nchannel: #"), F.coalesce("channel_name", F.lit("unknown")), F.lit("\n"), F.col("context_text"), F.lit("\n"),
    )
    items = packed_windows.select("chunk_id", "batch_id", "position", "message_id", block.alias("block"))
    own = F.sort_array(F.collect_list(F.struct("position", "message_id", "block")))  # a batch has batch_size rows
    out = items.groupBy("chunk_id", "batch_id").agg(own.alias("items"))
    head = F.concat(F.lit("Label "), F.size("items").cast("string"), F.lit(" message(s) as {\"results\": [...]}.\n"))
    prompt = F.concat_ws("\n", head, F.array_join(F.transform("items", lambda x: x["block"]), "\n"))
    return out.select(
        "chunk_id", "batch_id", F.concat(F.lit("batch-"), F.col("items")[0]["message_id"].cast("string")).alias("key"),
        F.size("items").alias("size"), prompt.alias("prompt"), estimated_tokens(F.length(prompt)).alias("prompt_tokens"), F.transform("items", lambda x: x["message_id"].cast("string")).alias("ids"),
    )


def request_lines(batches: DataFrame) -> DataFrame:
    """chunk_id and one JSON request line a batch."""
    part = lambda text: F.struct(F.array(F.struct(text.alias("text"))).alias("parts"))
    config = F.parse_json(F.lit(json.dumps({"temperature": TEMPERATURE, "response_mime_type": "application/json", "response_schema": output_schema()})))
    request = F.struct(F.array(part(F.col("prompt"))).alias("contents"), part(F.lit(SYSTEM)).alias("system_instruction"), config.alias("generation_config"))
    return batches.select("chunk_id", F.to_json(F.struct("key", request.alias("request"))).alias("value"))


def write_requests(batches: DataFrame, path: str, prefix: str = "requests") -> dict[str, int]:
    """One file of JSON lines a chunk in the folder path, prefix_001.jsonl and so on, its lines in the order of batches. Returns the lines of each name, without its ending.

    All is written under a hidden name first; then this prefix's old files go and the new ones are renamed into place. Files of other prefixes stay. Names and counts, one a chunk,
    pass through the driver; a chunk is one task, as its lines are one file.
    """
    spark, number = batches.sparkSession, F.col("chunk_id").cast("string")
    name = F.concat(F.lit(f"{prefix}_"), F.when(F.col("chunk_id") < 1000, F.lpad(number, 3, "0")).otherwise(number))
    named = batches.select(name.alias("chunk_id"), "batch_id", "key", "prompt")
    # sorted by what the folders are named by, so that the writer has nothing to sort again
    lines = request_lines(named.repartition("chunk_id").sortWithinPartitions("chunk_id", "batch_id")).withColumnRenamed("chunk_id", "chunk")
    fs, folder = file_system(spark, path)
    hidden = f"{path}/_writing-{prefix}-{uuid.uuid4().hex}"
    lines.write.partitionBy("chunk").text(hidden)
    try:
        counts = {r["chunk"]: r["n"] for r in spark.read.schema("value string, chunk string").text(hidden).groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).collect()}
        old = re.compile(rf"{re.escape(prefix)}_\d{{3,}}\.jsonl")
        for f in fs.listStatus(folder):
            if f.isFile() and old.fullmatch(f.getPath().getName()):
                fs.delete(f.getPath(), False)
        for chunk in counts:
            _, own = file_system(spark, f"{hidden}/chunk={chunk}")
            parts = [f.getPath() for f in fs.listStatus(own) if f.getPath().getName().startswith("part-")]
            if len(parts) != 1 or not fs.rename(parts[0], file_system(spark, f"{path}/{chunk}.jsonl")[1]):
                raise OSError(f"{chunk} is not one file that can be renamed: {parts}")
    finally:
        fs.delete(file_system(spark, hidden)[1], True)
    return counts


def cost(batches: DataFrame) -> DataFrame:
    """One row: messages, requests, tokens in and out, USD live and batch; all zero without batches."""
    system = max(1, len(SYSTEM) // 4)
    one = batches.agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("n_messages"), F.count(F.lit(1)).alias("n_batches"), F.coalesce(F.sum("prompt_tokens"), F.lit(0)).cast("long").alias("user_tokens"))
    one = one.withColumns({"input_tokens": F.col("user_tokens") + system * F.col("n_batches"), "output_tokens": F.col("n_messages") * OUTPUT_TOKENS})
    one = one.withColumn("mean_batch_tokens", F.when(F.col("n_batches") > 0, F.col("user_tokens") / F.col("n_batches")).otherwise(F.lit(0.0)))
    usd = {f"usd_{k}": (F.col("input_tokens") * F.lit(i) + F.col("output_tokens") * F.lit(o)) / F.lit(1e6) for k, (i, o) in PRICES.items()}
    return one.withColumns(usd)


def cost_of_windows(windows: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """The cost of scoring windows that are not packed yet."""
    return cost(prompts(packed(windows, batch_size)))


def cost_gate(estimate: DataFrame, actual_usd: float, most: float = 2.0) -> DataFrame:
    ratio = F.when(F.col("usd_live") > 0, F.lit(actual_usd) / F.col("usd_live")).otherwise(F.lit(float("inf")))
    return estimate.select("usd_live", ratio.alias("ratio"), (ratio <= most).alias("passes"))
