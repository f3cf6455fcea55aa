"""Context windows: each message with the messages before it in its channel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import context_line, is_blank, length_bucket, strip
from tidemark.operators import ranges as ranges_of
from tidemark.sources.messages import require_columns

NEEDED = ("message_id", "member_id", "channel_id", "channel_name", "author_name", "content", "created_at")
ORDER = ("channel_id", "created_at", "message_id")


def _split(rows: DataFrame, context_size: int, ranges: int) -> DataFrame:
    """rows with _range and _halo, so that no channel is one task: rows are parted by ranges of channel, time and id, and where a bound lies inside a channel,
    the ranges after it get copies, marked _halo, of the channel's last context_size rows before them."""
    rows = ranges_of.dealt(rows, [F.col(c) for c in ORDER], ranges)
    upper = F.get("_bounds", F.col("_range"))["k0"]  # the bound above the row's range lies in its channel
    mine = Window.partitionBy("channel_id", "_range").orderBy(F.desc("created_at"), F.desc("message_id"))
    ends = rows.where(upper == F.col("channel_id")).drop("_bounds").withColumn("_back", F.row_number().over(mine)).where(F.col("_back") <= context_size)
    # of a channel's ends in order, `_at` numbers the rows and `_all` counts those up to the end of a range: context_size a range at most
    room = Window.partitionBy("channel_id").orderBy("_range", F.desc("_back"))
    ends = ends.withColumn("_at", F.row_number().over(room))
    last = ends.groupBy(F.col("channel_id").alias("_c"), F.col("_range").alias("_r")).agg(F.max("_at").alias("_all"))
    later = ends.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(context_size - 1)))).withColumn("_to", F.col("_range") + F.col("_step"))
    halo = later.join(last, (F.col("channel_id") == F.col("_c")) & (F.col("_to") == F.col("_r"))).where(F.col("_all") - F.col("_at") < context_size)
    halo = halo.withColumn("_range", F.col("_to") + 1).drop("_back", "_at", "_step", "_to", "_c", "_r", "_all").withColumn("_halo", F.lit(True))
    return rows.drop("_bounds").withColumn("_halo", F.lit(False)).unionByName(halo)


def build_windows(messages: DataFrame, context_size: int = 3, max_chars: int = 500, skip_blank: bool = True, ranges: int | None = None) -> DataFrame:
    """One row a message: its context lines, oldest first, and its own marked line.

    A blank prior takes up a slot but is not shown. Messages without a channel have no priors. All lags share one
    window; blank targets go after the lags are taken. A large table is split into ranges inside channels, `ranges` of them or as many as its size asks for.
    """
    require_columns(messages, NEEDED)
    has = F.col("channel_id").isNotNull()
    rows = messages.withColumn("content", F.coalesce("content", F.lit("")))
    if "content_len" not in rows.columns:
        rows = rows.withColumn("content_len", F.length("content"))
    # a message without a channel is a partition of its own, so that they are not one task
    part, n = ["channel_id", F.when(~has, F.col("message_id"))], ranges_of.how_many(messages, ranges)
    split = n > 1 and context_size > 0
    if split:
        rows, part = _split(rows.select(*NEEDED, "content_len"), context_size, n), [*part, "_range"]
    w = Window.partitionBy(*part).orderBy("created_at", "message_id")
    rows = rows.withColumns({f"_{c[0]}{i}": F.when(has, F.lag(c, i).over(w)) for i in range(1, context_size + 1) for c in ("author_name", "content")})
    if split:
        rows = rows.where(~F.col("_halo"))
    if skip_blank:
        rows = rows.where(~is_blank(F.col("content")))
    priors = [F.when(F.col(f"_a{i}").isNotNull() & ~is_blank(F.col(f"_c{i}")), context_line(F.col(f"_a{i}"), strip(F.col(f"_c{i}")), max_chars)) for i in range(context_size, 0, -1)]
    own = F.concat(F.lit(">>> TARGET "), context_line(F.col("author_name"), F.col("content"), max_chars))
    shown = sum((p.isNotNull().cast("int") for p in priors), F.lit(0))
    return rows.select(*NEEDED[:6], "created_at", "content_len", F.concat_ws("\n", *priors, own).alias("context_text"), shown.alias("n_priors"), F.year("created_at").alias("year"), length_bucket(F.col("content_len")).alias("length_bucket"))


def _without(rows: DataFrame, done: DataFrame) -> DataFrame:
    """rows whose message_id is not in done. Ids of one type are compared as they are, so that tables bucketed by them need no shuffle; others as text."""
    kinds = {rows.schema["message_id"].dataType, done.schema["message_id"].dataType}
    same = (lambda c: c) if len(kinds) == 1 else (lambda c: c.cast("string"))
    return rows.join(done.select(same(F.col("message_id")).alias("_done")), same(F.col("message_id")) == F.col("_done"), "left_anti")


def unscored(messages: DataFrame, results: DataFrame) -> DataFrame:
    """Messages with text that have no result row."""
    return _without(messages.where(~is_blank(F.col("content"))), results)


def pending(windows: DataFrame, *done: DataFrame) -> DataFrame:
    """windows without a row in any of done, such as a checkpoint and the results table."""
    for d in done:
        windows = _without(windows, d)
    return windows


def history(messages: DataFrame, targets: DataFrame) -> DataFrame:
    """All messages of the targets' channels, and the targets that have none."""
    rooms = targets.select("channel_id").distinct()
    lone = messages.where("channel_id is null").join(targets.select("message_id"), "message_id", "left_semi")
    return messages.join(rooms, "channel_id", "left_semi").select(*messages.columns).unionByName(lone.select(*messages.columns))


def nightly_targets(messages: DataFrame, results: DataFrame, limit: int | None = None, **options) -> DataFrame:
    """Windows of the unscored messages, with priors that may be scored already."""
    todo = unscored(messages, results)
    if limit is not None:
        todo = todo.orderBy("created_at", "message_id").limit(limit)
    return build_windows(history(messages, todo), **options).join(todo.select("message_id"), "message_id", "left_semi")
