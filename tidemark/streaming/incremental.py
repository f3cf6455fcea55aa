"""The nightly job without the archive: what a new message needs of the past is kept, so a run's cost follows the new messages.

Two keyed tables stand beside the results. `tails` holds the last context_size messages of each channel; `pending` holds the windows of the messages that have no result yet. `take_in`
builds the windows of new messages from the tails of their channels; `run` scores what is pending and takes it off the list. The windows are those that the whole archive would give: a channel
where a message comes late, before the last one that its tail holds, is the one case that a tail may not serve, and its windows are built from the archive, of that channel alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import scoring, windows
from tidemark.sources import keyed
from tidemark.sources.keyed import file_system
from tidemark.streaming import nightly

TAIL = "message_id long, member_id string, channel_id long, channel_name string, author_name string, content string, created_at timestamp_ntz, content_len int"
PENDING = "message_id long, member_id string, channel_id long, channel_name string, author_name string, content string, created_at timestamp_ntz, content_len int, context_text string, n_priors int, year int, length_bucket string"


class LateMessages(Exception):
    """Messages came before the last ones of their channel, and there is no archive to build their windows from."""


def _typed(rows: DataFrame, schema: str) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)])


def _once(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def take_in(new: DataFrame, base: str, batch: int, archive: DataFrame | None = None, context_size: int = 3, max_chars: int = 500, buckets: int = keyed.BUCKETS, scored: DataFrame | None = None) -> dict[str, int]:
    """Puts the windows of new messages on the list of those to be scored, and their channels' tails up to date. batch numbers rise; a batch that was taken in is not taken in again.

    archive holds all messages, the new ones or not; it is read only for channels with late messages. The first batch may be the archive itself, with the
    ids that have results already as `scored`, which are left off the list.
    A crash on the way leaves the tails as they were, and the same batch starts over. Returns new messages, windows, and late channels.
    """
    spark = new.sparkSession
    tails = keyed.create(spark, f"{base}/tails", StructType.fromDDL(TAIL), "channel_id", buckets)
    keyed.create(spark, f"{base}/pending", StructType.fromDDL(PENDING), "message_id", buckets)
    if batch <= tails.note.get("batch", -1):
        return {"new": 0, "windows": 0, "late_channels": 0}
    full = lambda df: df if "content_len" in df.columns else df.withColumn("content_len", F.length(F.coalesce("content", F.lit(""))))
    held = f"{base}/_batch-{batch:08d}"
    new = _once(_typed(full(new), TAIL).dropDuplicates(["message_id"]), f"{held}/new")
    rooms = new.where("channel_id is not null").select("channel_id").distinct()
    ids, at = new.select("message_id"), F.struct("created_at", "message_id")
    old = _once(tails.bucketed().join(rooms, "channel_id", "left_semi").join(ids, "message_id", "left_anti").select(new.columns), f"{held}/old")
    last = old.groupBy("channel_id").agg(F.max(at).alias("last"), F.count(F.lit(1)).alias("n"))
    late = last.join(new.groupBy("channel_id").agg(F.min(at).alias("first")), "channel_id").where((F.col("first") < F.col("last")) & (F.col("n") >= context_size))
    late = _once(late.select("channel_id"), f"{held}/late")
    n_late = late.count()
    build = lambda rows: windows.build_windows(rows, context_size, max_chars)
    plain = old.unionByName(new).join(late, "channel_id", "left_anti")
    made = build(plain).join(ids, "message_id", "left_semi").select(*StructType.fromDDL(PENDING).names)
    if n_late:
        if archive is None:
            raise LateMessages(f"{n_late} channels of batch {batch} have late messages")
        open_ids = keyed.read(spark, f"{base}/pending").table().select("message_id").unionByName(ids).distinct()
        whole = _typed(full(archive), TAIL).join(late, "channel_id", "left_semi").join(ids, "message_id", "left_anti").select(new.columns).unionByName(new.join(late, "channel_id", "left_semi").select(new.columns))
        made = made.unionByName(build(whole).join(open_ids, "message_id", "left_semi").select(*made.columns))
    if scored is not None:
        made = windows.pending(made, scored)
    staged = keyed.stage(_typed(made, PENDING), f"{base}/pending", "message_id", keyed.read(spark, f"{base}/pending").buckets)
    keyed.replace_buckets(f"{base}/pending", staged, lambda was, rows: was.join(rows.select("message_id"), "message_id", "left_anti").select(rows.columns).unionByName(rows))
    n = spark.read.parquet(f"{held}/new").count(), staged.table().count()
    _drop(staged)
    back = Window.partitionBy("channel_id").orderBy(F.desc("created_at"), F.desc("message_id"))
    kept = old.unionByName(new).where("channel_id is not null").withColumn("_n", F.row_number().over(back)).where(F.col("_n") <= context_size).drop("_n")
    staged = keyed.stage(kept, f"{base}/tails", "channel_id", tails.buckets)
    keyed.replace_buckets(f"{base}/tails", staged, lambda was, rows: was.join(rows.select("channel_id").distinct(), "channel_id", "left_anti").select(rows.columns).unionByName(rows), {"batch": batch})
    _drop(staged)
    fs, p = file_system(spark, held)
    fs.delete(p, True)
    return {"new": n[0], "windows": n[1], "late_channels": n_late}


def _drop(staged: keyed.Version) -> None:
    staged.forget()
    keyed.drop_folders(staged.spark, staged.base, staged.parts)


def run(spark: SparkSession, base: str, scorer: scoring.Scorer, model: str, now: str, limit: int | None = None) -> dict[str, int]:
    """Scores pending windows, the oldest first if limited, stores the results under base/results and takes those off the list.

    A run that crashed before its end is finished first, with the answers that it has.
    """
    for stamp in _unfinished(spark, base):
        if stamp != now:
            _scored(spark, base, scorer, model, stamp, None)
    return _scored(spark, base, scorer, model, now, limit)


def _scored(spark: SparkSession, base: str, scorer: scoring.Scorer, model: str, now: str, limit: int | None) -> dict[str, int]:
    results, list_path = f"{base}/results", f"{base}/pending"
    pending = keyed.create(spark, list_path, StructType.fromDDL(PENDING), "message_id")
    keyed.write_text(spark, f"{base}/_runs/{_name(now)}.begun", now)
    todo = pending.table()
    if limit is not None:
        todo = todo.orderBy("created_at", "message_id").limit(limit)
    counts = nightly.score(spark, lambda done: todo, pending.table().select("message_id"), results, scorer, model, now)
    fresh = f"{results}/_fresh-{nightly.stamp_of(now)}"
    if nightly.written(spark, fresh):
        ids = spark.read.parquet(fresh).select(F.col("message_id").cast("long").alias("message_id")).distinct()
        staged = keyed.stage(ids, list_path, "message_id", pending.buckets)
        keyed.replace_buckets(list_path, staged, lambda was, rows: was.join(rows, "message_id", "left_anti"))
        _drop(staged)
    keyed.write_text(spark, f"{base}/_runs/{_name(now)}.ended", now)
    return counts


def _name(now: str) -> str:
    return nightly.stamp_of(now)


def _unfinished(spark: SparkSession, base: str) -> list[str]:
    """The times of runs that have begun and not ended, in order."""
    fs, folder = file_system(spark, f"{base}/_runs")
    names = {s.getPath().getName() for s in fs.listStatus(folder)} if fs.exists(folder) else set()
    begun = sorted(n.removesuffix(".begun") for n in names if n.endswith(".begun"))
    return [keyed.read_text(spark, f"{base}/_runs/{n}.begun") for n in begun if f"{n}.ended" not in names]
