"""Batch jobs of a scorer that answers later: submitting, waiting, and taking in what finished jobs wrote.

The transport is a protocol; an adapter to a hosted service sends it the request files, so the message texts. Tests use a fake.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import scoring, store
from tidemark.sources.files import read_answers
from tidemark.sources.keyed import file_system

JOBS = "job_id string, state string, create_time timestamp_ntz, path string"
#: Jobs whose answers may stand in the job itself.
JOBS_INLINE = f"{JOBS}, inline array<string>"
ENDED = ("succeeded", "failed", "cancelled", "expired")


class Busy(Exception):
    """The service takes no more jobs for now."""


class JobFailed(Exception):
    pass


class Transport(Protocol):
    def submit(self, name: str, path: str) -> str:
        """The id of a job for the request lines under path; Busy if none can be taken."""

    def state(self, job: str) -> str: ...

    def output(self, job: str) -> str:
        """The path of the answer lines of a job that has succeeded."""


def submit(transport: Transport, name: str, path: str, attempts: int = 6, first: float = 30.0, longest: float = 300.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """Submits a job; a busy service is tried again after first, then twice as many seconds each time, up to longest."""
    for n in range(attempts):
        try:
            return transport.submit(name, path)
        except Busy:
            if n + 1 == attempts:
                raise
            sleep(min(longest, first * 2**n))
    raise ValueError("attempts must be at least 1")


def wait(transport: Transport, job: str, every: float = 30.0, deadline: float = 86_400.0, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> str:
    """The state in which a job ends; TimeoutError if it has not ended at the deadline."""
    end = clock() + deadline
    while (state := transport.state(job)) not in ENDED:
        if clock() >= end:
            raise TimeoutError(f"job {job} is {state} after {deadline:.0f} s")
        sleep(every)
    return state


def run_chunks(transport: Transport, chunks: Iterable[tuple[str, str]], each: Callable[[str, str], None], **options) -> int:
    """Runs the jobs of chunks(name, path) one after another and hands each one's name and answer path to `each`; stops at the first that does not succeed."""
    timing = {k: options[k] for k in ("sleep",) if k in options}
    done = 0
    for name, path in chunks:
        job = submit(transport, name, path, **timing)
        state = wait(transport, job, **options)
        if state != "succeeded":
            raise JobFailed(f"chunk {name}: job {job} {state}")
        each(name, transport.output(job))
        done += 1
    return done


def finished(jobs: DataFrame, since: str | None = None) -> DataFrame:
    """The succeeded jobs(job_id, state, create_time, path), from `since` on, oldest first."""
    done = jobs.where("state = 'succeeded'")
    if since is not None:
        done = done.where(F.col("create_time") >= F.lit(since).cast("timestamp_ntz"))
    return done.orderBy("create_time", "job_id")


ANSWERS = "seq struct<create_time:timestamp_ntz,job_id:string,block:bigint,row:bigint>, value string"


def _bare(url):
    """A file's URL as it is, but for an empty host, which some write and some leave out."""
    return F.regexp_replace(url, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def files_of(spark: SparkSession, jobs: DataFrame) -> DataFrame:
    """file, job_id and create_time of each answer file of jobs, in the form in which a scan names its files; a file under the paths of two jobs is the one's with the longer path.

    The driver lists the files, as for any scan, and holds one entry a file.
    """
    listed = jobs.select("job_id", "create_time", "path").collect()
    owner: dict[str, tuple[int, str, object]] = {}
    for r in listed:
        depth = len(file_system(spark, r["path"])[1].toUri().getPath())
        for file in spark.read.option("recursiveFileLookup", "true").text(r["path"]).inputFiles():
            best = owner.get(file)
            if best is None or depth > best[0] or (depth == best[0] and (r["create_time"], r["job_id"]) > (best[2], best[1])):
                owner[file] = (depth, r["job_id"], r["create_time"])
    return spark.createDataFrame([(f, j, t) for f, (_, j, t) in owner.items()], "file string, job_id string, create_time timestamp_ntz")


def file_name(name: str) -> str:
    """A service's name of an answer file, with the prefix that downloads ask for."""
    return name if name.startswith("files/") else f"files/{name}"


def answers(spark: SparkSession, jobs: DataFrame) -> DataFrame:
    """seq and value of all answer lines of jobs, a later job's after an earlier one's, in one read. Lines meet their job by the file that they stand in.

    Jobs with a column `inline` that has lines are answered by these, their files are not read. A job with neither has no lines.
    """
    if "inline" in jobs.columns:
        has = F.coalesce(F.size("inline") > 0, F.lit(False))
        own = jobs.where(has).select("create_time", "job_id", F.posexplode("inline").alias("pos", "value"))
        told = own.select(F.struct("create_time", "job_id", F.lit(0).cast("long").alias("block"), F.col("pos").cast("long").alias("row")).alias("seq"), "value")
        return told.unionByName(answers(spark, jobs.where(~has).drop("inline")))
    files = files_of(spark, jobs.where("path is not null and path <> ''"))
    named = [r["file"] for r in files.select("file").collect()]
    if not named:
        return spark.createDataFrame([], ANSWERS)
    # a scan takes paths as they are written, and names files in the form of a URL
    lines = read_answers(spark, [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f)).toString() for f in named])
    own = lines.join(files.withColumn("file", _bare(F.col("file"))), _bare(F.col("path")) == F.col("file"), "left")
    job = F.when(F.col("job_id").isNull(), F.raise_error(F.concat(F.lit("a line of no job in "), F.col("path"))).cast("string")).otherwise(F.col("job_id"))
    return own.select(F.struct("create_time", job.alias("job_id"), F.col("seq.block").alias("block"), F.col("seq.row").alias("row")).alias("seq"), "value")


def recover(jobs: DataFrame, messages: DataFrame, base: str, model: str, now: str, since: str | None = None, checkpoint: str | None = None, chunk: int = 0) -> dict[str, int | bool | str]:
    """Takes the answers of finished jobs into the table at base; of two answers for an id the later job's stays. Runs again without harm.

    Returns lines, lines with an error, rows written and skipped, and whether the checkpoint was written; it comes last, and its failure voids nothing, but is told as checkpoint_error.
    """
    spark = messages.sparkSession
    held = f"{base}/_recovered-{uuid.uuid4().hex}"
    try:
        scoring.parse_lines(answers(spark, finished(jobs, since))).write.parquet(held)  # parsed once, for the counts, the table and the checkpoint
        parsed = spark.read.parquet(held)
        n = parsed.agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("status") != "ok").alias("errors")).first()
        rows = scoring.result_rows(parsed)
        counts = store.upsert(spark, base, store.latest(rows, model), messages, now)
        kept: dict[str, object] = {"checkpoint": False}
        if checkpoint is not None:
            try:
                store.append_checkpoint(store.keep_last(rows), checkpoint, chunk)
                kept = {"checkpoint": True}
            except Exception as e:  # noqa: BLE001  the table holds the rows already
                kept = {"checkpoint": False, "checkpoint_error": f"{type(e).__name__}: {e}"}
    finally:
        fs, p = file_system(spark, held)
        fs.delete(p, True)
    return {"lines": n["lines"], "errors": n["errors"], **counts, **kept}
