"""python -m tidemark COMMAND: the jobs of a conversation archive, with the settings of `streaming.config`.

estimate tells what scoring the messages without a result would cost; requests writes their request files; nightly scores them; recover takes in what finished jobs have
answered; report writes the page. All but nightly read and write through the session's own file systems and ask no scorer.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping
from datetime import datetime, timezone

from tidemark.streaming.config import Config
from tidemark.streaming.config import main as nightly


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark", description="Jobs of a conversation archive.")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("nightly", help="score the messages that have no result yet (--limit, --now)", add_help=False)
    sub.add_parser("estimate", help="the cost of scoring the messages that have no result yet")
    r = sub.add_parser("requests", help="request files of the messages that have no result yet")
    r.add_argument("--out", required=True)
    r.add_argument("--prefix", default="requests")
    r.add_argument("--lines", type=int, default=2500, help="requests a file at most")
    r = sub.add_parser("recover", help="take in the answers of finished jobs")
    r.add_argument("--jobs", required=True, help="a JSON lines file of job_id, state, create_time and path")
    r.add_argument("--since", default=None)
    r.add_argument("--now", default=None)
    r = sub.add_parser("report", help="the report as one HTML file")
    r.add_argument("--out", required=True)
    r.add_argument("--since", type=int, default=2022, help="first year of the monthly series")
    r.add_argument("--least", type=int, default=500, help="messages that a member or channel has at least to be compared")
    return p


def main(argv: list[str] | None = None, env: Mapping[str, str] = os.environ) -> dict:
    args, rest = _parser().parse_known_args(argv)
    if args.command == "nightly":
        return nightly(rest, env)
    if rest:
        _parser().error(f"unknown arguments: {' '.join(rest)}")
    config = Config.from_environment(env)

    from pyspark.sql import SparkSession

    from tidemark.operators import analytics, packing, report, store, windows
    from tidemark.sources import files, ship
    from tidemark.streaming import jobs

    spark = SparkSession.builder.getOrCreate()
    ship.ship(spark)
    messages, results = files.read_messages(spark, config.messages), store.create(spark, config.results).table()
    if args.command == "report":
        report.write(analytics.scored(messages, results), args.out, args.since, args.least)
        told = {"written": args.out}
    elif args.command == "recover":
        now = args.now or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        told = jobs.recover(spark.read.schema(jobs.JOBS_INLINE).json(args.jobs), messages, config.results, config.model, now, args.since)
    elif args.command == "estimate":
        told = packing.cost_of_windows(windows.nightly_targets(messages, results)).first().asDict()
    else:
        told = packing.write_requests(packing.prompts(packing.packed(windows.nightly_targets(messages, results), lines_per_chunk=args.lines)), args.out, args.prefix)
    print(" ".join(f"{k}={v}" for k, v in told.items()))
    return told


if __name__ == "__main__":
    main()
