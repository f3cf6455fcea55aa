"""Settings of a nightly run, from the environment or a command line."""

from __future__ import annotations

import argparse
import importlib
import os
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

PREFIX = "TIDEMARK_"


@dataclass(frozen=True)
class Config:
    messages: str
    results: str
    scorer: str = ""
    model: str = "double"

    @classmethod
    def from_environment(cls, env: Mapping[str, str] = os.environ) -> Config:
        """TIDEMARK_MESSAGES and TIDEMARK_RESULTS must be set; TIDEMARK_SCORER names a module:factory."""
        missing = [PREFIX + k for k in ("MESSAGES", "RESULTS") if not env.get(PREFIX + k)]
        if missing:
            raise ValueError(f"not set: {', '.join(missing)}")
        return cls(**{k: env[PREFIX + k.upper()] for k in ("messages", "results", "scorer", "model") if env.get(PREFIX + k.upper())})

    def make_scorer(self):
        """What the factory named by scorer, module:factory, returns for the model."""
        module, _, factory = self.scorer.partition(":")
        if not factory:
            raise ValueError("scorer must be module:factory")
        return getattr(importlib.import_module(module), factory)(self.model)


def main(argv: list[str] | None = None, env: Mapping[str, str] = os.environ) -> dict[str, int]:
    """python -m tidemark.streaming.config [--limit N] [--now TIME]: one nightly run."""
    p = argparse.ArgumentParser(description="Score the messages that have no result yet.")
    p.add_argument("--limit", type=int, default=None, help="messages to score at most, the oldest first")
    p.add_argument("--now", default=None, help="the run's time; repeat it to resume a run")
    args = p.parse_args(argv)
    if args.limit is not None and args.limit < 0:
        p.error("--limit must not be negative")
    config = Config.from_environment(env)

    from pyspark.sql import SparkSession

    from tidemark.sources import files, ship
    from tidemark.streaming import nightly

    spark = SparkSession.builder.getOrCreate()
    ship.ship(spark)
    now = args.now or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    counts = nightly.run(files.read_messages(spark, config.messages), config.results, config.make_scorer(), config.model, now, args.limit)
    print(" ".join(f"{k}={v}" for k, v in counts.items()))
    return counts


if __name__ == "__main__":
    main()
