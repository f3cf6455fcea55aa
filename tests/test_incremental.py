"""The nightly job from tails and a list of what is open gives the prompts of the whole archive, and reads as much however long the archive is."""

import datetime as dt
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import windows
from tidemark.sources import keyed
from tidemark.sources.messages import MESSAGES
from tidemark.streaming import incremental

AT = dt.datetime(2024, 1, 1)


def rows(n, start=0, channels=4, late=(), seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(start, start + n):
        channel = None if i % 9 == 0 else rng.randrange(channels)
        minute = i - 200 if i in late else i
        out.append((i, "m", channel, "\n" if i % 11 == 0 else f"text {i}", AT + dt.timedelta(minutes=minute), "ann", None, "c", None, None))
    return out


def right():
    class Right:
        def answer(self, key, prompt):
            ids = re.findall(r"^id: (\d+)$", prompt, re.M)
            return json.dumps({"results": [{"message_id": i, "polarity": "neutral", "polarity_score": 0, "emotions": ["neutral"], "sarcasm": False, "toxicity": "none", "directed_at": "general", "confidence": 1, "rationale": "same"} for i in ids]})

    return Right()


def texts(df):
    return {r.message_id: (r.n_priors, r.context_text) for r in df.collect()}


def test_prompts_are_those_of_the_archive(spark, tmp_path):
    base, seen = f"file://{tmp_path}/state", []
    batches = [rows(60), rows(20, 60), rows(25, 80, channels=7), rows(20, 105, late={110, 111, 118}), rows(3, 125)]
    for k, b in enumerate(batches):
        seen += b
        archive, new = spark.createDataFrame(seen, MESSAGES), spark.createDataFrame(b, MESSAGES)
        if k == 3:
            with pytest.raises(incremental.LateMessages):
                incremental.take_in(new, base, k, buckets=4)
        told = incremental.take_in(new, base, k, archive, buckets=4)
        assert told["new"] == len(b) and (told["late_channels"] > 0) == (k == 3)
        assert incremental.take_in(new, base, k, archive)["new"] == 0  # a batch counts once
        want = texts(windows.build_windows(archive, ranges=1))
        open_now = texts(keyed.read(spark, f"{base}/pending").table())
        assert open_now == {i: w for i, w in want.items() if i in open_now} and {r[0] for r in b if r[3] != "\n"} <= set(open_now)
        tails = keyed.read(spark, f"{base}/tails").table().groupBy("channel_id").agg(F.sort_array(F.collect_list("message_id")).alias("ids")).collect()
        for t in tails:
            assert t.ids == sorted(r[0] for r in sorted((r for r in seen if r[2] == t.channel_id), key=lambda r: (r[4], r[0]))[-3:])
        if k in (0, 2):
            incremental.run(spark, base, right(), "m", f"2024-02-0{k + 1} 00:00:00")
            assert keyed.read(spark, f"{base}/pending").table().count() == 0
    done = incremental.run(spark, base, right(), "m", "2024-03-01 00:00:00", limit=10)
    assert done["written"] == 10 and keyed.read(spark, f"{base}/pending").table().count() == sum(r[3] != "\n" for b in batches[3:] for r in b) - 10
    assert incremental.run(spark, base, right(), "m", "2024-03-02 00:00:00")["failed_batches"] == 0
    assert {r.message_id for r in keyed.read(spark, f"{base}/results").table().collect()} == {r[0] for r in seen if r[3] != "\n"}
    assert incremental.run(spark, base, right(), "m", "2024-03-03 00:00:00") == {"batches": 0, "written": 0}


def test_a_run_that_crashed_is_finished_first(spark, tmp_path, monkeypatch):
    base = f"file://{tmp_path}/state"
    incremental.take_in(spark.createDataFrame(rows(20), MESSAGES), base, 0, buckets=4)
    real = keyed.stage

    def dies(rows_, at, *more):
        if at.endswith("/pending"):
            raise KeyboardInterrupt
        return real(rows_, at, *more)

    monkeypatch.setattr(keyed, "stage", dies)
    with pytest.raises(KeyboardInterrupt):
        incremental.run(spark, base, right(), "m", "2024-02-01 00:00:00")
    monkeypatch.setattr(keyed, "stage", real)

    class Never:
        def answer(self, key, prompt):
            raise RuntimeError("asked again")

    assert incremental.run(spark, base, Never(), "m", "2024-02-02 00:00:00") == {"batches": 0, "written": 0}
    assert keyed.read(spark, f"{base}/results").table().count() == sum(r[3] != "\n" for r in rows(20))


def stages(spark):
    """Stage ids and the rows that each has read from files; the session keeps the latest thousand."""
    store = spark.sparkContext._jsc.sc().statusStore()
    all_ = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return {all_.apply(i).stageId(): all_.apply(i).inputRecords() for i in range(all_.size())}


def test_cost_follows_the_new_messages(spark, tmp_path):
    cost = {}
    for n in (100, 800):
        base = f"file://{tmp_path}/state-{n}"
        old = spark.createDataFrame(rows(n), MESSAGES)
        incremental.take_in(old, base, 0, buckets=4, scored=old)
        assert keyed.read(spark, f"{base}/pending").table().count() == 0
        new = spark.createDataFrame(rows(10, n), MESSAGES)
        before = max(stages(spark))
        incremental.take_in(new, base, 1, buckets=4)
        assert incremental.run(spark, base, right(), "m", "2024-02-01 00:00:00")["written"] > 0
        own = {k: v for k, v in stages(spark).items() if k > before}
        assert len(own) < 1000
        cost[n] = sum(own.values())
    assert 0 < cost[800] <= 1.1 * cost[100]
