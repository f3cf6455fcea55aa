"""Hot channels, days and strata are split, and the rows are the same."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import packing, ranges, sampling, windows

SCHEMA = "message_id long, member_id string, channel_id long, channel_name string, author_name string, content string, created_at timestamp_ntz"
AT = dt.datetime(2024, 1, 1)


def messages(spark, n, channel, minute, seed=1):
    rng = random.Random(seed)
    rows = [(i, "m", channel(i, rng), "c", f"a{i % 5}", rng.choice(["", "\n", f"text {i}", f"more {i}"]), minute(i, rng) if minute(i, rng) is None else AT + dt.timedelta(minutes=minute(i, rng))) for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


CASES = {
    "one channel": (lambda i, r: 7, lambda i, r: i),
    "one minute": (lambda i, r: 7, lambda i, r: 0),
    "hot and cold": (lambda i, r: 1 if i % 3 else i % 40, lambda i, r: i % 17),
    "null channels": (lambda i, r: None if i % 2 else 3, lambda i, r: i),
    "null times": (lambda i, r: i % 2, lambda i, r: None if i % 4 == 0 else i),
    "tiny channels": (lambda i, r: i // 2, lambda i, r: i),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("context", [1, 3, 8])
def test_windows_of_split_channels(spark, case, context):
    m = messages(spark, 160, *CASES[case]).cache()
    whole = sorted(map(str, windows.build_windows(m, context, ranges=1).collect()))
    assert sorted(map(str, windows.build_windows(m, context, ranges=30).collect())) == whole


def test_one_channel_is_many_tasks(spark):
    m = messages(spark, 4000, *CASES["one channel"])
    dealt = ranges.dealt(m, [F.col(c) for c in windows.ORDER], 16)
    sizes = [r["count"] for r in dealt.groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2.5 * 4000 / 16
    plan = windows.build_windows(m, ranges=16)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(channel_id#\d+L?, [^)]*_range", plan)


@pytest.mark.parametrize("case", CASES)
def test_ordinals_of_split_orders(spark, case):
    m = messages(spark, 300, *CASES[case])
    w = windows.build_windows(m, ranges=1).cache()
    one = {r.message_id: r.ordinal for r in packing.numbered(w, 1).collect()}
    assert {r.message_id: r.ordinal for r in packing.numbered(w, 12).collect()} == one and sorted(one.values()) == list(range(len(one)))
    assert packing.numbered(w.limit(0), 5).count() == 0


def test_no_window_holds_a_whole_channel_or_all_rows(spark):
    """Samples cut each stratum before the shuffle; ordinals and windows have a range in every window's key."""
    m = messages(spark, 50, *CASES["one channel"])
    plan = sampling.stratified_sample(windows.build_windows(m, ranges=1), 10, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    plan = packing.numbered(windows.build_windows(m, ranges=1), 8)._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in plan
    assert ranges.how_many(spark.range(10), None) == 1 and ranges.how_many(m, 5) == 5


def brute_sample(rows, n, floor):
    """The sample by lists: rows(message_id, channel, year, bucket)."""
    import hashlib
    from collections import Counter, defaultdict

    draw = {r[0]: (hashlib.md5(f"42{r[0]}".encode()).hexdigest(), r[0]) for r in rows}
    rows = sorted(rows, key=lambda r: draw[r[0]])
    seen, kept, pool = Counter(), [], []
    for r in rows:
        seen[r[1]] += 1
        (kept if seen[r[1]] <= floor else pool).append(r)
    size = Counter(r[1:] for r in pool)
    slots, total = max(0, n - len(kept)), len(pool)
    order = sorted(size, key=lambda s: (-size[s], [(x is None, x or "") for x in s]))
    alloc = {s: round(size[s] / total * slots) for s in order}
    drift = slots - sum(alloc.values())
    for s in order[: abs(drift)]:
        alloc[s] = alloc[s] + (1 if drift > 0 else -1)
    alloc = {s: max(0, min(size[s], a)) for s, a in alloc.items()}
    taken, first, rest = defaultdict(int), [], []
    for r in pool:
        taken[r[1:]] += 1
        (first if taken[r[1:]] <= alloc[r[1:]] else rest).append(r)
    return sorted(r[0] for r in (kept + first + rest)[:n])


@pytest.mark.parametrize(("n", "floor"), [(10, 2), (60, 3), (5, 4), (400, 1)])
def test_samples_equal_lists(spark, n, floor):
    rng = random.Random(n)
    rows = [(i, "hot" if i % 3 else rng.choice(["a", "b", None]), rng.choice([2023, 2024, None]), rng.choice(["short", "long"])) for i in range(300)]
    w = spark.createDataFrame(rows, "message_id long, channel_name string, year int, length_bucket string").repartition(7)
    assert sorted(r.message_id for r in sampling.stratified_sample(w, n, floor).collect()) == brute_sample(rows, n, floor)
