import datetime as dt

import pytest

from tidemark.operators import packing, windows

SCHEMA = "message_id long, member_id string, channel_id long, channel_name string, author_name string, content string, created_at timestamp_ntz"


def messages(spark, rows):
    at = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(i, "m", c, "c", a, t, at + dt.timedelta(minutes=m)) for i, c, a, t, m in rows], SCHEMA)


def test_blank_priors_take_a_slot_and_null_channels_have_none(spark):
    m = messages(spark, [(1, 7, "ann", "one", 0), (2, 7, "bob", " \n", 1), (3, 7, "cy", "three", 2), (4, 7, "di", "four", 2), (5, 7, "ed", "five", 3), (6, None, "x", "lone", 0), (7, None, "y", "lone too", 1)])
    got = {r.message_id: (r.n_priors, r.context_text) for r in windows.build_windows(m).collect()}
    assert set(got) == {1, 3, 4, 5, 6, 7}
    assert got[3] == (1, "[ann] one\n>>> TARGET [cy] three")
    assert got[4] == (2, "[ann] one\n[cy] three\n>>> TARGET [di] four")
    assert got[5] == (2, "[cy] three\n[di] four\n>>> TARGET [ed] five")
    assert got[6][0] == got[7][0] == 0
    assert windows.build_windows(m, skip_blank=False).count() == 7


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="channel_name"):
        windows.build_windows(spark.createDataFrame([(1,)], "message_id long"))


@pytest.mark.parametrize("n", [0, 1, 15, 16, 31])
def test_packing_is_gap_free(spark, n):
    m = messages(spark, [(i, i % 3 if i % 5 else None, "a", f"text {i}", i) for i in range(n)])
    p = packing.packed(windows.build_windows(m))
    rows = p.orderBy("ordinal").collect()
    assert [r.ordinal for r in rows] == list(range(n))
    assert [r.batch_id for r in rows] == [i // 15 for i in range(n)]
    cost = packing.cost(packing.prompts(p)).first()
    assert (cost.n_messages, cost.n_batches, cost.output_tokens) == (n, -(-n // 15), 90 * n)


def test_nightly_scores_nothing_twice_and_keeps_scored_priors(spark):
    m = messages(spark, [(1, 1, "a", "x", 0), (2, 1, "b", "y", 1), (3, None, "c", "z", 2), (4, 2, "d", "\n", 0)])
    done = spark.createDataFrame([("1",)], "message_id string")
    got = {r.message_id: r.n_priors for r in windows.nightly_targets(m, done).collect()}
    assert got == {2: 1, 3: 0}
    assert windows.nightly_targets(m, spark.createDataFrame([("1",), ("2",), ("3",)], "message_id string")).count() == 0
