import datetime as dt
import json
import re

from tidemark.operators import store
from tidemark.sources.messages import MESSAGES
from tidemark.streaming import nightly


def test_second_run_scores_nothing_and_streams_append(spark, tmp_path):
    class Fixed:
        def answer(self, key, prompt):
            ids = re.findall(r"^id: (\d+)$", prompt, re.M)
            return json.dumps({"results": [{"message_id": i, "polarity": "neutral", "polarity_score": 0, "emotions": ["neutral"], "sarcasm": False, "toxicity": "none", "directed_at": "general", "confidence": 1, "rationale": "same"} for i in ids]})

    at = dt.datetime(2024, 1, 1)
    rows = [(i, "m", i % 3 if i % 4 else None, f"text {i}" if i % 9 else "\n", at + dt.timedelta(minutes=i), "ann", None, "c", None, None) for i in range(40)]
    base, inbox = f"file://{tmp_path}/results", f"file://{tmp_path}/in"
    spark.createDataFrame(rows[:20], MESSAGES).coalesce(1).write.parquet(f"{inbox}/a")
    spark.createDataFrame(rows[20:], MESSAGES).coalesce(1).write.parquet(f"{inbox}/b")
    got = []
    q = nightly.follow(spark, f"{inbox}/*", f"file://{tmp_path}/all", f"file://{tmp_path}/cp", lambda m, n: got.append(nightly.run(m, base, Fixed(), "fixed", f"2024-02-{n + 1:02d} 00:00:00")))
    q.awaitTermination(120)
    texts = sum(i % 9 != 0 for i in range(40))
    assert sum(g["written"] for g in got) == texts == store.read_current(spark, base).count()
    again = nightly.run(spark.createDataFrame(rows, MESSAGES), base, Fixed(), "fixed", "2024-03-01 00:00:00")
    assert again == {"batches": 0, "written": 0}


MANY = [(i, "m", 1, f"text {i}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), "ann", None, "c", None, None) for i in range(20)]


def scorers():
    """Scorers by value, as workers cannot import this file: one that answers ids nobody asked for, one that leaves the last id of a full batch out and fails on others, and a right one."""

    def answered(ids):
        return json.dumps({"results": [{"message_id": i, "polarity": "neutral", "polarity_score": 0, "emotions": ["neutral"], "sarcasm": False, "toxicity": "none", "directed_at": "general", "confidence": 1, "rationale": "same"} for i in ids]})

    class Wrong:
        def answer(self, key, prompt):
            return answered(["1", "2", "3"])

    class Forgetful:
        def answer(self, key, prompt):
            ids = re.findall(r"^id: (\d+)$", prompt, re.M)
            if len(ids) < 15:
                raise RuntimeError("down")
            return answered(ids[:-1])

    class Right:
        def answer(self, key, prompt):
            return answered(re.findall(r"^id: (\d+)$", prompt, re.M))

    return Wrong, Forgetful, Right


def test_answers_outside_their_batch_and_short_ones_do_not_count(spark, tmp_path):
    base, messages = f"file://{tmp_path}/results", spark.createDataFrame(MANY, MESSAGES)
    Wrong, Forgetful, Right = scorers()
    assert nightly.run(messages.where("message_id < 3"), base, Right(), "a", "2024-02-01 00:00:00") == {"batches": 1, "failed_batches": 0, "missing_ids": 0, "written": 3}
    before = sorted(map(tuple, store.read_current(spark, base).collect()))
    got = nightly.run(messages, base, Wrong(), "b", "2024-02-02 00:00:00")
    assert got == {"batches": 2, "failed_batches": 2, "missing_ids": 17, "written": 0}
    assert sorted(map(tuple, store.read_current(spark, base).collect())) == before
    got = nightly.run(messages, base, Forgetful(), "c", "2024-02-03 00:00:00")
    assert got == {"batches": 2, "failed_batches": 2, "missing_ids": 17, "written": 0}
    # the same night once more: answers are there for one batch, the failed one is asked again
    got = nightly.run(messages, base, Right(), "c", "2024-02-03 00:00:00")
    assert got["failed_batches"] == 1 and got["written"] == 2
    assert nightly.run(messages, base, Right(), "d", "2024-02-04 00:00:00")["written"] == 15
    assert store.read_current(spark, base).count() == 20


def test_a_writer_that_dies_leaves_the_old_version(spark, tmp_path):
    base = f"file://{tmp_path}/table"
    assert store.read_current(spark, base) is None
    store.write_version(spark.range(3), base)
    (tmp_path / "table/_commits/000000000002").touch()  # created, never named
    assert store.read_current(spark, base).count() == 3
    store.write_version(spark.range(5), base)
    assert store.read_current(spark, base).count() == 5 and len(store._commits(spark, base)) == 3
