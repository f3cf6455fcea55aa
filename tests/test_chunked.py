"""A scoring run goes on after crashes and failures, asks nothing twice that was answered, and tells what it used."""

import datetime as dt
import json
import re

import pytest

from tidemark.operators import packing, scoring, store, windows
from tidemark.sources.messages import MESSAGES
from tidemark.streaming import chunked

ROWS = [(i, "m", i % 2, f"text {i}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), "ann", None, "c", None, None) for i in range(23)]


def scorers(log):
    """Scorers by value, as workers cannot import this file. Each call leaves a line in a file of its own under log."""

    def said(prompt, **change):
        ids = re.findall(r"^id: (\d+)$", prompt, re.M)
        return json.dumps({"results": [{"message_id": i, "polarity": "neutral", "polarity_score": 0, "emotions": ["neutral"], "sarcasm": False, "toxicity": "none", "directed_at": "general", "confidence": 1, "rationale": "same"} | change for i in ids]})

    class Right:
        def answer(self, key, prompt):
            import uuid
            from pathlib import Path

            Path(f"{log}/{key}-{uuid.uuid4().hex}").touch()
            return scoring.Answer(said(prompt), 100, 10)

    class Fussy(Right):
        """Fails for one batch, leaves the last id of another out, and gives a label that is none to a third."""

        def answer(self, key, prompt):
            good = super().answer(key, prompt)
            if key == "batch-0":
                raise RuntimeError("down")
            if key == "batch-10":
                return scoring.Answer(json.dumps({"results": json.loads(good.text)["results"][:-1]}), 100, 9)
            if key == "batch-20":
                return scoring.Answer(said(prompt, polarity="odd"), 100, 0, 8)
            return good

    return Right, Fussy


def asked(tmp_path):
    out = {}
    for p in (tmp_path / "log").iterdir():
        key = p.name.rsplit("-", 1)[0]
        out[key] = out.get(key, 0) + 1
    return out


@pytest.fixture
def w(spark, tmp_path):
    (tmp_path / "log").mkdir()
    return windows.build_windows(spark.createDataFrame(ROWS, MESSAGES), ranges=1)


def test_a_run_continues_over_failures_and_a_second_one_mends_them(spark, w, tmp_path):
    base = f"file://{tmp_path}/runs"
    Right, Fussy = scorers(f"{tmp_path}/log")
    keys = [r.key for r in packing.prompts(packing.packed(w, 5)).orderBy("batch_id").collect()]
    assert keys == ["batch-0", "batch-10", "batch-20", "batch-7", "batch-17"]
    got = chunked.run(w, base, "r", Fussy(), every=2, batch_size=5, pause=None)
    assert (got["chunks"], got["batches"], got["failed_batches"], got["rows"]) == (3, 5, 3, 8)
    # three attempts of what fails in the attempt, one of what turns out to be invalid later
    assert asked(tmp_path) == {"batch-0": 3, "batch-10": 3, "batch-20": 1, "batch-7": 1, "batch-17": 1}
    assert (got["requests"], got["failures"], got["input_tokens"], got["output_tokens"]) == (9, 6, 600, 3 * 9 + 8 + 2 * 10)
    got = chunked.run(w, base, "r", Right(), every=2, batch_size=5)
    assert (got["failed_batches"], got["rows"], got["requests"]) == (0, 23, 12)
    assert asked(tmp_path) == {"batch-0": 4, "batch-10": 4, "batch-20": 2, "batch-7": 1, "batch-17": 1}
    again = chunked.run(w, base, "r", Right(), every=2, batch_size=5)
    assert again == got and sum(asked(tmp_path).values()) == 12
    rows = chunked.results(spark, base, "r")
    assert {int(r.message_id) for r in rows.collect()} == set(range(23)) and set(scoring.RESULTS.replace(",", "").split()[::2]) <= set(rows.columns)
    assert store.finalize(spark, f"{base}/r/checkpoint", f"{base}/final") == 23


def test_a_run_that_raises_keeps_what_it_paid_for(spark, w, tmp_path):
    base = f"file://{tmp_path}/runs"
    Right, Fussy = scorers(f"{tmp_path}/log")
    with pytest.raises(chunked.ScoringFailed, match="chunk 1 of r: 3 batches failed, the first with RuntimeError: down"):
        chunked.run(w, base, "r", Fussy(), every=3, batch_size=5, on_failure="raise", pause=None, attempts=1)
    assert set(asked(tmp_path)) == {"batch-0", "batch-10", "batch-20"}  # the second chunk was not begun
    got = chunked.run(w, base, "r", Right(), every=3, batch_size=5, on_failure="raise")
    assert (got["rows"], got["failed_batches"]) == (23, 0) and asked(tmp_path)["batch-10"] == 2
    with pytest.raises(ValueError):
        chunked.run(w, base, "r", Right(), on_failure="never")


def test_a_crash_between_chunks_and_between_answers_and_checkpoint(spark, w, tmp_path, monkeypatch):
    base = f"file://{tmp_path}/runs"
    Right, _ = scorers(f"{tmp_path}/log")
    real, calls = store.append_checkpoint, []

    def dies(*args):
        calls.append(1)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return real(*args)

    monkeypatch.setattr(store, "append_checkpoint", dies)
    with pytest.raises(KeyboardInterrupt):
        chunked.run(w, base, "r", Right(), every=2, batch_size=5)
    assert chunked.results(spark, base, "r").count() == 10 and sum(asked(tmp_path).values()) == 4
    got = chunked.run(w, base, "r", Right(), every=2, batch_size=5)
    assert (got["rows"], got["failed_batches"]) == (23, 0) and set(asked(tmp_path).values()) == {1}
    anew = chunked.run(w, base, "r", Right(), every=2, batch_size=5, resume=False)
    assert anew["rows"] == 23 and set(asked(tmp_path).values()) == {2} and anew["requests"] == 5
    assert chunked.run(w.limit(0), base, "none", Right())["batches"] == 0


def test_waits():
    assert [scoring.linear()(n) for n in (1, 2, 3)] == [1.5, 3.0, 4.5] and [scoring.doubling(20)(n) for n in (1, 2, 3, 9)] == [20, 40, 60, 60]
