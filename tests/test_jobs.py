import datetime as dt
import json

import pytest

from tidemark.operators import packing, scoring, store, windows
from tidemark.sources import files
from tidemark.sources.messages import MESSAGES
from tidemark.streaming import config, jobs

AT = dt.datetime(2024, 1, 1)
ROWS = [(i, "m", i % 3 if i % 4 else None, f"text {i}", AT + dt.timedelta(hours=9 * i), "ann", None, "c", None, None) for i in range(40)]


def result(i, polarity="neutral"):
    return {"message_id": str(i), "polarity": polarity, "polarity_score": 0, "emotions": ["neutral"], "sarcasm": False, "toxicity": "none", "directed_at": "general", "confidence": 1, "rationale": "same"}


def line(*results):
    return json.dumps({"response": {"text": json.dumps({"results": list(results)})}})


class Fake:
    """A service that is busy some times, whose jobs run for some polls and end in a given state."""

    def __init__(self, busy=0, polls=1, end="succeeded"):
        self.busy, self.polls, self.end, self.left, self.names = busy, polls, end, {}, []

    def submit(self, name, path):
        if self.busy:
            self.busy -= 1
            raise jobs.Busy
        self.names.append(name)
        self.left[name] = self.polls
        return name

    def state(self, job):
        self.left[job] -= 1
        return self.end if self.left[job] < 0 else "running"

    def output(self, job):
        return f"/out/{job}"


def test_submit_waits_longer_each_time():
    slept = []
    assert jobs.submit(Fake(busy=5), "a", "p", sleep=slept.append) == "a" and slept == [30, 60, 120, 240, 300]
    slept.clear()
    with pytest.raises(jobs.Busy):
        jobs.submit(Fake(busy=6), "a", "p", sleep=slept.append)
    assert len(slept) == 5


def test_chunks_run_in_turn_and_stop_at_a_failure():
    slept, got, t = [], [], Fake(polls=2)
    assert jobs.run_chunks(t, [("a", "p"), ("b", "q")], lambda n, p: got.append((n, p)), every=7, sleep=slept.append) == 2
    assert got == [("a", "/out/a"), ("b", "/out/b")] and slept == [7, 7, 7, 7]
    bad = Fake(end="failed")
    with pytest.raises(jobs.JobFailed):
        jobs.run_chunks(bad, [("a", "p"), ("b", "q")], lambda n, p: got.append(n), sleep=lambda s: None)
    assert bad.names == ["a"] and len(got) == 2


def test_a_job_that_does_not_end_meets_its_deadline():
    now = [0.0]

    def sleep(s):
        now[0] += s

    t = Fake(polls=10**9)
    with pytest.raises(TimeoutError):
        jobs.wait(t, t.submit("a", "p"), every=10, deadline=60, sleep=sleep, clock=lambda: now[0])
    assert now[0] == 60


def test_recovery_takes_the_later_job(spark, tmp_path):
    def file(name, *lines):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "part-0.jsonl").write_bytes(b"\n".join(x if isinstance(x, bytes) else x.encode() for x in lines))
        return f"file://{folder}"

    old = file("old", line(result(1, "positive"), result(2, "positive")), "", "{broken", line(result(3)))
    new = file("new", line(result(2, "negative")), line(result(2, "mixed")), line(result(99)), b'{"response":{"text":"\xff"}}')
    early = file("early", line(result(4)))
    listed = spark.createDataFrame([("j2", "succeeded", dt.datetime(2024, 3, 2), new), ("j1", "succeeded", dt.datetime(2024, 3, 1), old), ("j0", "succeeded", dt.datetime(2024, 1, 1), early), ("j3", "failed", dt.datetime(2024, 3, 3), "file:///none")], jobs.JOBS)
    assert [r.job_id for r in jobs.finished(listed).collect()] == ["j0", "j1", "j2"]
    base, m = f"file://{tmp_path}/table", spark.createDataFrame(ROWS, MESSAGES)
    for _ in range(2):  # twice is as once
        counts = jobs.recover(listed, m, base, "late", "2024-04-01 00:00:00", since="2024-02-01 00:00:00", checkpoint=f"file://{tmp_path}/cp", chunk=3)
        assert counts == {"lines": 8, "errors": 3, "written": 3, "skipped": 1, "checkpoint": True}
        assert {r.message_id: r.polarity for r in store.read_current(spark, base).collect()} == {1: "positive", 2: "mixed", 3: "neutral"}
    assert jobs.recover(listed, m, base, "late", "2024-04-02 00:00:00", checkpoint="none://nowhere/cp")["checkpoint"] is False
    assert {r.message_id for r in store.read_current(spark, base).collect()} == {1, 2, 3, 4}
    assert jobs.recover(listed.limit(0), m, base, "late", "2024-04-03 00:00:00")["lines"] == 0


def test_recovery_finds_every_line_of_odd_and_nested_paths(spark, tmp_path):
    """Spaces, percent signs and plus signs in names, a job's folder inside another's, a path without a scheme, a job that is one file."""
    at, made = dt.datetime(2024, 3, 1), []

    def job(k, name, i, path=None):
        folder = tmp_path / name
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"part {k}.jsonl").write_text(line(result(i, "mixed")))
        made.append((f"j{k}", "succeeded", at + dt.timedelta(days=k), path or f"file://{folder}"))

    job(0, "with space", 0)
    job(1, "a+b%20c", 1)
    job(2, "plain", 2)
    job(3, "plain/sub", 3)
    job(4, "bare", 4, str(tmp_path / "bare"))
    job(5, "one", 5, f"file://{tmp_path}/one/part 5.jsonl")
    base, m = f"file://{tmp_path}/table", spark.createDataFrame(ROWS, MESSAGES)
    listed = spark.createDataFrame(made, jobs.JOBS)
    lines = jobs.answers(spark, jobs.finished(listed))
    assert sorted((r.seq.job_id, json.loads(json.loads(r.value)["response"]["text"])["results"][0]["message_id"]) for r in lines.collect()) == [(f"j{i}", str(i)) for i in range(6)]
    assert "NestedLoop" not in lines._jdf.queryExecution().executedPlan().toString()
    assert jobs.recover(listed, m, base, "late", "2024-04-01 00:00:00") == {"lines": 6, "errors": 0, "written": 6, "skipped": 0, "checkpoint": False}
    assert {r.message_id for r in store.read_current(spark, base).collect()} == set(range(6))
    assert not [p for p in (tmp_path / "table").iterdir() if p.name.startswith("_recovered")]


def test_a_line_of_no_job_stops_the_recovery(spark, tmp_path, monkeypatch):
    folder = tmp_path / "job"
    folder.mkdir()
    (folder / "a.jsonl").write_text(line(result(1)))
    (folder / "b.jsonl").write_text(line(result(2)))
    listed = spark.createDataFrame([("j", "succeeded", AT, f"file://{folder}")], jobs.JOBS)
    real = jobs.read_answers
    monkeypatch.setattr(jobs, "files_of", lambda s, j: s.createDataFrame([(f"file:{folder}/a.jsonl", "j", AT)], "file string, job_id string, create_time timestamp_ntz"))
    monkeypatch.setattr(jobs, "read_answers", lambda s, paths: real(s, [f"file://{folder}"]))
    with pytest.raises(Exception, match="a line of no job in .*b.jsonl"):
        jobs.recover(listed, spark.createDataFrame(ROWS, MESSAGES), f"file://{tmp_path}/table", "late", "2024-04-01 00:00:00")
    assert store.read_current(spark, f"file://{tmp_path}/table") is None


def test_a_failed_checkpoint_is_told(spark, tmp_path):
    folder = tmp_path / "job"
    folder.mkdir()
    (folder / "a.jsonl").write_text(line(result(1)))
    listed = spark.createDataFrame([("j", "succeeded", AT, f"file://{folder}")], jobs.JOBS)
    got = jobs.recover(listed, spark.createDataFrame(ROWS, MESSAGES), f"file://{tmp_path}/table", "late", "2024-04-02 00:00:00", checkpoint="none://nowhere/cp")
    assert got["written"] == 1 and not got["checkpoint"] and "none" in got["checkpoint_error"]


def test_inline_answers_come_before_files(spark, tmp_path):
    folder = tmp_path / "job"
    folder.mkdir()
    (folder / "a.jsonl").write_text(line(result(1, "negative")))
    path = f"file://{folder}"
    made = [("j1", "succeeded", AT, path, [line(result(2)), "", line(result(3))]), ("j2", "succeeded", AT, path, []), ("j3", "succeeded", AT, None, None), ("j4", "succeeded", AT, "", [])]
    listed = spark.createDataFrame(made, jobs.JOBS_INLINE)
    got = sorted((r.seq.job_id, r.seq.row, r.value) for r in jobs.answers(spark, jobs.finished(listed)).collect() if r.seq.job_id == "j1")
    assert got == [("j1", 0, line(result(2))), ("j1", 1, ""), ("j1", 2, line(result(3)))]
    counts = jobs.recover(listed, spark.createDataFrame(ROWS, MESSAGES), f"file://{tmp_path}/table", "m", "2024-04-01 00:00:00")
    assert counts == {"lines": 4, "errors": 1, "written": 3, "skipped": 0, "checkpoint": False}
    assert jobs.file_name("abc") == jobs.file_name("files/abc") == "files/abc"


def test_the_command_line_runs_a_night(spark, tmp_path, monkeypatch):
    """python -m tidemark.streaming.config --limit N, with a scorer that the environment names."""
    import sys
    import types

    def made(model):
        class Right:
            def answer(self, key, prompt):
                import re

                return json.dumps({"results": [{"message_id": i, "polarity": "neutral", "polarity_score": 0, "emotions": ["neutral"], "sarcasm": False, "toxicity": "none", "directed_at": "general", "confidence": 1, "rationale": model} for i in re.findall(r"^id: (\d+)$", prompt, re.M)]})

        return Right()

    monkeypatch.setitem(sys.modules, "odd_scorers", types.SimpleNamespace(made=made))
    files.write_messages(spark.createDataFrame(ROWS, MESSAGES), f"file://{tmp_path}/messages")
    env = {"TIDEMARK_MESSAGES": f"file://{tmp_path}/messages", "TIDEMARK_RESULTS": f"file://{tmp_path}/table", "TIDEMARK_SCORER": "odd_scorers:made", "TIDEMARK_MODEL": "right"}
    assert config.main(["--limit", "7", "--now", "2024-05-01 00:00:00"], env)["written"] == 7
    got = store.read_current(spark, env["TIDEMARK_RESULTS"]).collect()
    assert {r.message_id for r in got} == set(range(7)) and {r.model for r in got} == {r.rationale for r in got} == {"right"}
    assert config.main([], env)["written"] == 33 and config.main([], env) == {"batches": 0, "written": 0}


def test_files_round_trip(spark, tmp_path):
    path = f"file://{tmp_path}"
    m = spark.createDataFrame(ROWS, MESSAGES)
    with pytest.raises(FileNotFoundError, match="export"):
        files.read_messages(spark, f"{path}/messages")
    files.write_messages(m, f"{path}/messages")
    assert sorted(files.read_messages(spark, f"{path}/messages").collect()) == sorted(m.collect())
    assert files.read_messages(spark, f"{path}/messages", ["message_id", "content"]).columns == ["message_id", "content"]
    with pytest.raises(ValueError):
        files.read_messages(spark, f"{path}/messages", ["none"])
    files.write_windows(m, f"{path}/windows")
    w = files.read_windows(spark, f"{path}/windows")
    assert sorted(w.collect()) == sorted(windows.build_windows(m).collect())
    files.write_sample(w.where("message_id < 5"), path, "small")
    assert files.read_sample(spark, path, "small").count() == 5
    with pytest.raises(FileNotFoundError, match="checkpoint"):
        store.finalize(spark, f"{path}/cp", f"{path}/final")
    rows = spark.createDataFrame([("1", 0, "a"), ("1", 1, "b"), ("2", 0, "c")], "message_id string, position int, polarity string")
    store.append_checkpoint(rows, f"{path}/cp", 1)
    assert store.finalize(spark, f"{path}/cp", f"{path}/final") == 2


def test_request_files_and_packing_over_days(spark, tmp_path):
    m = spark.createDataFrame(ROWS, MESSAGES)
    w = windows.build_windows(m)
    got = [r.message_id for r in packing.packed(w, 3, 2).orderBy("ordinal").collect()]
    assert got == [r[0] for r in sorted(ROWS, key=lambda r: (r[2] is None, r[2] or 0, r[4], r[0]))]
    batches = packing.prompts(packing.packed(w, 3, 2))
    path = f"file://{tmp_path}/requests"
    assert packing.write_requests(batches, path) == {f"requests_{k:03d}": 2 for k in range(1, 8)}
    assert len(packing.write_requests(batches.where("chunk_id < 3"), path)) == 2
    # another prefix in the folder stays, and a file's lines are in the order of its batches
    assert len(packing.write_requests(batches, path, "more")) == 7 and packing.write_requests(batches.where("chunk_id = 1"), path) == {"requests_001": 2}
    names = sorted(p.name for p in (tmp_path / "requests").iterdir() if not p.name.startswith("."))
    assert names == sorted([f"more_{k:03d}.jsonl" for k in range(1, 8)] + ["requests_001.jsonl"])
    keys = [json.loads(x)["key"] for k in range(1, 8) for x in (tmp_path / f"requests/more_{k:03d}.jsonl").read_text().splitlines()]
    assert keys == [r.key for r in batches.orderBy("batch_id").collect()]
    first = json.loads(packing.request_lines(batches).first().value)["request"]
    assert first["generation_config"]["response_schema"] == scoring.output_schema() and first["contents"][0]["parts"][0]["text"]


def test_config():
    with pytest.raises(ValueError, match="TIDEMARK_RESULTS"):
        config.Config.from_environment({"TIDEMARK_MESSAGES": "m"})
    c = config.Config.from_environment({"TIDEMARK_MESSAGES": "m", "TIDEMARK_RESULTS": "r", "TIDEMARK_SCORER": "collections:Counter"})
    assert c.model == "double" and c.make_scorer()["d"] == 1
    with pytest.raises(SystemExit):
        config.main(["--limit", "-1"], {})


def test_commands_take_a_corpus_from_requests_to_the_report(spark, tmp_path):
    from tidemark.__main__ import main

    files.write_messages(spark.createDataFrame(ROWS, MESSAGES), f"file://{tmp_path}/messages")
    env = {"TIDEMARK_MESSAGES": f"file://{tmp_path}/messages", "TIDEMARK_RESULTS": f"file://{tmp_path}/table"}
    cost = main(["estimate"], env)
    assert (cost["n_messages"], cost["n_batches"], cost["output_tokens"]) == (40, 3, 3600)
    assert main(["requests", "--out", f"file://{tmp_path}/out", "--lines", "2"], env) == {"requests_001": 2, "requests_002": 1}
    keys = [json.loads(x)["key"] for p in sorted((tmp_path / "out").glob("*.jsonl")) for x in p.read_text().splitlines()]
    assert len(keys) == 3
    (tmp_path / "jobs.json").write_text("\n".join(json.dumps(j) for j in [
        {"job_id": "a", "state": "succeeded", "create_time": "2024-03-01T00:00:00", "inline": [line(*[result(i, "mixed") for i in range(30)])]},
        {"job_id": "b", "state": "running", "create_time": "2024-03-02T00:00:00"},
    ]))
    assert main(["recover", "--jobs", f"file://{tmp_path}/jobs.json", "--now", "2024-04-01 00:00:00"], env) == {"lines": 1, "errors": 0, "written": 30, "skipped": 0, "checkpoint": False}
    assert main(["estimate"], env)["n_messages"] == 10
    main(["report", "--out", f"file://{tmp_path}/page.html", "--least", "1"], env)
    assert "30" in (tmp_path / "page.html").read_text(encoding="utf-8") and (tmp_path / "page.html").read_text(encoding="utf-8").count("<svg") == 4
    with pytest.raises(SystemExit):
        main(["estimate", "--odd"], env)
