import json

import pytest

from tidemark.operators import evaluate, sampling, scoring, store


def line(**change):
    r = {"message_id": "1", "polarity": "positive", "polarity_score": 0.5, "emotions": ["joy"], "sarcasm": False, "toxicity": "none", "directed_at": "general", "confidence": 0.9, "rationale": "fine"} | change
    return {k: v for k, v in r.items() if v != "absent"}


def wrapped(*results, bare=False):
    inner = {"candidates": [{"content": {"parts": [{"text": json.dumps({"results": list(results)})}]}}]}
    return json.dumps(inner if bare else {"response": inner})


CASES = [
    ("", "blank"), ("{oops", "bad_json"), ('{"error":{"code":1}}', "error"), ('{"error":1,"response":{"text":"{\\"results\\":[]}"}}', "ok"), ('{"response":{}}', "no_text"),
    (wrapped(line(), line(polarity_score=1.5)), "invalid"), (wrapped(line(emotions=["joy"] * 4)), "invalid"), (wrapped(line(emotions=["joy", "joy"])), "ok"), (wrapped(line(emotions=["JOY "])), "ok"),
    (wrapped(line(polarity="Positive")), "invalid"), (wrapped(line(rationale="x" * 201)), "invalid"), (wrapped(line(polarity_score="0.5", sarcasm="yes", extra=1)), "ok"), (wrapped(line(confidence="absent")), "invalid"), (wrapped(line(message_id=7), bare=True), "ok"),
]


def test_answer_lines(spark):
    parsed = scoring.parse_lines(spark.createDataFrame(list(enumerate(c[0] for c in CASES)), "seq long, value string"))
    assert [r.status for r in parsed.orderBy("seq").collect()] == [c[1] for c in CASES]
    rows = {(r.seq, r.position): r for r in scoring.result_rows(parsed).collect()}
    assert rows[(7, 0)].emotions == "joy" and rows[(11, 0)].sarcasm is True and rows[(13, 0)].message_id == "7"


def test_failing_scorer_keeps_its_error(spark):
    class Odd:
        def answer(self, key, prompt):
            if key == "b":
                raise RuntimeError("no")
            return prompt.upper()

    got = {r.key: (r.answer, r.error) for r in scoring.score_batches(spark.createDataFrame([("a", "x"), ("b", "y")], "key string, prompt string"), Odd()).collect()}
    assert got == {"a": ("X", None), "b": (None, "RuntimeError: no")}


def results(spark, ids, polarity="Positive "):
    return spark.createDataFrame([(i, polarity, 0.1, "joy", True, "none", "general", 0.5, "r" * 300) for i in ids], scoring.RESULTS)


def test_upsert(spark, tmp_path):
    messages = spark.createDataFrame([(1,), (2,), (3,)], "message_id long")
    empty = store.upserted(store.normalised(results(spark, []), "m").selectExpr("*", "timestamp_ntz'2024-01-01' as scored_at", "timestamp_ntz'2024-01-01' as updated_at"), store.normalised(results(spark, ["1", "2", "9", "abc", "-1", "9" * 20]), "m"), messages, "2024-01-02")
    first = {r.message_id: r for r in empty.collect()}
    assert set(first) == {1, 2} and first[1].polarity == "positive" and len(first[1].rationale) == 255
    base = f"file://{tmp_path}/table"
    assert store.read_current(spark, base) is None
    store.write_version(empty, base)
    for _ in range(2):  # twice is as once
        store.write_version(store.upserted(store.read_current(spark, base), store.normalised(results(spark, ["2", "3"], "mixed"), "n"), messages, "2024-01-03"), base)
    got = {r.message_id: (r.polarity, r.model, str(r.scored_at)[:10], str(r.updated_at)[:10]) for r in store.read_current(spark, base).collect()}
    assert got == {1: ("positive", "m", "2024-01-02", "2024-01-02"), 2: ("mixed", "n", "2024-01-02", "2024-01-03"), 3: ("mixed", "n", "2024-01-03", "2024-01-03")}


def test_checkpoint_keeps_the_last(spark, tmp_path):
    base = f"file://{tmp_path}/run"
    rows = lambda p: spark.createDataFrame([("1", 0, p), ("1", 1, p + "!"), (p, 0, p)], "message_id string, position int, polarity string")
    store.append_checkpoint(rows("a"), base, 1)
    store.append_checkpoint(rows("b"), base, 2)
    assert {(r.message_id, r.polarity) for r in store.read_checkpoint(spark, base).collect()} == {("1", "b!"), ("a", "a"), ("b", "b")}


def test_gold(spark):
    p = results(spark, ["1", "2", "3", "4"], "positive")
    gold = spark.createDataFrame([("1", " POSITIVE", "TRUE", "None"), ("2", "negative", "no", "severe"), ("3", "", "1", "none"), ("4", "positive", "maybe", None)], "message_id string, gold_polarity string, gold_sarcasm string, gold_toxicity string")
    r = evaluate.evaluate(p, gold).first()
    assert (r.n_labeled, r.polarity_accuracy, r.sarcasm_accuracy, r.toxicity_accuracy) == (3, pytest.approx(2 / 3), 0.5, 0.5) and r.sarcasm_f1 == pytest.approx(2 / 3)
    none = evaluate.evaluate(p, gold.where("message_id = '3'")).first()
    assert none.n_labeled == 0 and none.polarity_accuracy is None and none.sarcasm_f1 is None


@pytest.mark.parametrize(("n", "floor"), [(10, 2), (3, 5), (500, 3), (37, 1)])
def test_sample_size(spark, n, floor):
    rows = [(i, f"c{i % 7 % 5}", 2024 + i % 2, "short" if i % 3 else "long") for i in range(120)]
    w = spark.createDataFrame(rows, "message_id long, channel_name string, year int, length_bucket string")
    a, b = (sorted(r.message_id for r in sampling.stratified_sample(x, n, floor).collect()) for x in (w, w.repartition(3)))
    assert a == b and len(set(a)) == min(n, 120)
    if n >= 5 * floor:
        assert {rows[i][1] for i in a} == {f"c{k}" for k in range(5)}


NULLS = [
    ('{"error":null,"candidates":[{"content":{"parts":[{"text":"{\\"results\\":[]}"}]}}]}', "error"), ('{"error":null,"response":{"text":"{\\"results\\":[]}"}}', "ok"), ('{"response":null,"text":"{\\"results\\":[]}"}', "no_text"),
    ('{"candidates":[{"content":{"parts":[{"text":null}]}}],"text":"{\\"results\\":[]}"}', "no_text"), ('{"candidates":[],"text":"{\\"results\\":[]}"}', "ok"), ('{"text":""}', "no_text"), ("[1]", "bad_json"), ('  {"text":"{\\"results\\":[]}"} ', "ok"),
    ('{"response":"text"}', "no_text"), ('{"response":{"text":5}}', "bad_payload"), ('{"text":"{\\"results\\":{}}"}', "bad_payload"), (None, "blank"), ("null", "bad_json"), ('{"response":{"error":1}}', "no_text"),
]


def test_keys_that_are_there_with_null(spark):
    parsed = scoring.parse_lines(spark.createDataFrame(list(enumerate(c[0] for c in NULLS)), "seq long, value string"))
    assert [r.status for r in parsed.orderBy("seq").collect()] == [c[1] for c in NULLS]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("evaluateParseJson") <= 1 and plan.count("from_json") + plan.count("jsonToStructs") <= 1 and "get_json_object" not in plan


def test_scorers_that_leave_ids_out_are_asked_again(spark):
    class Short:
        def __init__(self):
            self.n = 0

        def answer(self, key, prompt):
            self.n += 1
            return scoring.Answer(json.dumps({"results": [{"message_id": i} for i in ("1", "2", "9")[: self.n if key == "a" else 1]]}), 7, 0, 3)

    got = {r.key: r for r in scoring.ask(spark.createDataFrame([("a", "p", ["1", "2"]), ("b", "p", ["1", "2"])], "key string, prompt string, ids array<string>").coalesce(1).sortWithinPartitions("key"), Short()).collect()}
    assert [a.failed for a in got["a"].attempts] == [True, False] and got["a"].error is None
    assert len(got["b"].attempts) == 3 and "1 of 2 ids are left out: ['2']" in got["b"].error and got["b"].answer
    log = scoring.request_log(spark.createDataFrame([got["a"], got["b"]], f"key string, answer string, error string, attempts {scoring.ATTEMPTS}"))
    from tidemark.operators import analytics

    used = analytics.usage(log).first()
    assert (used.requests, used.failures, used.input_tokens, used.output_tokens) == (5, 4, 35, 15)


def test_gold_files_and_the_bar(spark, tmp_path):
    """Label files as they come back: empty cells are missing, the word None is a label; the template goes out as one file."""
    from tidemark.sources.messages import read_gold

    (tmp_path / "gold.csv").write_text('message_id,content,gold_polarity,gold_sarcasm,gold_toxicity\n1,"two\nlines, ""quoted""",positive, ,None\n2,x,,true,none\n')
    rows = read_gold(spark, f"file://{tmp_path}/gold.csv").orderBy("message_id").collect()
    assert [tuple(r) for r in rows] == [("1", 'two\nlines, "quoted"', "positive", None, "None"), ("2", "x", None, "true", "none")]
    sample = spark.createDataFrame([(i, "c", "ann", f'text "{i}",\n', "ctx", "neutral", True, "none") for i in range(9, 0, -1)], "message_id long, channel_name string, author_name string, content string, context_text string, polarity string, sarcasm boolean, toxicity string")
    evaluate.write_gold_template(sample, f"file://{tmp_path}/template", 4)
    assert len(list((tmp_path / "template").glob("*.csv"))) == 1
    back = read_gold(spark, f"file://{tmp_path}/template").orderBy("message_id").collect()
    assert [r.message_id for r in back] == ["1", "2", "3", "4"] and back[0].content == 'text "1",\n' and back[0].gold_polarity is None and back[0].pred_polarity == "neutral"
    bar = evaluate.passes_bar(spark.createDataFrame([(0.75,), (0.74,), (None,)], "polarity_accuracy double")).collect()
    assert [r.passes for r in bar] == [True, False, None]


def test_cost_of_windows_is_that_of_their_prompts(spark):
    from tidemark.operators import packing

    rows = [(i, None, f"c{i}", f"context {i}", None) for i in range(31)]
    w = spark.createDataFrame(rows, "message_id long, channel_id long, channel_name string, context_text string, created_at timestamp_ntz")
    assert packing.cost_of_windows(w).collect() == packing.cost(packing.prompts(packing.packed(w))).collect()
    assert packing.cost_of_windows(w, 10).first().n_batches == 4


def test_gold_labels_that_are_no_booleans_count_when_strict(spark):
    p = spark.createDataFrame([(str(i), "positive", s, "none") for i, s in enumerate(["true", "false", "true", None, "maybe", "false"])], "message_id string, polarity string, sarcasm string, toxicity string")
    gold = spark.createDataFrame([(str(i), "positive", s, None) for i, s in enumerate(["TRUE", "", "on", "no", "maybe", None])], "message_id string, gold_polarity string, gold_sarcasm string, gold_toxicity string")
    r = evaluate.evaluate(p, gold, strict=True).first()
    # hits: 0 and 4 of five labels; true by label: 0, 2, 4; true by prediction: 0, 2, 3 (missing), 4
    assert (r.n_labeled, r.sarcasm_accuracy) == (6, pytest.approx(2 / 5)) and r.sarcasm_f1 == pytest.approx(2 * 3 / (2 * 3 + 1)) and r.toxicity_accuracy is None
    loose = evaluate.evaluate(p, gold).first()
    assert loose.sarcasm_accuracy == pytest.approx(1.0) and loose.sarcasm_f1 == pytest.approx(1.0)  # 0, 2 and 3 alone are booleans
