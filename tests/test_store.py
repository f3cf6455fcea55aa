"""Tables that several writers share: commits that are compared and set, unique keys, buckets that are written only where they change."""

import threading

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scoring, store, windows
from tidemark.sources import keyed

ROW = (0.1, "joy", True, "none", "general", 0.5, "why")


def results(spark, ids, polarity="positive"):
    return store.normalised(spark.createDataFrame([(str(i), polarity, *ROW) for i in ids], scoring.RESULTS), "m")


def messages(spark, n=100):
    return spark.range(n).select(F.col("id").alias("message_id"))


def held(spark, base):
    return {r.message_id: (r.polarity, str(r.scored_at)[:10], str(r.updated_at)[:10]) for r in store.read_current(spark, base).collect()}


def test_a_version_that_was_read_is_compared(spark, tmp_path):
    base = f"file://{tmp_path}/t"
    store.write_version(spark.range(1), base)
    a = keyed.read(spark, base)
    store.write_version(spark.range(3), base)
    with pytest.raises(keyed.Conflict):
        store.write_version(spark.range(9), base, after=a.number)
    assert store.read_current(spark, base).count() == 3 and len(list((tmp_path / "t").glob("version-*"))) == 2


def test_interleaved_upserts_both_survive(spark, tmp_path, monkeypatch):
    """Between the reading and the commit of one upsert another one commits, in the same bucket and in others."""
    base, real, m = f"file://{tmp_path}/t", store.merged, messages(spark)
    store.upsert(spark, base, results(spark, [0, 1]), m, "2024-01-01", 4)
    once = []

    def meanwhile(old, new, now):
        out = real(old, new, now)
        if not once:
            once.append(1)
            assert store.upsert(spark, base, results(spark, [1, 2, 3], "mixed"), m, "2024-01-02") == {"written": 3, "skipped": 0}
        return out

    monkeypatch.setattr(store, "merged", meanwhile)
    assert store.upsert(spark, base, results(spark, [*range(3, 30), 200], "negative"), m, "2024-01-03") == {"written": 27, "skipped": 1}
    want = {0: ("positive", "2024-01-01", "2024-01-01"), 1: ("mixed", "2024-01-01", "2024-01-02"), 2: ("mixed", "2024-01-02", "2024-01-02"), 3: ("negative", "2024-01-02", "2024-01-03")}
    assert held(spark, base) == want | {i: ("negative", "2024-01-03", "2024-01-03") for i in range(4, 30)}
    named = {f for _, f in keyed.read(spark, base).parts}
    assert named <= {p.name for p in (tmp_path / "t").iterdir()} and len(keyed.commits(spark, base)) == 4


def test_many_writers_at_once(spark, tmp_path):
    base, m, failed = f"file://{tmp_path}/t", messages(spark), []

    def write(k):
        try:
            store.upsert(spark, base, results(spark, [k, 50 + k, 99], f"p{k}"), m, f"2024-01-0{k + 1}", 4)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join(300) for t in threads]
    got = held(spark, base)
    assert not failed and set(got) == {*range(4), *range(50, 54), 99} and all(got[k][0] == got[50 + k][0] == f"p{k}" for k in range(4))


def test_one_id_in_two_spellings_is_one_row(spark, tmp_path):
    base, m = f"file://{tmp_path}/t", messages(spark)
    said = spark.createDataFrame([("1", "positive", *ROW, 0, 0), ("01", "negative", *ROW, 0, 1), ("2", "mixed", *ROW, 1, 0), ("0002", "neutral", *ROW, 0, 5), ("x", "mixed", *ROW, 0, 2)], scoring.RESULTS + ", seq int, position int")
    assert store.upsert(spark, base, store.latest(said, "m"), m, "2024-01-01", 4) == {"written": 2, "skipped": 0}
    assert {k: v[0] for k, v in held(spark, base).items()} == {1: "negative", 2: "mixed"}
    with pytest.raises(store.DuplicateKeys):
        store.upsert(spark, base, store.normalised(said.drop("seq", "position"), "m"), m, "2024-01-02")
    assert {k: v[0] for k, v in held(spark, base).items()} == {1: "negative", 2: "mixed"}
    with pytest.raises(Exception, match="two new rows have message_id 1"):
        store.merged(store.read_current(spark, base), results(spark, ["1", "01"]), "2024-01-02").collect()


def test_an_upsert_writes_the_buckets_it_changes(spark, tmp_path):
    base, m = f"file://{tmp_path}/t", messages(spark, 1000)
    store.upsert(spark, base, results(spark, range(500)), m, "2024-01-01", 16)
    before = keyed.read(spark, base)
    assert len(before.parts) == 16
    store.upsert(spark, base, results(spark, [7, 501], "mixed"), m, "2024-01-02")
    after = keyed.read(spark, base)
    new = [p for p in after.parts if p not in before.parts]
    assert 1 <= len(new) <= 2 and len(after.parts) == 16 and {f for _, f in new} != {f for _, f in before.parts}
    folder = tmp_path / "t" / new[0][1]
    assert sum(1 for _ in folder.glob("bucket=*")) == len(new)
    got = held(spark, base)
    assert len(got) == 501 and got[7] == ("mixed", "2024-01-01", "2024-01-02") and got[501][0] == "mixed" and got[8][0] == "positive"
    assert store.upsert(spark, base, results(spark, [5000]), m, "2024-01-03") == {"written": 0, "skipped": 1} and keyed.read(spark, base).number == after.number
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("rows-")) == sorted({f for _, f in [*before.parts, *after.parts]})


def test_the_anti_join_shuffles_no_side(spark, tmp_path):
    """Messages and results with as many buckets: no exchange in the plan, and the same rows as by text."""
    from pyspark.sql import SparkSession  # noqa: F401

    rows = spark.range(300).select(F.col("id").alias("message_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("content"))
    keyed.append(rows.where("message_id < 200"), f"file://{tmp_path}/archive", "message_id", 8)
    archive = keyed.append(rows.where("message_id >= 200"), f"file://{tmp_path}/archive", "message_id", note={"to": 300})
    assert archive.note == {"to": 300} and archive.table().count() == 300
    store.upsert(spark, f"file://{tmp_path}/t", results(spark, range(0, 300, 3)), rows, "2024-01-01", 8)
    done = keyed.read(spark, f"file://{tmp_path}/t").bucketed()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = windows.unscored(archive.bucketed(), done)
        assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
        assert {r.message_id for r in left.collect()} == {i for i in range(300) if i % 3}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_old_tables_get_buckets_and_odd_paths_work(spark, tmp_path):
    base = f"file://{tmp_path}/it's a table"
    m = messages(spark)
    store.write_version(store.upserted(store.create(spark, f"file://{tmp_path}/none", 4).table(), results(spark, [1, 2]), m, "2024-01-01"), base)
    assert store.upsert(spark, base, results(spark, [2, 3], "mixed"), m, "2024-01-02", 4) == {"written": 2, "skipped": 0}
    assert held(spark, base) == {1: ("positive", "2024-01-01", "2024-01-01"), 2: ("mixed", "2024-01-01", "2024-01-02"), 3: ("mixed", "2024-01-02", "2024-01-02")}
    assert keyed.read(spark, base).bucketed().count() == 3 and store.read_current(spark, f"file://{tmp_path}/none").count() == 0


def test_vacuum_leaves_what_is_named_or_young(spark, tmp_path):
    import time

    base, m = f"file://{tmp_path}/t", messages(spark)
    for k in range(4):
        store.upsert(spark, base, results(spark, [1, 2], f"p{k}"), m, f"2024-01-0{k + 1}", 1)
    before = held(spark, base)
    assert keyed.vacuum(spark, base) == []  # all are young
    later = lambda: time.time() + 8 * 86_400
    assert len(keyed.vacuum(spark, base, keep=2, now=later)) == 2 and held(spark, base) == before
    assert len(keyed.vacuum(spark, base, keep=1, now=later)) == 1 and held(spark, base) == before
    assert keyed.vacuum(spark, f"file://{tmp_path}/none") == []
    with pytest.raises(ValueError):
        keyed.vacuum(spark, base, keep=0)
