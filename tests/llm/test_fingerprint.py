import base64
import hashlib
import random

import pytest
from frames import empty_documents, odd_documents

from pyspark.sql import functions as F

from tidemark.llm import fingerprint


def pieces(t):
    return {line[i : i + fingerprint.PIECE] for line in (t or "").split("\n") for i in range(0, len(line), fingerprint.PIECE)}


def near(a, b):
    a, b = pieces(a), pieces(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_against_sets(spark):
    rng = random.Random(4)
    line = lambda: "".join(rng.choice("abcé ") for _ in range(rng.choice([3, 40, 200])))
    texts = ["\n".join(line() for _ in range(rng.choice([1, 2, 5, 30, 120]))) for _ in range(20)]
    texts += [texts[0], texts[1] + "\n" + line(), "", None, "same\n" * 50, "\n".join(str(i) for i in range(700))]
    got = {r.doc_id: r for r in fingerprint.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    for i, t in enumerate(texts):
        t, follow = t or "", texts[(i + 1) % len(texts)] or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + follow[:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - near(t, edited)) < 1e-12 and abs(r.near_next - near(t, follow)) < 1e-12
    assert got[0].fingerprint == got[20].fingerprint != got[21].fingerprint and got[22].fingerprint == got[23].fingerprint


def test_odd_and_empty_tables(spark):
    got = fingerprint.fingerprints(odd_documents(spark)).collect()
    assert len(got) == 8 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and r.fingerprint for r in got)
    assert fingerprint.fingerprints(empty_documents(spark)).count() == 0
    assert fingerprint.fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first().near_next == 1.0


def cells(text):
    """Groups of the published fingerprint, each a list of (count, digest, check)."""
    n, body = text.split(":", 1)
    raw = base64.b64decode("".join(body.split()))
    flat = [(raw[i], raw[i + 1 : i + 9], raw[i + 9 : i + 11]) for i in range(0, len(raw), 11)]
    each = len(flat) // int(n)
    return [flat[i : i + each] for i in range(0, len(flat), each)]


def xor(a, b):
    return bytes(x ^ y for x, y in zip(a, b))


def test_published_fingerprints_fold_and_subtract(spark):
    """A text of 40 lines has 4 groups, its half 2: folded and subtracted, both give the sketch of the lines that only one has."""
    lines = [f"line {i}" for i in range(40)]
    sets = [lines, lines[:18], lines[18:]]
    df = spark.createDataFrame([(i, "\n".join(x)) for i, x in enumerate(sets)], "i int, t string").withColumn("d", fingerprint.digests(F.col("t")))
    got = {r.i: cells(r.f) for r in df.select("i", fingerprint.encoded(fingerprint.tables(F.col("d"))).alias("f")).collect()}
    assert [len(got[i]) for i in range(3)] == [4, 2, 2]
    for g in range(2):
        for k in range(fingerprint.CELLS):
            x, y, (n, d, c), rest = got[0][2 * g][k], got[0][2 * g + 1][k], got[1][g][k], got[2][g][k]
            assert (x[0] + y[0] - n, xor(xor(x[1], y[1]), d), xor(xor(x[2], y[2]), c)) == rest


@pytest.mark.parametrize(("differences", "size"), [(0, 24), (6, 24), (32, 96), (120, 384)])
def test_peeling_recovers_digests_by_itself(spark, differences, size):
    """No exact comparison stands behind this: the recovered digests are those that differ, with their side."""
    rng = random.Random(differences)
    some = lambda n: [rng.getrandbits(64) - (1 << 63) for _ in range(n)]
    rows = []
    for i in range(20):
        shared, mine, theirs = some(10), some(differences // 2), some(differences - differences // 2)
        rows.append((i, shared + mine, shared + theirs))
    df = spark.createDataFrame(rows, "i int, a array<long>, b array<long>")
    size_ = F.lit(size)
    left = fingerprint.peel(fingerprint.difference(fingerprint.table(F.col("a"), size_), fingerprint.table(F.col("b"), size_)), size_)
    hits = 0
    for r in df.select("i", "a", "b", left.alias("left")).collect():
        if all((c.n, c.k, c.x) == (0, 0, 0) for c in r.left.cells):
            hits += 1
            assert {(f.k, f.s) for f in r.left.found} == {(k, 1) for k in set(r.a) - set(r.b)} | {(k, -1) for k in set(r.b) - set(r.a)}
    assert hits >= 18


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 5, 7])
def test_split_keeps_every_digest_in_its_group(spark, bits):
    rng = random.Random(bits)
    own = [rng.getrandbits(64) - (1 << 63) for _ in range(300)]
    groups = spark.createDataFrame([(own,)], "d array<long>").select(fingerprint.split(F.col("d"), F.lit(0), F.lit(bits))).first()[0]
    place = lambda d: (d & ((1 << 64) - 1)) >> (64 - bits)
    assert groups == [[d for d in own if place(d) == g] for g in range(1 << bits)]


def test_a_text_of_many_lines(spark):
    texts = ["\n".join(map(str, range(20_000))), "\n".join(map(str, range(100, 20_100)))]
    got = {r.doc_id: r.near_next for r in fingerprint.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0] == got[1] == pytest.approx(19_900 / 20_100)


def test_ids_of_other_types(spark):
    rng = random.Random(9)
    rows = [(i, "\n".join(str(rng.randint(0, 30)) for _ in range(12))) for i in range(40)] + [(None, "no id"), (7, "again 7")]
    named = [(None if i is None else f"d{i:03d}", t) for i, t in rows]
    follow = lambda df, n: sorted((str(r.doc_id), r.text, r.next_text) for r in fingerprint.with_next(df, n).collect())
    numbers, strings = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(named, "doc_id string, text string")
    want = sorted((str(None if i == "None" else f"d{int(i):03d}"), t, x) for i, t, x in follow(numbers, 5))
    assert follow(strings, 5) == follow(strings, 1) == want
