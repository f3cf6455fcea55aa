import math
import random
import re
from collections import Counter

import pytest
from frames import empty_documents, odd_documents

from tidemark.llm import minhash


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute(texts):
    """Class numbers by all pairs."""
    n, sets = len(texts), [shingles(t) for t in texts]
    df = Counter(x for s in sets for x in s)

    def idf(x):
        q = df[x] / n if df[x] >= max(2, minhash.RARE * n) else 0
        return math.log((1 + minhash.S) / (q + minhash.S))

    weights = [{x: c * idf(x) for x, c in s.items()} for s in sets]
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = weights[i], weights[j]
            least = sum(min(v, b[x]) for x, v in a.items() if x in b)
            both = sum(a.values()) + sum(b.values()) - least
            if (texts[i] or "") == (texts[j] or "") or both > 0 and least / both >= minhash.THRESHOLD:
                up[root(i)] = root(j)
    return [root(i) for i in range(n)]


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts = []
    for k in range(8):
        base = [word() for _ in range(rng.choice([40, 150, 400]))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, len(copy) // 40 + 1)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    own = texts[-1].split()
    for i in range(4):  # a chain: each is near the one before
        own = own[:-3] + [word() for _ in range(3)]
        texts.append(" ".join(own))
    return [*texts, texts[0], texts[0], "short one", "short one", "lone", None, ""]


def test_classes_match_all_pairs(spark):
    texts = corpus()
    want = brute(texts)
    got = {r.doc_id: r.class_id for r in minhash.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    least = {}
    for i, c in enumerate(want):
        least.setdefault(c, i)
    assert got == {i: least[c] for i, c in enumerate(want)}


def test_samples_estimate_weighted_jaccard(spark):
    import numpy as np
    import pyarrow as pa

    np.seterr(over="ignore")
    rng = random.Random(1)
    base = [str(rng.random()) for _ in range(600)]
    other = base[:420] + [str(rng.random()) for _ in range(180)]
    w = minhash.Weights(np.zeros(0, np.uint64), np.zeros(0))
    (_, _, h, d, tf), = minhash._sets(pa.array([" ".join(base), " ".join(other)]))
    real = minhash.weighted_jaccard(*(x for k in (0, 1) for x in (lambda o: (h[d == k][o], w(h[d == k], tf[d == k])[o]))(np.argsort(h[d == k]))))
    s = minhash.Sampler(w)
    low = minhash.sh.mix(h) & np.uint64(0xFFFFFFFF)
    same = sum(np.array_equal(*((s.table[k][(h[d == j] * s.odd[k]) >> np.uint64(48)] ^ low[d == j]).min(keepdims=True) for j in (0, 1))) for k in range(80))
    assert abs(same / 80 - real) < 0.2


def test_odd_and_empty_tables(spark):
    got = [(r.doc_id, r.class_id) for r in minhash.classes(odd_documents(spark)).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (1, 1), (6, 1), (2, 2), (3, 2), (None, None), (4, 4), (5, 5)], key=str)
    kept = minhash.keep(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "4", "5", "None"]
    assert minhash.classes(empty_documents(spark)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 50), (50, 70)]
    got = {r.node: r.label for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 50: 50, 70: 50, 100: 50}


def family(seed, n=160):
    """A large group of near copies about the threshold, with edits that many of them share, deletions, and unrelated texts that share a long passage."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdef") + rng.choice("xyz")
    base = [f"{word()}{i}" for i in range(90)]
    texts = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(1, 4)):
            own[rng.randrange(len(own))] = word()
        if rng.random() < 0.3:
            at = rng.randrange(60)
            del own[at : at + rng.randint(1, 12)]
        texts.append(" ".join(own))
    passage = [f"p{i}" for i in range(60)]
    for i in range(40):
        texts.append(" ".join([*passage, *(f"{i}q{j}" for j in range(rng.choice([6, 8, 20, 60])))]))
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_links_of_large_groups_near_the_threshold(spark, seed):
    """Classes of a family are those of all pairs: of its links no more than one in a hundred may be missed, and none be made up."""
    texts = family(seed)
    want = brute(texts)
    got = {r.doc_id: r.class_id for r in minhash.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, c in enumerate(want):  # no class joins texts that all pairs keep apart
        assert want[got[i]] == c
    assert len(set(want)) <= len(set(got.values())) <= len(set(want)) + 2


def test_rounds_are_linear_in_the_members(spark, monkeypatch):
    """Rows of all rounds and pairs compared, of a family twice as large, are not four times as many."""
    made = []
    real = minhash.stored

    def stored(df, name):
        out = real(df, name)
        if name in ("open", "led", "links"):
            made[-1] += out.count()
        return out

    monkeypatch.setattr(minhash, "stored", stored)
    for n in (150, 300):
        made.append(0)
        minhash.classes(spark.createDataFrame(list(enumerate(family(5, n))), "doc_id long, text string")).count()
    assert made[1] < 3.2 * made[0]


def test_two_texts_of_one_hash_stay_apart(spark, monkeypatch):
    """Text identity is 128 bits: where the 64-bit hashes agree, different texts are still different."""
    real = minhash._noded
    monkeypatch.setattr(minhash, "_noded", lambda *a: real(*a).withColumn("node", minhash.F.lit(7).cast("long")))
    rows = [(1, "one two three four five six"), (2, "six seven eight nine ten eleven"), (3, "one two three four five six"), (4, "lone")]
    got = {r.doc_id: r.class_id for r in minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4}


def test_mixed_cells_hold_every_key_of_two_labels(spark):
    import numpy as np

    rng = random.Random(11)
    keys = [rng.getrandbits(64) - (1 << 63) for _ in range(4000)]
    rows = [([rng.choice(keys[: 40 * (1 + label)]) for _ in range(rng.randint(0, 9))], node, label, 0.0, 0.0, 0.0, 0.0) for node, label in ((n, rng.randint(0, 60)) for n in range(900))]
    placed = spark.createDataFrame(rows, "keys array<long>, node long, label long, apart double, reach double, surplus double, size double").repartition(7)
    cell = lambda k: ((k % (1 << 64)) >> 45) * 2 + k % 2
    by_key = {}
    for ks, _, label, *_ in rows:
        for k in ks:
            by_key.setdefault(k, set()).add(label)
    by_cell = {}
    for k, labels in by_key.items():
        by_cell.setdefault(cell(k), set()).update(labels)
    mixed = minhash.mixed_cells(placed)
    assert set(mixed[0].tolist()) == {c for c, labels in by_cell.items() if len(labels) > 1}
    dealt = {(r["key"], r["node"]) for r in minhash._dealt(placed, mixed).collect()}
    assert dealt >= {(k, n) for ks, n, *_ in rows for k in ks if len(by_key[k]) > 1}
    assert not any(len(by_cell[cell(k)]) == 1 for k, _ in dealt)
    assert not len(minhash.mixed_cells(placed.limit(0))[0])


def test_dealt_keeps_every_pair_that_may_be_linked(spark):
    rng = random.Random(12)
    keys = [rng.getrandbits(64) - (1 << 63) for _ in range(200)]
    draw = lambda: [rng.uniform(0, 400), rng.uniform(0, 400), rng.uniform(-200, 200), rng.uniform(20, 900)]
    rows = [(rng.sample(keys, rng.randint(0, 4)), n, rng.randint(0, 9), *draw()) for n in range(500)]
    placed = spark.createDataFrame(rows, "keys array<long>, node long, label long, apart double, reach double, surplus double, size double").repartition(5)
    dealt = minhash._dealt(placed, minhash.mixed_cells(placed))
    assert dealt.count() < sum(len(r[0]) for r in rows)
    left = {(r["key"], r["node"]) for r in minhash._able(dealt).collect()}
    met = set()
    for k in keys:
        own = [r[1:] for r in rows if k in r[0]]
        for x, label, apart, reach, surplus, size in own:
            for y, label_y, apart_y, reach_y, surplus_y, size_y in own:
                g = (size + size_y) * minhash.APART
                if label != label_y and (k % 2 == 0 or surplus_y >= reach - g and surplus >= reach_y - g):
                    met |= {(k, x), (k, y)}
    assert met and left >= met


def test_idf_of_rare_shingles_is_exact(spark):
    """A passage of three documents in 400 weighs less than what one document holds alone, which parts two texts that share 81 of 101 shingles."""
    shared = [f"s{i}" for i in range(85)]
    own = lambda k, n: [f"{k}x{j}" for j in range(n)]
    texts = [" ".join([*shared, *own(k, n)]) for k, n in (("a", 10), ("b", 10), ("c", 90))] + [" ".join(own(f"d{k}", 12)) for k in range(397)]
    s = [shingles(t) for t in texts[:2]]
    assert len(s[0] & s[1]) == 81 and 81 / len(s[0] | s[1]) > minhash.THRESHOLD
    rare, alone = (math.log((1 + minhash.S) / (q + minhash.S)) for q in (3 / 400, 0))
    assert 81 * rare / (81 * rare + 20 * alone) < minhash.THRESHOLD
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert all(r.doc_id == r.class_id for r in minhash.classes(docs).collect())


def test_weights_of_all_units_are_those_of_all_counts(spark, monkeypatch):
    """Many units and shards: each shingle's weight is its count in the text times its idf over all documents."""
    import numpy as np

    monkeypatch.setattr(minhash, "UNIT_SHINGLES", 300)
    monkeypatch.setattr(minhash, "SHARD_SHINGLES", 30)
    texts = [*family(4), *corpus(), *["one two three four five six"] * 4]
    docs = spark.createDataFrame([(i, t or "", i) for i, t in enumerate(texts)], "node long, text string, doc_id long").repartition(3)
    sets = [shingles(t) for t in texts]
    df = Counter(x for s in sets for x in s)
    got = {r.doc_id: r for r in minhash.sampled(docs).collect()}
    assert len(got) == len(texts)
    for i, s in enumerate(sets):
        want = [c * math.log((1 + minhash.S) / ((df[x] / len(texts) if df[x] > 1 else 0) + minhash.S)) for x, c in s.items()]
        assert minhash._flat(bytes(got[i].w), len(want), np.float32).tolist() == pytest.approx(want, rel=1e-6)
        assert len(got[i]["keys"]) == (minhash.BANDS if want else 0)


def test_a_worker_keeps_no_more_of_the_sampler_than_its_variates():
    """16 bands of 5 samples, three variates of four bytes in each of 2**16 cells; none of them after the step that samples."""
    import numpy as np

    sampler = minhash._sampler()
    assert sum(x.nbytes for x in vars(sampler).values() if isinstance(x, np.ndarray)) <= 3 * 4 * 80 * (1 << 16) + 1000
    steps = {}

    class Texts:
        def mapInArrow(self, run, schema):
            steps[schema] = run

    minhash._blobs(Texts())
    assert list(steps["node long, hashes binary, w binary"]([])) == []
    assert minhash._sampler.cache_info().currsize == 0
