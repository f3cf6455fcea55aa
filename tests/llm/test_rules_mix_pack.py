import itertools
import random
from collections import Counter

import pytest
from frames import empty_documents, odd_documents

from tidemark.llm import mixing, packing, quality_rules

PROSE = "the house of the old man is on a hill and it was built for his son by men from the town with stone that they had cut in the hills as well as wood they got at the river . "


def test_quality_measures(spark):
    texts = ["a b c a b c a b c", "x y\nx y\n\n q#$ é", None, "", "one two", "a a a a"]

    def repeat(t):
        w = (t or "").split()
        n = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        return len({i + k for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for k in range(3)})

    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].n_repeat_words for i in range(6)] == [repeat(t) for t in texts]
    assert (got[1].n_dup_lines, got[1].n_symbols, got[1].n_words, got[1].word_chars) == (1, 2, 6, 8)
    assert all(got[i].base_failed and not got[i].kept for i in range(6))


def test_quality_keeps_prose_and_drops_symbols(spark):
    words = PROSE.split()
    rng = random.Random(2)
    good = " ".join(rng.choice(words) for _ in range(300))
    rows = [(1, good), (2, " ".join(w + "%%%" for w in good.split())), (3, good.upper()), (4, "zxq " * 20 + " ".join(str(rng.random()) for _ in range(200)))]
    assert [r.doc_id for r in quality_rules.keep(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == [1]


def test_quality_odd_tables(spark):
    odd = odd_documents(spark).withColumnRenamed("size", "n_words")
    assert quality_rules.judge(odd).count() == 8 and quality_rules.keep(odd).columns == odd.columns
    assert quality_rules.judge(empty_documents(spark)).count() == 0


def test_mix_meets_targets(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", "c", "d", None]) if i % 3 else "hot") for i in range(300)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(map(tuple, mixed), key=str) == sorted(map(tuple, mixing.mix(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string").repartition(5)).collect()), key=str)
    size = Counter()
    for r in mixed:
        size[r.source] += r.size
        assert r.taken <= 2 * r.size and r.source_size == sum(len(t.split()) for _, t, s in rows if s == r.source)
    target = {r.source: r.target for r in mixed}
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values())) and all(t <= 2 * size[s] + 1e-6 for s, t in target.items())
    taken = Counter()
    for r in mixed:
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    free = [(target[s] / w) for s, w in zip(sorted(target, key=lambda s: (s is None, s or "")), itertools.cycle(mixing.WEIGHTS)) if target[s] < 2 * size[s] - 1e-6]
    assert max(free) == pytest.approx(min(free))
    rising = [r for r in mixed if r.first_position is not None]
    assert all(0 <= r.first_position <= sum(target.values()) for r in rising) and all((r.second_position is None) == (r.taken <= r.size) for r in rising if r.size and r.taken not in (r.size,))


def test_mix_odd_tables(spark):
    got = mixing.mix(odd_documents(spark)).collect()
    assert len(got) == 8 and sum(r.size for r in got) == 6 * 3 + 5 + 30_000
    kept = mixing.keep(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns and kept.count() > 0
    assert mixing.mix(empty_documents(spark)).count() == 0 and mixing.keep(empty_documents(spark)).count() == 0


@pytest.mark.parametrize("buckets", [1, 2, 3, 5])
def test_bounds_are_optimal(buckets):
    rng = random.Random(buckets)
    cells = sorted({rng.randint(1, 60) for _ in range(9)})
    hist = [(c, rng.randint(1, 9), 0) for c in cells]
    hist = [(c, n, n * c - rng.randint(0, n - 1)) for c, n, _ in hist]

    def waste(tops):
        return sum(n * next(t for t in tops if t >= c) - w for c, n, w in hist)

    best = min(waste([*cut, cells[-1]]) for k in range(buckets) for cut in itertools.combinations(cells[:-1], k))
    assert waste(packing.bounds(hist, buckets)) == best and len(packing.bounds(hist, buckets)) <= buckets


def test_packing(spark):
    rng = random.Random(9)
    rows = [(i, "w " * min(3000, int(rng.paretovariate(0.7) * 5))) for i in range(400)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), budget=1000, buckets=6).collect()
    assert len(got) == 400 and all(r.n_tokens == len(rows[r.doc_id][1].split()) <= r.bucket_length for r in got)
    batches = Counter((r.bucket_length, r.batch) for r in got)
    last = {b: max(k for w, k in batches if w == b) for b, _ in batches}
    for (b, k), n in batches.items():
        most = max(1, 1000 // b)
        assert n == most if k < last[b] else n <= most
    assert len({(r.batch_id, r.slot) for r in got}) == 400
    assert packing.pack(odd_documents(spark)).count() == 8 and packing.pack(empty_documents(spark)).count() == 0
