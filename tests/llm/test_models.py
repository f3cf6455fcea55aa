import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from frames import empty_documents, odd_documents

from tidemark.llm import kneser_ney, pitman_yor


def prose(seed, n, words=60):
    rng = random.Random(seed)
    vocabulary = [f"{rng.choice('bcdfg')}{i}" for i in range(words)]
    follow = {w: rng.sample(vocabulary, 4) for w in vocabulary}
    out = []
    for _ in range(n):
        w, text = rng.choice(vocabulary), []
        for _ in range(rng.randint(20, 60)):
            text.append(w)
            w = rng.choice(follow[w]) if rng.random() < 0.9 else rng.choice(vocabulary)
        out.append(" ".join(text))
    return out


def test_pitman_yor(spark):
    texts = [t.capitalize() for t in prose(1, 200)] + ["", None, "once only words", "É Ä Q"]
    got = {r.doc_id: r for r in pitman_yor.scores(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    c = Counter(x for t, h in zip(tokens, held) if not h for x in t)
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(tokens):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(c[x] > 0 for x in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)) and r.score < 0
    out = [got[i] for i in range(200) if held[i]]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.2 * sum(r.n_tokens for r in out)  # the context helps


def test_pitman_yor_odd_tables(spark):
    got = pitman_yor.scores(odd_documents(spark)).collect()
    assert len(got) == 8 and all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert pitman_yor.scores(empty_documents(spark)).count() == 0


def test_seating_has_the_right_distribution():
    """Tables of one dish against the exact conditional, by enumeration."""
    d, theta, p, c = 0.6, 2.0, 0.3, 6
    row = {1: 1.0}
    for n in range(1, c):
        row = {t: row.get(t - 1, 0) + (n - t * d) * row.get(t, 0) for t in range(1, n + 2)}
    weight = {t: s * p**t * math.prod(theta + d * k for k in range(t)) for t, s in row.items()}
    want = {t: w / sum(weight.values()) for t, w in weight.items()}
    many = 3000
    got = Counter()
    for t, _ in pitman_yor.seat(np.full(many, c), np.arange(many), np.full(many, p), None, d, theta, pitman_yor.Ratios(d), np.random.default_rng(3), 60, 10):
        got.update(t.tolist())
    assert all(abs(got[t] / many / 10 - w) < 0.02 for t, w in want.items())


def test_stirling_ratios_beyond_the_table():
    d = 0.8
    row, top = np.full(1002, -np.inf), 1000
    row[1] = 0
    t = np.arange(1002)
    with np.errstate(divide="ignore", invalid="ignore"):
        for n in range(1, top):
            row = np.logaddexp(np.concatenate(([-np.inf], row[:-1])), np.log(np.maximum(n - t * d, 0)) + row)
    at = np.array([1, 2, 5, 20, 60])
    assert pitman_yor.Ratios(d)(np.full(5, top), at) == pytest.approx(np.exp(row[at + 1] - row[at]), rel=0.1)


def kn(trusted, text):
    """Log10 probability by the textbook."""
    count = Counter(w for t in trusted for w in [*t.split(), None])
    known = {w for w, c in count.items() if c > 1}
    once = sum(c < 2 for c in count.values())
    types = lambda t: [w if w in known else "?" for w in [*t.split(), None]]
    pairs = Counter(p for t in trusted for p in zip(["^", *types(t)[:-1]], types(t)))

    def discounts(values):
        n = [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        if not all(n):
            return [0.5, 0.75, 0.9]
        y = n[0] / (n[0] + 2 * n[1])
        return [min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0.05), k + 0.95) for k in range(3)]

    d, cont = discounts(pairs.values()), Counter(w for _, w in pairs)
    d1 = discounts(cont.values())
    less = lambda ds, c: ds[min(c, 3) - 1]
    lower = lambda w: (max(cont[w] - less(d1, cont[w]), 0) if cont[w] else 0) / sum(cont.values()) + sum(less(d1, c) for c in cont.values()) / sum(cont.values()) / (len(known) + 1)
    total = 0.0
    for u, w in zip(["^", *types(text)[:-1]], types(text)):
        own = {x: c for (a, x), c in pairs.items() if a == u}
        n = sum(own.values())
        p = lower(w) if not n else ((own[w] - less(d, own[w])) / n if w in own else 0) + sum(less(d, c) for c in own.values()) / n * lower(w)
        total += math.log10(p / (max(once, 1) if w == "?" else 1))
    return total


def test_kneser_ney(spark):
    good = prose(2, 130)
    junk = [" ".join(f"{w}%%" for w in t.split()) for t in prose(3, 20)]
    texts = [*good, *junk, None]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(130)] + [(130, 0, 0), (None, 1, 0), (3, 1, None)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in kneser_ney.classify(docs, labels).collect()}
    train = {r.doc_id for r in kneser_ney.trusted_ids(labels)[0].collect()}
    trusted = [good[i] for i in sorted(train)]
    for i in (0, 1, 131, 150):
        t = texts[i] or ""
        assert got[i].perplexity == pytest.approx(10 ** (-kn(trusted, t) / (len(t.split()) + 1)))
    assert all(got[i].kept for i in range(130)) and not any(got[i].kept for i in range(130, 150))


def test_kneser_ney_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept for r in kneser_ney.classify(odd_documents(spark), none).collect())
    assert kneser_ney.classify(empty_documents(spark), none).count() == 0


@pytest.mark.parametrize("shared", [True, False])
def test_seating_of_frequent_dishes_needs_no_more_sweeps(shared):
    """Mean tables at the production sweeps against exact Stirling weights, in a restaurant of 5000 tables and alone."""
    d, theta, many = pitman_yor.DISCOUNT, pitman_yor.STRENGTH, 2000
    p = 0.01 if shared else 0.3
    for c in (20, 100, 1000, 3000):
        row, t = np.full(c + 2, -np.inf), np.arange(c + 2)
        row[1] = 0
        with np.errstate(divide="ignore", invalid="ignore"):
            for n in range(1, c):
                row = np.logaddexp(np.concatenate(([-np.inf], row[:-1])), np.log(np.maximum(n - t * d, 0)) + row)
        k = t[1 : c + 1]
        w = row[1 : c + 1] + k * math.log(p) + (k * math.log(theta + d * 5000) if shared else np.cumsum(np.log(theta + d * (k - 1))))
        w = np.exp(w - w.max())
        want = (w * k).sum() / w.sum()
        fixed = np.full(many, 5000.0) if shared else None
        states = [t.copy() for t, _ in pitman_yor.seat(np.full(many, c), np.arange(many), np.full(many, p), fixed, d, theta, pitman_yor.Ratios(d), np.random.default_rng(5), pitman_yor.BURN_IN, pitman_yor.SAMPLES)]
        assert np.mean(states) == pytest.approx(want, rel=0.05), c


def test_thresholds_use_all_held_out_labels(spark):
    n = 40_000
    train, check = kneser_ney.trusted_ids(spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic"))
    train, check = ({r.doc_id for r in x.collect()} for x in (train, check))
    assert len(train) == kneser_ney.TRUSTED and not train & check and train | check == set(range(n))


def test_predictive_probabilities_sum_to_one(spark):
    """Over all types, in split contexts and others, of a bucket's worth of dishes; and against the formula of the seats that were counted."""
    rng = np.random.default_rng(4)
    n = 30
    hashes = np.sort(rng.integers(1, 1 << 62, n, dtype=np.uint64))
    counts = rng.integers(20, 2000, n)
    v = pitman_yor.Vocabulary(hashes, counts, int(counts.sum()) + 50, n + 20, 40)
    shape = (len(v.contexts), n + 1)
    table = np.zeros(shape, np.int64)
    for u, size in enumerate(v.contexts.astype(int)):
        table[u] = rng.multinomial(size, rng.dirichlet(np.ones(n + 1)))
    keys = (np.repeat(np.arange(shape[0], dtype=np.uint64), n + 1) << np.uint64(32)) | np.tile(np.arange(n + 1, dtype=np.uint64), shape[0])
    pairs, ratios = 16, pitman_yor.Ratios(pitman_yor.DISCOUNT)
    home = (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(4)
    whole = (keys >> np.uint64(32)) % np.uint64(4)
    split = v.contexts[(keys >> np.uint64(32)).astype(int)] >= v.total / (2 * pairs)
    assert split.any() and not split.all()
    bucket = np.where(split, home, whole)
    seats = [pitman_yor.Seats(b, keys[bucket == b], table.ravel()[bucket == b], v, pairs, ratios) for b in range(4)]
    tables = np.zeros(len(v.contexts))
    for s in seats:
        at, mean, _ = s.parts()
        tables += np.bincount(s.ctx[at], mean, len(tables))
    root = rng.dirichlet(np.ones(n + 1))
    total = np.zeros(shape[0])
    for s in seats:
        p = s.predictive(root, tables)
        assert (p > 0).all()
        total += np.bincount(s.ctx, p, shape[0])
    assert total == pytest.approx(np.ones(shape[0]))


@pytest.mark.parametrize("fat", [False, True])
def test_salted_buckets_give_the_same_scores(spark, monkeypatch, fat):
    texts = prose(7, 150)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3, "doc_id")
    want = {r.doc_id: r.score for r in pitman_yor.scores(docs).collect()}
    monkeypatch.setattr(pitman_yor, "UNIT_TOKENS", 500)
    if fat:
        monkeypatch.setattr(pitman_yor, "FAT", 0.5)
        monkeypatch.setattr(pitman_yor, "FAT_TOKENS", 1)
    got = {r.doc_id: r for r in pitman_yor.scores(docs).collect()}
    assert all(r.score == pytest.approx(want[i]) and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for i, r in got.items())


def test_string_ids(spark):
    rows = [("a", "one two"), ("b", None), (None, "three")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert {r.doc_id: r.held_out for r in pitman_yor.scores(docs).collect()} == {x: pitman_yor.held_out(x) for x, _ in rows}
    labels = spark.createDataFrame([("a", 1, 0)], "doc_id string, quality int, toxic int")
    assert {r.doc_id for r in kneser_ney.classify(docs.withColumn("lang", kneser_ney.F.lit("en")), labels).collect()} == {"a", "b", None}


def test_kept_is_the_quantile_rule(spark):
    """`kept` and `threshold` from the perplexities of the held-out trusted documents, by plain Python."""
    texts = prose(11, 260)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(240)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else "fr") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = kneser_ney.classify(docs, labels).collect()
    check = {r.doc_id for r in kneser_ney.trusted_ids(labels)[1].collect()}
    for lang in ("en", "fr"):
        own = sorted(r.perplexity for r in got if r.lang == lang and r.doc_id in check)
        if len(own) < kneser_ney.LEAST:
            own = sorted(r.perplexity for r in got if r.doc_id in check)
        cut = own[max(0, math.ceil(kneser_ney.HIGH * len(own)) - 1)] * kneser_ney.SLACK
        assert all(r.threshold == pytest.approx(cut) and r.kept == (r.perplexity <= r.threshold) for r in got if r.lang == lang)


def test_words_keep_their_contexts_however_rare(spark, monkeypatch):
    """Scores do not depend on which words have ids: the random numbers differ, the model is the same."""
    texts = prose(5, 300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3, "doc_id")
    want = {r.doc_id: r for r in pitman_yor.scores(docs).collect()}
    monkeypatch.setattr(pitman_yor, "FREQUENT", 0.5)
    got = {r.doc_id: r for r in pitman_yor.scores(docs).collect()}
    for i, r in want.items():
        assert (got[i].n_known, got[i].base_score) == (r.n_known, pytest.approx(r.base_score))
        assert got[i].score == pytest.approx(r.score, rel=0.03)


def test_root_by_sizes_is_the_root_by_types():
    """Twins that stand for all types of a size against every type by itself; probabilities sum to 1 with the unseen type."""
    rng = np.random.default_rng(2)
    customers = np.concatenate((rng.integers(1, 4, 5000), rng.integers(4, 3000, 40)))
    sizes, held = np.unique(customers, return_counts=True)
    n = len(customers) + 1
    root = pitman_yor.Root(sizes, held, n)
    p = root(np.append(customers, 0))
    assert p.sum() == pytest.approx(1) and (p > 0).all()
    d, theta = pitman_yor.ROOT_DISCOUNT, pitman_yor.ROOT_STRENGTH
    alone = np.zeros(n - 1)
    for t, tables in pitman_yor.seat(customers, np.zeros(n - 1, int), np.full(n - 1, 1 / n), None, d, theta, pitman_yor.Ratios(d), np.random.default_rng(9), 10, 6):
        alone += ((theta + d * tables[0]) / n + customers - d * t) / (theta + customers.sum()) / 6
    for size in sizes[:3]:
        assert p[:-1][customers == size].mean() == pytest.approx(alone[customers == size].mean(), rel=0.02)


@pytest.mark.parametrize("fat", [False, True])
def test_kneser_ney_learns_from_all_of_its_half(spark, monkeypatch, fat):
    """However small the sample that trusted_ids draws by default; and the same with frequent pairs salted."""
    monkeypatch.setattr(kneser_ney, "TRUSTED", 20)
    if fat:
        monkeypatch.setattr(kneser_ney, "GROUP_TOKENS", 2000)
        monkeypatch.setattr(kneser_ney, "UNIT_TOKENS", 500)
        monkeypatch.setattr(pitman_yor, "FAT", 0.5)
        monkeypatch.setattr(pitman_yor, "FAT_TOKENS", 1)
    monkeypatch.setattr(kneser_ney.trusted_ids, "__defaults__", (20,))
    texts = prose(6, 150)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(140)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    train, check = ({r.doc_id for r in x.collect()} for x in kneser_ney.trusted_ids(labels, None))
    assert len(train) > 40 and not train & check and train | check == set(range(140))
    got = {r.doc_id: r for r in kneser_ney.classify(docs, labels).collect()}
    trusted = [texts[i] for i in sorted(train)]
    for i in (0, 1, 141, 149):
        assert got[i].perplexity == pytest.approx(10 ** (-kn(trusted, texts[i]) / (len(texts[i].split()) + 1)))


def test_texts_outside_the_training_half_are_not_shuffled_to_be_told_apart(spark, monkeypatch):
    """The documents' own ids say which half they are of, ahead of the join with the trusted ids."""
    plans, real = {}, kneser_ney.stored

    def stored(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(kneser_ney, "stored", stored)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id int, quality int, toxic int")
    docs = spark.createDataFrame([(i, f"word word {i}", "en") for i in range(20)], "doc_id long, text string, lang string")
    assert kneser_ney.classify(docs, labels).count() == 20
    assert "md5(" in plans["trusted-text"]


def test_a_bucket_is_seated_in_slices(monkeypatch):
    """What the sampler holds beside a bucket's pairs does not grow with them, probabilities sum to 1, and tables are about the same in any slices."""
    import tracemalloc

    rng = np.random.default_rng(8)
    n, each = 20_000, 20
    keys = np.repeat(np.arange(n, dtype=np.uint64), each) << np.uint64(32) | np.tile(np.arange(each, dtype=np.uint64), n)
    c = rng.integers(0, 12, len(keys))
    v = pitman_yor.Vocabulary(np.arange(1, n + 1, dtype=np.uint64), np.add.reduceat(c, np.arange(0, len(keys), each)), int(c.sum()), n, n)
    v.contexts[0], root = v.total, rng.dirichlet(np.ones(each))  # the first context is a part of a larger one
    seats = pitman_yor.Seats(1, keys, c, v, 2, pitman_yor.Ratios(pitman_yor.DISCOUNT))
    tracemalloc.start()
    p = seats.predictive(root, np.zeros(n + 2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * len(keys)
    sums = np.add.reduceat(p, np.arange(0, len(keys), each))
    assert seats.split.sum() == each and sums[1:] == pytest.approx(np.ones(n - 1))
    monkeypatch.setattr(pitman_yor, "SLICE", 1000)
    small = pitman_yor.Seats(1, keys, c, v, 2, seats.ratios)
    assert len(small.slices) > 390 and sum(len(small.whole(k, root, 1)[0]) for k in range(len(small.slices))) == int((c[each:] > 0).sum())
    assert np.log(small.predictive(root, np.zeros(n + 2))[each:]).mean() == pytest.approx(np.log(p[each:]).mean(), rel=0.01)
    assert np.array_equal(small.parts()[0], seats.parts()[0])


def test_pair_counts_take_little_room(spark, monkeypatch):
    """A pair is kept by its number and count alone, and its count goes to its shard packed with others, far below a row of its own."""
    frames, real, packed = {}, kneser_ney.stored, []

    def stored(df, name):
        frames[name] = df.columns
        return real(df, name)

    class Seen:
        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            k = np.arange(50_000, dtype=np.int64) * 1000
            batch = kneser_ney.pa.RecordBatch.from_arrays([kneser_ney.pa.array(k), kneser_ney.pa.array(np.ones(len(k), np.int64))], names=["k", "c"])
            packed.extend(run([batch]))
            raise StopIteration

    monkeypatch.setattr(kneser_ney, "stored", stored)
    texts = spark.createDataFrame(list(enumerate(prose(4, 30))), "_id long, text string")
    kneser_ney.train(texts)
    assert frames["kn-pairs"] == ["k", "c"]
    docs = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string")
    with pytest.raises(StopIteration):
        kneser_ney._score(docs, Seen(), None, 16, 1)
    assert sum(b.num_rows for b in packed) == 16 and sum(b.nbytes for b in packed) < 8 * 50_000
