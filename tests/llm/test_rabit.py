import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import rabit


def brute(rows, k, asks):
    """query_id, rank, vec_id and score by all inner products; rows(vec_id, vector) by place."""
    fine = [(i, np.asarray(v, np.float64)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (q, a) in enumerate(fine):
        if q is not None and asks(q):
            hits = [(-float(a @ b), i is None, i or 0) for m, (i, b) in enumerate(fine) if m != n and len(b) == len(a)]
            out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(hits)[:k])]
    return out


def found(spark, rows, k=20, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    return [tuple(r) for r in rabit.nearest(df, F.col("vec_id") % 20 == 0, k).collect()]


def vectors(n, dim, seed, mean=0.0, scale=1.0):
    x = np.random.default_rng(seed).standard_normal((n, dim)) * scale + mean
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]


def same(got, want):
    got, want = (sorted(x, key=lambda r: (r[0], r[1], str(r[2]))) for x in (got, want))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], rel=1e-12, abs=1e-12)


def test_estimates_keep_to_their_width():
    x = np.random.default_rng(1).standard_normal((3000, 48)) + 0.5
    bits, far, agree, share, turned = rabit.encode(x, x.mean(axis=0))
    signs = np.unpackbits(bits, axis=1).astype(float) * 2 - 1
    d = signs.shape[1]
    est = (turned[:50] @ signs.T) * (far / (agree * np.sqrt(d))) + share + share[:50, None]
    width = np.sqrt(1 - agree**2) / agree / np.sqrt(d - 1) * far * np.linalg.norm(turned[:50], axis=1)[:, None]
    z = (est - x[:50] @ x.T) / width
    np.fill_diagonal(z, 0)
    assert d == rabit.code_bits(48) == 192 and abs(z.mean()) < 0.02 and 0.8 < z.std() < 1.1 and (np.abs(z) > rabit.EPS).mean() < 0.002


@pytest.mark.parametrize("mean", [0.0, 3.0])
def test_recall_against_all_inner_products(spark, monkeypatch, mean):
    monkeypatch.setattr(rabit, "BLOCK_BYTES", 4 * 24 * 150)  # many blocks, and floors from a sample
    rows = vectors(3000, 24, 2, mean)
    got, want = found(spark, rows), brute(rows, 20, lambda i: i % 20 == 0)
    score = {(q, v): s for q, _, v, s in want}
    hits = sum((g[0], g[2]) in score for g in got)
    assert len(got) == len(want) and hits >= 0.99 * len(want)
    assert all(g[3] == pytest.approx(score[(g[0], g[2])], rel=1e-12) for g in got if (g[0], g[2]) in score)
    by = {}
    for q, r, v, s in sorted(got, key=lambda g: g[:2]):
        assert q != v and (r == 1 or by[q] >= s)
        by[q] = s


def test_ties_copies_and_rows_that_take_no_part(spark):
    base = vectors(30, 8, 3)
    rows = base + [(100 + i, base[i % 3][1]) for i in range(40)] + [(20, base[5][1]), (20, base[5][1]), (None, base[5][1]), (None, base[6][1])]
    rows += [(200, None), (220, []), (240, [0.0] * 8), (260, [1.0, None] + [0.0] * 6), (280, [float("nan")] + [1.0] * 7), (300, [float("inf")] + [1.0] * 7), (400, [1.0, 2.0]), (402, [2.0, 1.0]), (403, [1.0, 1.0]), (420, [5.0])]
    got = found(spark, rows, 30)
    want = brute(rows, 30, lambda i: i % 20 == 0)
    key = lambda r: (r[0], round(r[3], 9), r[1], r[2] is None, r[2] or 0)
    assert sorted(map(key, got)) == sorted(map(key, want))  # copies of a query's id stand as queries of their own
    assert {g[0] for g in got} == {0, 20, 100, 120, 400} and sorted(g[1:3] for g in got if g[0] == 400) == [(1, 402), (2, 403)]


def test_one_vector_copied_many_times(spark, monkeypatch):
    monkeypatch.setattr(rabit, "BLOCK_BYTES", 4 * 8 * 64)
    rows = [(i, [1.0] * 8) for i in range(500)]
    same(found(spark, rows, 5), brute(rows, 5, lambda i: i % 20 == 0))


def test_odd_columns_doubles_and_empty(spark):
    rows = vectors(25, 5, 4)
    same(found(spark, rows, 20, "double"), brute(rows, 20, lambda i: i % 20 == 0))
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, uid int, score string")
    assert rabit.nearest(df, F.col("vec_id") % 20 == 0, 3).columns == ["query_id", "rank", "vec_id", "score"]
    assert rabit.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert rabit.nearest(df.limit(1), F.col("vec_id") % 20 == 0).count() == 0
    assert rabit.nearest(df.where("vec_id = 3"), F.col("vec_id") % 20 == 0).count() == 0


def test_few_candidates_are_scored_in_the_first_tile(monkeypatch):
    """No more than a quarter of a tile's pairs are scored exactly, floors included, and the result is that of all inner products."""
    n, dim, k = 4000, 64, 20
    x = np.random.default_rng(8).standard_normal((n, dim)).astype(np.float32)
    bits, far, agree, share, turned = rabit.encode(x, x.mean(axis=0))
    codes = {"uid": np.arange(n), "order": np.arange(n), "vector": x, "bits": bits, "far": far, "agree": agree, "share": share}
    asked = {"uid": np.arange(200), "vector": x[:200], "turned": turned[:200], "share": share[:200], "floor": np.full(200, -np.inf)}
    rows, real = [], np.einsum
    monkeypatch.setattr(np, "einsum", lambda how, a, b, **kw: rows.append(len(a)) or real(how, a, b, **kw))
    q, v, score = rabit.scan(asked, codes, k)
    assert sum(rows) <= 200 * n / 4
    all_scores = x[:200].astype(np.float64) @ x.T.astype(np.float64)
    np.fill_diagonal(all_scores, -np.inf)
    want = np.argsort(-all_scores, axis=1)[:, :k]
    assert len(q) == 200 * k and sum(len(np.intersect1d(v[q == i], want[i])) for i in range(200)) >= 0.99 * 200 * k
    assert score == pytest.approx(all_scores[q, v], rel=1e-12, abs=1e-12)
