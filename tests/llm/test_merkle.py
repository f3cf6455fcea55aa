import hashlib
import random
import zlib

import pytest
from frames import empty_documents, odd_documents
from pyspark.sql import functions as F

from tidemark.llm import merkle, queries

H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """The root of a list of nodes, and each one's siblings a level as (left, right) lists."""
    paths, here, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(here) > 1:
        runs = [here[i : i + 16] for i in range(0, len(here), 16)]
        for i, a in enumerate(at):
            run = runs[a // 16]
            paths[i].append((run[: a % 16], run[a % 16 + 1 :]))
        here, at = [H("".join(r)) for r in runs], [a // 16 for a in at]
    return here[0], paths


def by_hand(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified, by one list a source; rows(doc_id, text, lang, source, n_chars)."""
    kept = [(r[0], r[3], r[2], r[4], r[1]) for r in rows]
    by = {}
    for r in kept:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = climb([leaf_of(r) for r in by[s]])
    root, tops = climb([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for r, path in zip(by[s], trees[s][1]):
            way = path + top
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            text = None if r[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            node = leaf_of((*r[:4], text)) if tampered else leaf_of(r)
            for a, b in way:
                node = H("".join([*a, node, *b]))
            out.append((r[0], leaf_of(r), trees[s][0], root, H("".join(x for a, b in way for x in a + b)), node, node == root))
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return sorted((tuple(r) for r in queries.merkle_audit(df).collect()), key=str)


def documents(n, sources, seed=1):
    rng = random.Random(seed)
    return [(i * 3 % (4 * n), f"Text {rng.random()} É" if rng.random() < 0.9 else None, rng.choice(["en", None]), rng.choice(sources), rng.randint(0, 99)) for i in range(n)]


@pytest.mark.parametrize(("n", "sources"), [(1, ["a"]), (2, ["a", "b"]), (40, ["a"]), (700, ["hot", "hot", "hot", "b", None, "", "ß", "z"]), (300, [f"s{i}" for i in range(90)])])
def test_equals_one_list_a_source(spark, n, sources):
    rows = documents(n, sources)
    assert run(spark, rows) == sorted(by_hand(rows), key=str)


def test_many_blocks_and_rounds(spark):
    """Blocks of 16 leaves: the tree of one source takes several rounds, and every proof goes through them."""
    rows = documents(1100, ["hot"] * 9 + ["b"])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle.manifest(docs, merkle.leaf([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]), depth=1)
    want = [(w[0], w[1], w[2], w[3], w[4]) for w in by_hand(rows)]
    assert sorted((r.doc_id, r.leaf, r.subroot, r.root, H(r.proof)) for r in got.collect()) == sorted(want)
    assert got.where("folded_root <> root").count() == 0 and got.agg(F.max("at")).first()[0] > 256


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 33, 255, 256, 257, 4096])
def test_levels_and_index_arithmetic(n):
    import numpy as np

    nodes = [H(str(i)) for i in range(n)]
    levels = [np.frombuffer("".join(nodes).encode(), np.uint8).reshape(-1, 64)]
    for _ in range(merkle.height(n)):
        levels.append(merkle.above(levels[-1]))
    root, paths = climb(nodes)
    assert levels[-1].tobytes().decode() == root and len(levels) - 1 == len(paths[0])
    run, there, place = merkle.siblings(levels)
    every = np.concatenate(levels)
    for i in {0, n // 2, n - 1}:
        for k, (a, b) in enumerate(paths[i]):
            got = every[run[i, k][there[i, k]]].tobytes().decode()
            assert got == "".join(a + b) and place[i, k] == len(a)


def test_repeats_odd_and_empty_tables(spark):
    odd = odd_documents(spark).withColumnsRenamed({"kept": "leaf", "size": "grp"})
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in odd.collect()]
    got, want = sorted((tuple(r) for r in queries.merkle_audit(odd).collect()), key=str), sorted(by_hand(rows), key=str)
    assert got == want
    assert queries.merkle_audit(empty_documents(spark)).count() == 0
    many = [(7, "SAME", "en", "hot", 4)] * 400
    assert run(spark, many) == sorted(by_hand(many), key=str)


def test_a_changed_row_is_found(spark):
    docs = spark.createDataFrame(documents(100, ["a", "b"]), "doc_id long, text string, lang string, source string, n_chars long")
    fields = [F.col("doc_id"), F.col("text")]
    got = merkle.manifest(docs, merkle.leaf(fields), claim=merkle.leaf([F.col("doc_id"), F.when(F.col("doc_id") == 9, F.lit("other")).otherwise(F.col("text"))]))
    assert [r.doc_id for r in got.where("folded_root <> root").collect()] == [9]
    assert merkle.manifest(docs, merkle.leaf(fields)).where("folded_root <> root").count() == 0
