"""Quality classifier: a bigram model with interpolated modified Kneser-Ney smoothing, trained on trusted text.

Trusted text is that of half of the rows of quality 1, by the digests of their ids; the other half calibrates (`most` bounds the former, for
those who want a smaller model). Its words seen twice make the vocabulary; other words are one
type, spelled out uniformly over as many words as the trusted text holds once. Counts, continuation counts and discounts are grouped and joined in Spark. All documents
are then scored: units of documents deal their word pairs to shards by a hash of the pair, and meet the counts of the shard there. There is a
number of shards for every GROUP_TOKENS tokens; a unit's part of a shard that is far more than its share (a frequent pair) is salted, and
only shards that have salts get their counts more than once. Counts go to the shards packed. The vocabulary, with two numbers a word, is broadcast: it grows with the trusted
text, as vocabularies do, while pairs are never collected. A shard sends a
unit its documents' partial sums as one packed row, and a unit adds up its rows to
the documents' perplexities (of their words and one end).

A document is kept if its perplexity is not far above a language-specific quantile, taken over other
trusted documents than those the model has learned from; a language with fewer than LEAST such
documents uses those of all languages.

Defined results: a null text is the empty text and has the perplexity of the end token; a null language is a
language; of rows that repeat a trusted id one is learned from; without trusted documents all probabilities are uniform and all documents are kept; rows
that repeat are judged alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pitman_yor as py
from . import shingles as sh
from .running import shuffled_by
from .tables import stored

#: Rows that `trusted_ids` draws for training where no other number is asked for; `classify` takes all.
TRUSTED = 4000
LEAST = 50
#: The quantile of the calibration perplexities, and how far beyond it a document may lie.
HIGH, SLACK = 0.99, 1.1
#: Ranks of the quantile are right to one in so many.
ACCURACY = 100_000
SHARDS, GROUP_TOKENS = 16, 64_000_000
UNIT_TOKENS, UNIT_DOCS = 300_000, 60_000


class Types:
    """The vocabulary by hash; `unknown` is one more type, `start` a context."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.unknown, self.start = len(hashes), len(hashes) + 1

    def ids(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(h), self.unknown)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, self.unknown)

    def pairs(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        """(context, type) of each token as one number."""
        types = self.ids(h)
        first = np.concatenate(([True], d[1:] != d[:-1]))
        before = np.where(first, self.start, np.concatenate(([self.start], types[:-1])))
        return (before.astype(np.uint64) << np.uint64(32)) | types.astype(np.uint64)


def _grouped(keys_of):
    def run(batches):
        np.seterr(over="ignore")
        for b in batches:
            for _, _, h, d in py._tokens(b):
                k, c = np.unique(keys_of(h, d), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], names=["k", "c"])

    return run


def _counts(texts: DataFrame, keys_of) -> DataFrame:
    return texts.mapInArrow(_grouped(keys_of), "k long, c long").groupBy("k").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame, column: str) -> list[float]:
    """D1, D2 and D3+ of modified Kneser-Ney from the counts of counts."""
    n = [float(x or 0) for x in counts.agg(*[F.sum(F.when(F.col(column) == k, 1)) for k in (1, 2, 3, 4)]).first()]
    if not all(n):
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0.05), k + 0.95) for k in range(3)]


def _less(column: str, d: list[float]):
    return F.when(F.col(column) == 1, d[0]).when(F.col(column) == 2, d[1]).otherwise(d[2])


class Model:
    """What every task needs, as large as the vocabulary: types, their lower-order probabilities, contexts' back-off weights."""

    def __init__(self, types: Types, lower: np.ndarray, weight: np.ndarray, spelled: np.ndarray, size: np.ndarray, discounts: list[float]):
        self.types, self.lower, self.weight, self.spelled, self.size, self.discounts = types, lower, weight, spelled, size, np.array([0.0, *discounts])

    def shares(self, k: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The discounted shares in their contexts of pairs that are seen c times."""
        return (c - self.discounts[np.minimum(c, 3)]) / self.size[(k >> np.uint64(32)).astype(np.int64)]


def train(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model of trusted texts(_id, text), and (k, c): how often each pair is seen."""
    counted = stored(_counts(texts, lambda h, d: h), "kn-words")
    once = counted.where("c < 2").count()
    words = counted.where("c > 1").select("k").toArrow()["k"].to_numpy().view(np.uint64)  # the vocabulary
    types = Types(words)
    seen = stored(_counts(texts, types.pairs).sortWithinPartitions("k"), "kn-pairs")  # in order it takes less room
    pairs = seen.select("k", "c", F.shiftright("k", 32).alias("u"), F.col("k").bitwiseAND(0xFFFFFFFF).alias("w"))
    d = _discounts(pairs, "c")
    contexts = pairs.groupBy("u").agg(F.sum("c").alias("n"), F.sum(_less("c", d)).alias("less"))
    follow = pairs.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    d1 = _discounts(follow, "n")
    total, rest = (float(x or 0) for x in follow.agg(F.sum("n"), F.sum(_less("n", d1))).first())
    low = follow.select("w", (F.col("n") - _less("n", d1)).alias("x")).toArrow()  # a row a type
    size = len(words) + 1
    lower = np.full(size, 1.0 / size)
    spelled = np.ones(size)
    spelled[-1] = 1.0 / max(once, 1)
    if total:
        lower *= rest / total
        lower[low["w"].to_numpy()] += low["x"].to_numpy() / total
    back = contexts.select("u", "n", (F.col("less") / F.col("n")).alias("x")).toArrow()  # a row a type
    weight, held = np.ones(size + 1), np.ones(size + 1)
    weight[back["u"].to_numpy()], held[back["u"].to_numpy()] = back["x"].to_numpy(), back["n"].to_numpy()
    return Model(types, lower, weight, spelled, held, d), seen


def _deal(docs: DataFrame, shared, shards: int, salts: int) -> DataFrame:
    """Blobs of the pairs of each unit of documents by shard; below 0, the documents themselves."""

    def run(batches):
        from pyspark import TaskContext

        np.seterr(over="ignore")
        types = shared.value.types
        unit, held, docs_, n, tokens = TaskContext.get().partitionId() << 32, [], [], 0, 0

        def flush():
            h, d = (np.concatenate([p[k] for p in held]) for k in (0, 1))
            keys = types.pairs(h, d)
            shard = (sh.mix(keys) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            table = pa.concat_tables(docs_).append_column("n_tokens", pa.array(np.bincount(d, minlength=n).astype(np.int64)))
            spread = int(sh.mix(np.array([unit], np.uint64))[0])
            out = [(-1 - spread % shards, spread // shards % salts, py.to_ipc(table))]
            for j in np.flatnonzero(np.diff(cuts)).tolist():
                own = order[cuts[j] : cuts[j + 1]]
                k, m, _, dd = py._runs(keys[own], d[own], np.zeros(len(own), bool))
                fat = len(own) >= py.FAT_TOKENS and len(own) * shards >= py.FAT * len(keys)
                out.append((j, spread // shards % salts if fat else 0, py._pack(k=k, n=m, d=dd)))
            to, salt, blobs = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(salt, pa.int32()), pa.array([unit] * len(out), pa.int64()), pa.array(blobs, pa.binary())], names=["shard", "salt", "unit", "blob"])

        for b in batches:
            rows = pa.Table.from_batches([b]).select(["doc_id", "lang"])
            for first, last, h, d in py._tokens(b):
                while first < last:
                    take = min(last, first + UNIT_DOCS - n)
                    hi = int(np.searchsorted(d, take - first)) if take < last else len(d)
                    held.append((h[:hi], d[:hi] + n))
                    docs_.append(rows.slice(first, take - first))
                    n, tokens = n + take - first, tokens + hi
                    h, d = h[hi:], d[hi:] - (take - first)
                    first = take
                    if n >= UNIT_DOCS or tokens >= UNIT_TOKENS:
                        yield flush()
                        unit, held, docs_, n, tokens = unit + UNIT_DOCS, [], [], 0, 0
        if n:
            yield flush()

    return docs.select("doc_id", "text", "lang").mapInArrow(run, "shard int, salt int, unit long, blob binary")


def _score(own: DataFrame, seen: DataFrame, shared, shards: int, salts: int) -> DataFrame:
    """doc_id, lang, n_tokens and log10 probability of the documents."""
    dealt, id_type = _deal(own, shared, shards, salts), own.schema["doc_id"].dataType.simpleString()

    def deal_seen(batches):
        np.seterr(over="ignore")
        held = []

        def flush():
            k, c = (np.concatenate(x) for x in zip(*held))
            shard = (sh.mix(k) % np.uint64(shards)).astype(np.int64)
            order = np.lexsort((k, shard))
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            some = np.flatnonzero(np.diff(cuts))
            blobs = [py._pack(k=k[own], w=c[own]) for own in (order[cuts[j] : cuts[j + 1]] for j in some)]
            return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(blobs, pa.binary())], names=["shard", "seen"])

        for b in batches:
            held.append((b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()))
            if sum(len(k) for k, _ in held) >= UNIT_TOKENS:
                yield flush()
                held = []
        if held:
            yield flush()

    counts = seen.select("k", "c").mapInArrow(deal_seen, "shard int, seen binary")
    if salts == 1:
        counts = counts.withColumn("salt", F.lit(0))
    else:  # the shards and salts that occur, without frequent pairs one a shard; texts are dealt twice, since the blobs are as large as the input
        salted = dealt.where("shard >= 0").select(F.col("shard").alias("of"), F.col("salt").alias("with")).distinct()
        counts = counts.join(F.broadcast(salted), F.col("shard") == F.col("of")).select("shard", F.col("with").alias("salt"), "seen")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        blobs = []
        if left.num_rows and left["shard"][0].as_py() < 0:
            blobs = left["blob"].to_pylist()
        elif left.num_rows:
            m = shared.value
            parts = [py._unpack(x.as_buffer()) for x in right["seen"]]
            known, c = (np.concatenate([np.zeros(0, np.uint64), *(x[name] for x in parts)]) for name in "kw")
            order = np.argsort(known)
            known, share = known[order], m.shares(known[order], c[order].astype(np.int64))
            for blob in left["blob"]:
                u = py._unpack(blob.as_buffer())
                k = u["k"]
                p = m.weight[(k >> np.uint64(32)).astype(np.int64)] * m.lower[(k & np.uint64(0xFFFFFFFF)).astype(np.int64)]
                if len(known):
                    at = np.minimum(np.searchsorted(known, k), len(known) - 1)
                    hit = known[at] == k
                    p[hit] += share[at[hit]]
                p *= m.spelled[(k & np.uint64(0xFFFFFFFF)).astype(np.int64)]
                blobs.append(py.partial_sums(u["d"], np.repeat(np.log10(p), u["n"])))
        units = left["unit"].to_pylist() if left.num_rows else []
        return pa.table({"unit": pa.array(units, pa.int64()), "shard": pa.array([left["shard"][0].as_py()] * len(units) if units else [], pa.int32()), "blob": pa.array(blobs, pa.binary())})

    def total(parts: pa.Table) -> pa.Table:
        docs, logp = None, []
        for shard, blob in zip(parts["shard"].to_pylist(), parts["blob"]):
            if shard < 0:
                docs = pa.ipc.open_stream(blob.as_buffer()).read_all()
            else:
                logp.append(blob.as_buffer())
        return docs.append_column("logp", pa.array(py.added(logp, 1, docs.num_rows)[0]))

    parts = dealt.groupBy("shard", "salt").cogroup(counts.groupBy("shard", "salt")).applyInArrow(run, "unit long, shard int, blob binary")
    return parts.groupBy("unit").applyInArrow(total, f"doc_id {id_type}, lang string, n_tokens long, logp double")


def in_half(doc_id: str):
    """Whether an id is of the half that is learned from if it is trusted."""
    return shuffled_by("trusted", doc_id) < "8"


def trusted_ids(labels: DataFrame, most: int | None = TRUSTED) -> tuple[DataFrame, DataFrame]:
    """Ids to train on, half of the rows of quality 1 that are not toxic (`most` at most; None: all of that half), and to calibrate on, all others of them."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct().withColumn("_o", shuffled_by("trusted", "doc_id"))
    half = in_half("doc_id")
    if most is None:
        return good.where(half).select("doc_id"), good.where(~half).select("doc_id")
    to_train = good.where(half).orderBy("_o", "doc_id").limit(most).select("doc_id")
    return to_train, good.select("doc_id").join(to_train, "doc_id", "left_anti")


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", most: int | None = None) -> DataFrame:
    """doc_id, lang, n_tokens, perplexity, threshold and kept of each row of docs; most: how many trusted documents are learned from, None for all of their half."""
    sc = docs.sparkSession.sparkContext
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(lang).cast("string").alias("lang"))
    to_train, to_check = (stored(x.select(F.col("doc_id").cast("string").alias("_id")), "trusted") for x in trusted_ids(labels, most))
    named = own.withColumn("_id", F.col("doc_id").cast("string"))
    mine = named.where(in_half("_id"))  # texts of other ids need not be shuffled to be told from trusted ones
    trusted = stored(mine.join(to_train, "_id", "left_semi").groupBy("_id").agg(F.min("text").alias("text")), "trusted-text")
    model, seen = train(trusted)
    n = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    salts = -(-(n // 4 + 1) // GROUP_TOKENS)
    shards = SHARDS * -(-salts // 8)
    shared = sc.broadcast(model)
    total = _score(own, seen, shared, shards, salts)
    judged = stored(total.select("doc_id", "lang", "n_tokens", F.pow(F.lit(10.0), -F.col("logp") / F.col("n_tokens")).alias("perplexity")), "perplexities")
    check = judged.join(to_check, F.col("doc_id").cast("string") == F.col("_id"))
    cut = F.percentile_approx("perplexity", F.lit(HIGH), F.lit(ACCURACY))  # over all of them, by sketches of a bounded size
    by_lang = check.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), cut.alias("cut")).where(F.col("n") >= LEAST)
    overall = check.agg(cut).first()[0]
    out = judged.join(F.broadcast(by_lang.select(F.col("lang").alias("_l"), "cut")), F.col("lang").eqNullSafe(F.col("_l")), "left")  # a row a language
    most = F.coalesce("cut", F.lit(overall), F.lit(float("inf"))) * SLACK
    return out.select("doc_id", "lang", "n_tokens", "perplexity", most.alias("threshold"), (F.col("perplexity") <= most).alias("kept"))
