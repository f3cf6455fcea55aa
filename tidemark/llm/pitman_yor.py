"""A hierarchical Pitman-Yor language model, learned by Gibbs sampling over all training documents.

Each word of the training texts is a type of its own, and all unseen words are one more. Each context (the word before; the start
of a text) has a restaurant whose parent, shared by all, is the root restaurant over types; the root's parent is uniform.
Words that make up at least FREQUENT of the training tokens (at most 1 / FREQUENT of them) have ids and their
counts and root probabilities are broadcast; a bucket gets those of its other words by joins on their hashes. FREQUENT
sets how a value is looked up, not what it is.

Spark deals occurrences out by context, to MOST_BUCKETS buckets at most (a bucket's distinct pairs are what one task must hold); a context
with many tokens is split by the type that follows, so no bucket grows with one word, and a bucket's occurrences are salted, so that no
group grows with one pair. A bucket samples, SLICE of its pairs after another, how many tables serve each type
in each of its restaurants: per dish, a customer's table indicator is removed and drawn again from
its conditional (Chen, Du and Buntine 2011), or the count of tables moves as a whole where customers are
many, in two alternating halves of the dishes. The tables are the
root's customers. Two passes are made: the first gives the root its customers, the root is sampled, the second averages the
predictive probabilities of SAMPLES states and scores every document with them. Split contexts are seated
with the words' shares for prior and a set number of tables around them, once in each pass by the same random numbers, so that the
first pass knows the total of the very tables that the second one uses, and probabilities sum to 1. Words with as many customers in the
root have the same distribution there: the root is sampled by the histogram of customers, TWINS dishes of a size at most, which then stand for all of it. Each bucket sends a unit of
documents its partial sums as one packed row.

Defined results: a null text is the empty text, which has the end token alone; a null doc_id is hashed as "null";
rows that repeat are separate documents; with no training document every token has the uniform
probability; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import io
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as sh
from .tables import stored

FREQUENT = 1e-6
BUCKET_TOKENS, MOST_BUCKETS = 2_500_000, 256
#: A unit's part of a bucket is salted further if it is so many times its share, and no less than this many tokens.
FAT, FAT_TOKENS = 4, 10_000
UNIT_TOKENS = 300_000
UNIT_DOCS = 60_000
DISCOUNT, STRENGTH = 0.8, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.5, 10.0
RARE_DISCOUNT, RARE_STRENGTH = 0.8, 10.0
BURN_IN, SAMPLES = 10, 6
#: About so many of a bucket's pairs are seated at once; a context is never cut. What the sampler holds beside the pairs does not grow with the bucket.
SLICE = 100_000
END = np.uint64(0x8F1BBCDC5A827999)
#: Set in the codes of words that have no id.
HASHED = np.uint64(1 << 63)
#: Dishes of as many customers by which the root is sampled.
TWINS = 1024
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Customers of a dish up to which Stirling ratios are tabled.
TABLED = 256
#: Customers of a dish up to which one is moved in a sweep; moves of other dishes in a sweep; rounds to find the start.
FEW, MOVES, ROUNDS = 8, 2, 6


def held_out(doc_id) -> bool:
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def _tokens(batch: pa.RecordBatch):
    """(first, last, hashes, text numbers) of groups of texts; each text ends with END."""
    for first, last, data, offs in sh.groups(batch.column(1)):
        data = _LOWER[data]
        start, end, doc = sh.word_spans(data, offs)
        h, n = sh.word_hashes(data, start, end), last - first
        counts = np.bincount(doc, minlength=n)
        ends = np.cumsum(counts + 1) - 1
        out, docs = np.empty(len(h) + n, np.uint64), np.repeat(np.arange(n), counts + 1)
        body = np.ones(len(out), bool)
        body[ends] = False
        out[body], out[ends] = h, END
        yield first, last, out, docs


def _count(batches):
    np.seterr(over="ignore")
    words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for b in batches:
        held = b.column(2).to_numpy(zero_copy_only=False)
        parts = [h[~held[d + first]] for first, _, h, d in _tokens(b)]
        w, c = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
        both, at = np.unique(np.concatenate((words, w)), return_inverse=True)
        counts = np.bincount(at, np.concatenate((counts, c)), len(both)).astype(np.int64)
        words = both
    yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["w", "c"])


class Vocabulary:
    """The frequent types by hash; ids follow the order of hashes, then one of all others; BOS is a context only."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int, distinct: int, documents: int):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order].astype(np.float64)
        self.rare, self.bos = len(hashes), len(hashes) + 1
        self.total, self.distinct = total, distinct
        rare = max(0.0, total - self.counts.sum())
        self.contexts = np.concatenate((self.counts, [rare, documents]))
        self.shares = (np.concatenate((self.counts, [rare])) + 1) / (total + len(hashes) + 1)

    def ids(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(h), self.rare)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, self.rare)

    def codes(self, h: np.ndarray) -> np.ndarray:
        """A word's id if it has one, else its hash."""
        ids = self.ids(h)
        return np.where(ids == self.rare, h | HASHED, ids.astype(np.uint64))

    def hot(self, pairs: int) -> np.ndarray:
        """Whether each context's types are dealt to several buckets; words without an id are too few for that."""
        return _hot(self, pairs) & (np.arange(len(self.contexts)) != self.rare)


def _hot(v, pairs: int) -> np.ndarray:
    return v.contexts >= max(2.0, v.total / (2 * pairs))


def _vocabulary(docs: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The frequent words, and (w, c): the training count of each word."""
    table = stored(docs.mapInArrow(_count, "w long, c long").groupBy("w").agg(F.sum("c").alias("c")), "unigrams")
    end = int(END.astype(np.int64)) if END < np.uint64(1 << 63) else int(END) - (1 << 64)
    total, distinct, documents = table.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max(F.when(F.col("w") == end, F.col("c"))), F.lit(0))).first()
    top = table.where((F.col("c") >= max(2.0, FREQUENT * total)) | (F.col("w") == end)).toArrow()
    return Vocabulary(top["w"].to_numpy().view(np.uint64), top["c"].to_numpy(), total, distinct, documents), table


_KINDS = {"k": np.uint64, "u": np.uint64, "w": np.uint64, "i": np.uint32, "n": np.uint32, "c": np.uint32, "d": np.uint16}


def _pack(**arrays: np.ndarray) -> bytes:
    """Arrays of the kinds above, compressed: ascending ones (k, u, i) as steps, and all by byte plane."""
    out = {}
    for name, a in arrays.items():
        a = a.astype(_KINDS[name])
        if name in "kui":
            a = np.diff(a, prepend=np.zeros(1, a.dtype))
        out[name] = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    raw = io.BytesIO()
    np.savez(raw, **out)
    raw = raw.getvalue()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob) -> dict[str, np.ndarray]:
    view = memoryview(blob)
    raw = pa.decompress(pa.py_buffer(view[8:]), decompressed_size=int.from_bytes(view[:8], "little"), codec="zstd", asbytes=True)
    with np.load(io.BytesIO(raw)) as z:
        out = {k: np.ascontiguousarray(z[k].T).view(_KINDS[k]).ravel() for k in z.files}
    return {k: np.cumsum(a, dtype=a.dtype) if k in "kui" else a for k, a in out.items()}


def partial_sums(docs: np.ndarray, *values: np.ndarray) -> bytes:
    """Sums of each of the values by document number, of the documents that occur."""
    docs = docs.astype(np.int64)
    some = np.flatnonzero(np.bincount(docs)).astype(np.uint16)
    return some.tobytes() + b"".join(np.bincount(docs, x)[some].tobytes() for x in values)


def added(blobs: list, width: int, n: int) -> list[np.ndarray]:
    """`width` totals of n documents from partial_sums of as many values."""
    out = [np.zeros(n) for _ in range(width)]
    for blob in blobs:
        k = len(blob) // (2 + 8 * width)
        some = np.frombuffer(blob, np.uint16, k)
        for j, x in enumerate(out):
            x[some] += np.frombuffer(blob, np.float64, k, 2 * k + 8 * k * j)
    return out


def to_ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _runs(keys: np.ndarray, docs: np.ndarray, train: np.ndarray):
    """Occurrences by key: distinct keys, occurrences and training occurrences of each, and the documents in that order."""
    order = np.argsort(keys, kind="stable")
    keys, docs, train = keys[order], docs[order], train[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(np.append(at, len(keys)))
    c = np.add.reduceat(train.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    return keys[at], n.astype(np.uint32), c.astype(np.uint32), docs.astype(np.uint16)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal keys start."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _pair_runs(u: np.ndarray, w: np.ndarray, docs: np.ndarray, train: np.ndarray) -> dict[str, np.ndarray]:
    """Occurrences in the order of context and word: as _runs."""
    at = _starts(u, w)
    return {"u": u[at], "w": w[at], "n": np.diff(np.append(at, len(u))), "c": np.add.reduceat(train.astype(np.int64), at), "d": docs}


def _distinct(u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs in order, and which of them each pair is."""
    order = np.lexsort((w, u))
    u, w = u[order], w[order]
    at = _starts(u, w)
    which = np.empty(len(u), np.uint32)
    which[order] = np.repeat(np.arange(len(at), dtype=np.uint32), np.diff(np.append(at, len(u))))
    return u[at], w[at], which


_DEALT = "bucket int, salt long, unit long, blob binary"


def _deal(docs: DataFrame, shared, pairs: int, rares: int, salts: int) -> DataFrame:
    """Blobs of the occurrences of each unit of documents for each bucket: contexts in the first `pairs` buckets, rare words in the next `rares`, documents behind."""

    def run(batches):
        from pyspark import TaskContext

        np.seterr(over="ignore")
        v = shared.value
        hot = v.hot(pairs)
        unit, state = TaskContext.get().partitionId() << 32, {"n": 0, "tokens": 0, "parts": [], "docs": [], "held": []}

        def flush():
            nonlocal unit
            if not state["n"]:
                return None
            h, d = (np.concatenate([p[k] for p in state["parts"]]) for k in (0, 1))
            ids, held = pa.concat_arrays(state["docs"]), np.concatenate(state["held"])
            types = v.ids(h)
            first = np.concatenate(([True], d[1:] != d[:-1]))
            codes = v.codes(h)
            before = np.where(first, np.uint64(v.bos), np.concatenate((np.array([v.bos], np.uint64), codes[:-1])))
            split = hot[np.where(before < HASHED, before, v.rare).astype(np.int64)]
            train, is_rare = ~held[d], types == v.rare
            counts = np.append(v.counts, 0.0)[types]
            n = len(ids)
            base = np.bincount(d[~is_rare], np.log10((counts[~is_rare] + 0.1) / (v.total + 0.1 * (v.distinct + 1))), n)
            spread = int(sh.mix(np.array([unit], np.uint64))[0])
            out = [(pairs + rares + spread % pairs, spread // pairs % salts, unit, _docs_blob(ids, held, np.bincount(d, minlength=n), base, np.bincount(d[counts > 0], minlength=n)))]
            home = ((sh.mix(before) + np.where(split, sh.mix(codes + np.uint64(1 << 40)), np.uint64(0))) % np.uint64(pairs)).astype(np.int64)

            def deal(order, bucket, many, packed):
                present, first = np.unique(bucket[order], return_index=True)
                for j, lo, hi in zip(present.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
                    own = order[lo:hi]
                    ways = salts * max(1, len(own) * many // (FAT * len(order)) if len(own) >= FAT_TOKENS else 1)
                    out.append((j, spread % ways, unit, packed(own)))

            deal(np.lexsort((codes, before, home)), home, pairs, lambda own: _pack(**_pair_runs(before[own], codes[own], d[own], train[own])))
            k, dd, tt = h[is_rare], d[is_rare], train[is_rare]
            rare_home = pairs + (sh.mix(k) % np.uint64(rares)).astype(np.int64)
            deal(np.argsort(rare_home, kind="stable"), rare_home, rares, lambda own: _pack(**dict(zip("kncd", _runs(k[own], dd[own], tt[own])))))
            unit += UNIT_DOCS
            state.update(n=0, tokens=0, parts=[], docs=[], held=[])
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary())], names=["bucket", "salt", "unit", "blob"])

        for b in batches:
            for first, last, h, d in _tokens(b):
                while first < last:  # a group of very short texts may overfill a unit
                    take = min(last, first + UNIT_DOCS - state["n"])
                    lo, hi = np.searchsorted(d, [0, take - first]) if take < last else (0, len(d))
                    state["parts"].append((h[lo:hi], d[lo:hi] + state["n"]))
                    state["docs"].append(b.column(0).slice(first, take - first))
                    state["held"].append(b.column(2).slice(first, take - first).to_numpy(zero_copy_only=False))
                    state["n"] += take - first
                    state["tokens"] += hi - lo
                    h, d = h[hi:], d[hi:] - (take - first)
                    first = take
                    if state["n"] >= UNIT_DOCS or state["tokens"] >= UNIT_TOKENS:
                        yield flush()
        rest = flush()
        if rest is not None:
            yield rest

    return docs.mapInArrow(run, _DEALT)


def _docs_blob(ids: pa.Array, held, tokens, base, known) -> bytes:
    return to_ipc(pa.table({"doc_id": ids, "held_out": held, "n_tokens": tokens.astype(np.int64), "base_score": base, "n_known": known.astype(np.float64)}))


_GATHERED = "bucket int, salt long, keys binary, units array<long>, blobs array<binary>"


def _gather(parts: pa.Table) -> pa.Table:
    """One row a bucket and salt: its distinct keys (of pairs: contexts and words) with training counts, and each unit's occurrences by key number."""
    blobs = [_unpack(x.as_buffer()) for x in parts["blob"]]
    if "u" in blobs[0]:
        *keys, at = _distinct(*(np.concatenate([b.pop(x) for b in blobs]) for x in "uw"))
    else:
        *keys, at = np.unique(np.concatenate([b["k"] for b in blobs]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([b["c"] for b in blobs]), len(keys[0])).astype(np.uint32)
    packed = _pack(**dict(zip("uw" if len(keys) > 1 else "k", keys)), c=counts)
    del keys, counts
    own, low = [], 0
    for b in blobs:
        # the pairs of a unit are in the order of those of the bucket
        own.append(_pack(i=at[low : low + len(b["n"])].astype(np.uint32), n=b["n"], d=b["d"]))
        low += len(b["n"])
    return pa.table({"bucket": parts["bucket"][:1], "salt": parts["salt"][:1], "keys": pa.array([packed], pa.binary()), "units": pa.array([parts["unit"].to_pylist()], pa.list_(pa.int64())), "blobs": pa.array([own], pa.list_(pa.binary()))})


def _merged(parts: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """The keys, words and counts of a bucket, and where each of its salts' keys are among them."""
    each = [_unpack(x.as_buffer()) for x in parts["keys"]]
    own, none = "u" if "u" in each[0] else "k", np.zeros(0, np.uint64)
    if len(each) == 1:
        return each[0][own], each[0].get("w", none), each[0]["c"].astype(np.int64), [slice(None)]
    keys, w = np.concatenate([b[own] for b in each]), np.concatenate([b.get("w", none) for b in each])
    if len(w):
        keys, w, at = _distinct(keys, w)
    else:
        keys, at = np.unique(keys, return_inverse=True)
    counts = np.bincount(at, np.concatenate([b["c"] for b in each]), len(keys)).astype(np.int64)
    return keys, w, counts, np.split(at, np.cumsum([len(b[own]) for b in each])[:-1])


class Ratios:
    """S(c, t + 1) / S(c, t) of generalised Stirling numbers: tabled for c up to TABLED, and by their scaling in t / c**d beyond."""

    def __init__(self, discount: float):
        self.d = discount
        row = np.full(TABLED + 2, -np.inf)
        row[1] = 0.0
        self.table = np.zeros((TABLED + 1, TABLED + 1), np.float64)
        t = np.arange(TABLED + 2)
        for c in range(1, TABLED + 1):
            with np.errstate(invalid="ignore", divide="ignore"):
                self.table[c, 1:c] = np.exp(row[2 : c + 1] - row[1:c])
                row = np.logaddexp(np.concatenate(([-np.inf], row[:-1])), np.log(np.maximum(c - t * discount, 0.0)) + row)
        # the scaled ratio tends to 1 as t / c**d does to 0
        self.scale = np.concatenate(([1.0], self.table[TABLED, 1:TABLED] * discount * np.arange(1, TABLED)))
        with np.errstate(divide="ignore"):
            self.logs = np.concatenate((np.full((TABLED + 1, 1), -np.inf), np.cumsum(np.log(np.concatenate((np.ones((TABLED + 1, 1)), self.table[:, 1:TABLED]), 1)), 1)), 1)
        steps = np.log(self.scale)
        self.area = np.concatenate(([0.0], np.cumsum((steps[1:] + steps[:-1]) / 2)))

    def __call__(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        small = c <= TABLED
        out = np.empty(len(c))
        out[small] = self.table[c[small], np.minimum(t[small], TABLED)]
        if not small.all():
            cl, tl = c[~small].astype(float), t[~small].astype(float)
            g = np.interp(tl * (TABLED / cl) ** self.d, np.arange(TABLED), self.scale)
            out[~small] = g / (self.d * tl)
        return out

    def log(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        """ln S(c, t) but for a constant of c."""
        small = c <= TABLED
        out = np.empty(len(c))
        out[small] = self.logs[c[small], t[small]]
        if not small.all():
            cl, tl = c[~small].astype(float), t[~small].astype(float)
            shrink = (TABLED / cl) ** self.d
            x = (tl - 0.5) * shrink
            k = np.minimum(x.astype(np.int64), TABLED - 2)
            low, high = np.log(self.scale[k]), np.log(self.scale[k + 1])
            f = x - k
            out[~small] = (self.area[k] + f * (low + f * (high - low) / 2)) / shrink - _lgamma(tl) - tl * np.log(self.d)
        return out


def _lgamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x >= 1, to 1e-6."""
    y = x + 2.0
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) - np.log(x * (x + 1))


def _mode(c: np.ndarray, prior: np.ndarray, rest: np.ndarray, grows: np.ndarray, discount: float, strength: float, ratios: Ratios) -> np.ndarray:
    """The likeliest tables of each dish beside `rest` others; grows: whether its own add to them."""
    low, high = np.ones(len(c), np.int64), c.copy()
    while len(at := np.flatnonzero(low < high)):
        mid = (low[at] + high[at]) // 2
        more = prior[at] * (strength + discount * (rest[at] + grows[at] * mid)) * ratios(c[at], mid) > 1
        low[at] = np.where(more, mid + 1, low[at])
        high[at] = np.where(more, high[at], mid)
    return low


def seat(c: np.ndarray, group: np.ndarray, prior: np.ndarray, fixed: np.ndarray | None, discount: float, strength: float, ratios: Ratios, rng, burn_in: int, samples: int, held: np.ndarray | float = 1.0):
    """Tables of dishes with c >= 1 customers: yields (t, T) for each kept state.

    group: the dish's restaurant; prior: the dish's probability in the parent; fixed: total tables by restaurant where
    known from elsewhere, NaN where they are counted here; held: for how many dishes each stands in the totals. Dishes start at their likeliest tables. In a sweep those of up to
    FEW customers move one customer, others make MOVES Metropolis moves as wide as their conditional, so
    that a state does not depend on how many sweeps came before.
    """
    n = int(group.max()) + 1 if len(group) else 0
    known = np.zeros(n, bool) if fixed is None else ~np.isnan(fixed)
    grows = ~known[group]

    def counted():
        totals = np.bincount(group, t * held, n)
        return totals if fixed is None else np.where(known, fixed, totals)

    t = np.ones(len(c), np.int64)
    free = np.flatnonzero(c > 1)
    t[free] = np.maximum(1, c[free] ** discount / 2).astype(np.int64)
    for _ in range(ROUNDS if len(free) and grows[free].any() else 1):
        totals = counted()
        t[free] = _mode(c[free], prior[free], totals[group[free]] - grows[free] * t[free], grows[free], discount, strength, ratios)
    many = c > FEW
    wide = np.ones(len(c))
    big = np.flatnonzero(many)
    if len(big):
        totals, h = counted(), np.maximum(1, t[big] // 8)
        rest, up, down = totals[group[big]] - grows[big] * t[big], np.minimum(t[big] + h, c[big] - 1), np.maximum(t[big] - h, 1)
        slope = np.log(ratios(c[big], down) * (strength + discount * (rest + grows[big] * down))) - np.log(ratios(c[big], up) * (strength + discount * (rest + grows[big] * up)))
        wide[big] = np.maximum(1.0, 2.4 / np.sqrt(np.maximum(slope / np.maximum(up - down, 1), 1.0 / t[big].astype(float) ** 2)))
    halves = [free[rng.random(len(free)) < 0.5], None]
    halves[1] = np.setdiff1d(free, halves[0], assume_unique=True)
    parts = [(own[~many[own]], own[many[own]]) for own in halves]
    for sweep in range(burn_in + samples):
        for own, large in parts:
            totals = counted()
            if len(own):
                ct, tt = c[own], t[own]
                picked = rng.random(len(own)) * ct < tt  # the customer drawn has opened a table; a lone table stays
                opens = picked & (tt > 1)
                left = tt - opens
                odds = prior[own] * (strength + discount * (totals[group[own]] - opens)) * ratios(ct, left) * (left + 1) / np.maximum(ct - left, 1)
                fresh = (rng.random(len(own)) * (1 + odds) < odds) & (left < ct)
                moved = np.where(picked & (tt == 1), 1, left + fresh)
            if len(large):
                cl, tl, g = c[large], t[large], grows[large]
                rest, share = totals[group[large]] - g * tl, np.log(prior[large])
                flat = share + np.where(g, np.log(discount), np.log(strength + discount * rest))

                def weight(x):
                    return ratios.log(cl, x) + x * flat + np.where(g, _lgamma(strength / discount + rest + x), 0.0)

                now = weight(tl)
                for _ in range(MOVES):
                    to = tl + np.rint(wide[large] * rng.standard_normal(len(large))).astype(np.int64)
                    inside = (to >= 1) & (to <= cl)
                    to = np.where(inside, to, tl)
                    then = weight(to)
                    yes = inside & (np.log(rng.random(len(large))) < then - now)
                    tl, now = np.where(yes, to, tl), np.where(yes, then, now)
                t[large] = tl
            if len(own):
                t[own] = moved
        if sweep >= burn_in:
            yield t, counted().astype(float)


class Seats:
    """The dishes of a bucket's keys (in the order of contexts) with training counts: contexts, types, and mean tables at SAMPLES states."""

    def __init__(self, bucket: int, keys: np.ndarray, counts: np.ndarray, v: Vocabulary, pairs: int, ratios: Ratios):
        halves = np.ascontiguousarray(keys, "<u8").view("<u4").reshape(-1, 2)
        self.ctx, self.types, self.c = halves[:, 1], halves[:, 0], counts
        self.split = _hot(v, pairs)[self.ctx]
        self.bucket, self.v, self.ratios = bucket, v, ratios
        starts = np.append(_starts(self.ctx), len(keys))
        self.slices = [(0, 0)]
        while (low := self.slices[-1][1]) < len(keys):
            self.slices.append((low, int(starts[min(np.searchsorted(starts, low + SLICE), len(starts) - 1)])))

    def _seat(self, n: int, prior: np.ndarray, apart: bool, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Dishes of slice n, with mean and last tables; apart: those of restaurants of which other buckets have a part."""
        low, high = self.slices[n]
        which = low + np.flatnonzero((self.split[low:high] == apart) & (self.c[low:high] > 0))
        mean, last = np.zeros(len(which)), np.zeros(len(which), np.int64)
        if len(which):
            own, group = np.unique(self.ctx[which], return_inverse=True)
            # as many tables around a part as a restaurant of so many customers has at first
            fixed = self.v.contexts[own] ** DISCOUNT if apart else None
            rng = np.random.default_rng([self.bucket, int(apart), n])
            for t, _ in seat(self.c[which], group, prior[self.types[which]], fixed, DISCOUNT, STRENGTH, self.ratios, rng, BURN_IN, samples):
                mean += t / samples
                last = t.copy()
        return which, mean, last

    def part(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Dishes of split contexts in slice n, with mean and last tables: the same whenever called."""
        return self._seat(n, self.v.shares, True, SAMPLES)

    def whole(self, n: int, prior: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self._seat(n, prior, False, samples)

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As part, of all slices."""
        return tuple(map(np.concatenate, zip(*(self.part(n) for n in range(len(self.slices))))))

    def predictive(self, root: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The probability of each key's type in its context; tables: totals of split contexts."""
        out = np.zeros(len(self.c))  # first the tables
        for n, (low, high) in enumerate(self.slices):
            if low == high:
                continue
            at, mean, _ = self.whole(n, root, SAMPLES)
            out[at] = mean
            ctx, c, t = self.ctx[low:high], self.c[low:high], out[low:high]
            total = np.where(self.split[low:high], tables[ctx], np.bincount(ctx - ctx[0], t)[ctx - ctx[0]])
            at, mean, _ = self.part(n)
            out[at] = mean
            t[:] = (np.where(c > 0, c - DISCOUNT * t, 0.0) + (STRENGTH + DISCOUNT * total) * root[self.types[low:high]]) / (STRENGTH + self.v.contexts[ctx])
        return out


class Part:
    """The words and contexts of a bucket's pairs: as much of the corpus as its Seats ask for."""

    def __init__(self, v: Vocabulary, u: np.ndarray, w: np.ndarray, c: np.ndarray, told: pa.Table):
        """told: rows of a word (code) and its training count (c), of the words without an id that have a dish of more than one customer; and
        packed ones of words (k) and their customers in the root (n)."""
        self.total = v.total
        at = _starts(u)  # contexts are in order
        owners = u[at]
        self.contexts = np.add.reduceat(c, at).astype(float)
        order = np.argsort(w)
        first = _starts(w[order])
        self.words = w[order[first]]
        # two 32-bit halves in place: context and type of each pair
        self.keys = np.empty(len(u), np.uint64)
        halves = self.keys.view(np.uint32).reshape(-1, 2)
        halves[:, 1] = np.repeat(np.arange(len(at), dtype=np.uint32), np.diff(np.append(at, len(u))))
        halves[order, 0] = np.repeat(np.arange(len(first), dtype=np.uint32), np.diff(np.append(first, len(w))))
        del order
        named = owners < HASHED
        self.owners = np.where(named, owners, np.uint64(v.rare)).astype(np.int64)
        self.contexts[named] = v.contexts[self.owners[named]]
        self.named = self.words < HASHED
        self.ids = self.words[self.named].astype(np.int64)
        counts = np.zeros(len(self.words))
        rows = told.filter(pc.is_valid(told["code"]))
        counts[np.searchsorted(self.words, rows["code"].to_numpy().view(np.uint64))] = rows["c"].to_numpy()
        counts[self.named] = v.counts[self.ids]
        self.shares = (counts + 1) / (v.total + v.distinct + 1)

    def served(self, told: pa.Table, named: np.ndarray) -> np.ndarray:
        """The customers of each word in the root; named: of those that have an id, by id."""
        out = np.zeros(len(self.words))
        out[self.named] = named[self.ids]
        for blob in told["blob"].drop_null():
            b = _unpack(blob.as_buffer())
            out[np.searchsorted(self.words, b["k"])] = b["n"]
        return out


def _asked(seats: DataFrame, pairs: int, salted: list[int]) -> DataFrame:
    """(bucket, code) of the words without an id whose training count a bucket needs: of pairs that occur again."""

    def run(batches):
        for b in batches:
            for i, bucket in enumerate(b["bucket"].to_pylist()):
                w, c = map(_unpack(b["keys"][i].as_buffer()).get, "wc")
                w = np.unique(w[(w >= HASHED) & (c > (0 if bucket in salted else 1))])  # another salt may hold more
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), bucket, np.int32)), pa.array(w.view(np.int64))], names=["bucket", "code"])

    return seats.where(F.col("bucket") < pairs).select("bucket", "keys").mapInArrow(run, "bucket int, code long")


def _first_pass(seats: DataFrame, told: DataFrame, shared, pairs: int, shards: int) -> DataFrame:
    """(bucket, id, t, blob): tables of a bucket by split context; and by words (those of no table included) packed for each shard of words."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, t, blobs, bucket = [], [], [], None
        if left.num_rows:
            v, bucket = shared.value, left["bucket"][0].as_py()
            u, w, c, _ = _merged(left)
            part = Part(v, u, w, c, right)
            del u, w
            s = Seats(bucket, part.keys, c, part, pairs, Ratios(DISCOUNT))
            words, contexts = np.zeros(len(part.words)), np.zeros(len(v.contexts))
            for n in range(len(s.slices)):
                at, mean, last = s.part(n)
                np.add.at(words, s.types[at], last)
                np.add.at(contexts, part.owners[s.ctx[at]], mean)
                at, _, last = s.whole(n, part.shares, 1)
                np.add.at(words, s.types[at], last)
            home = (sh.mix(part.words) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(home, kind="stable")
            present, first = np.unique(home[order], return_index=True)
            for shard, own in zip(present.tolist(), np.split(order, first[1:])):
                ids.append(shard)
                t.append(None)
                blobs.append(_pack(k=part.words[own], n=np.rint(words[own])))
            some = np.flatnonzero(contexts)
            ids += some.tolist()
            t += contexts[some].tolist()
            blobs += [None] * len(some)
        return pa.table({"bucket": pa.array([bucket] * len(ids), pa.int32()), "id": pa.array(ids, pa.int64()), "t": pa.array(t, pa.float64()), "blob": pa.array(blobs, pa.binary())})

    own = seats.where(F.col("bucket") < pairs).select("bucket", "keys")
    return own.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(run, "bucket int, id long, t double, blob binary")


def _served(parts: pa.Table) -> pa.Table:
    """The words of a shard that have no id for each bucket that holds them, with their tables in all buckets; in bucket -1, how many of them have as many; in -2, the tables of those that have an id."""
    blobs = [_unpack(x.as_buffer()) for x in parts["blob"]]
    words, at = np.unique(np.concatenate([b["k"] for b in blobs]), return_inverse=True)
    t = np.bincount(at, np.concatenate([b["n"] for b in blobs])).astype(np.int64)
    named = words < HASHED
    sizes, held = np.unique(t[~named & (t > 0)], return_counts=True)
    out, low = [_pack(k=sizes, n=held), _pack(k=words[named], n=t[named])], 0
    for b in blobs:
        own = b["k"] >= HASHED
        out.append(_pack(k=b["k"][own], n=t[at[low : low + len(own)][own]]))
        low += len(own)
    return pa.table({"bucket": pa.array([-1, -2, *parts["bucket"].to_pylist()], pa.int32()), "blob": pa.array(out, pa.binary())})


class Root:
    """The root's averaged predictive probability of a type by its customers there.

    sizes: distinct counts of customers, ascending; held: how many types have each; n: all types."""

    def __init__(self, sizes: np.ndarray, held: np.ndarray, n: int):
        self.sizes = np.asarray(sizes, np.int64)
        total, d = float((self.sizes * held).sum()), ROOT_DISCOUNT
        self.none, self.p = 1.0 / n, np.zeros(len(self.sizes))
        if not len(self.sizes):
            return
        self.none = 0.0
        copies = np.minimum(held, TWINS).astype(np.int64)
        of = np.repeat(np.arange(len(self.sizes)), copies)
        each, c = (held / copies)[of], self.sizes[of]
        for t, tables in seat(c, np.zeros(len(c), np.int64), np.full(len(c), 1.0 / n), None, d, ROOT_STRENGTH, Ratios(d), np.random.default_rng(0), BURN_IN, SAMPLES, each):
            self.none += (ROOT_STRENGTH + d * tables[0]) / (ROOT_STRENGTH + total) / n / SAMPLES
            self.p += (self.sizes - d * np.bincount(of, t) / copies) / (ROOT_STRENGTH + total) / SAMPLES

    def __call__(self, customers: np.ndarray) -> np.ndarray:
        out = np.full(len(customers), self.none)
        some = np.flatnonzero(customers)
        out[some] += self.p[np.searchsorted(self.sizes, np.rint(customers[some]).astype(np.int64))]
        return out


def _second_pass(whole: DataFrame, split: DataFrame, told: DataFrame, shared, pairs: int) -> DataFrame:
    """(unit, kind, blob): packed partial sums of the documents of each unit in each bucket (kind 1 of contexts, 2 of words without an id).

    told: for a bucket, what its Part is told."""

    def values(left, told) -> tuple[list[np.ndarray], list]:
        """Score of each pair; of words base score and whether they are known; and where each salt's are among them."""
        v, root, customers, tables = shared.value
        bucket = left["bucket"][0].as_py()
        u, w, c, at = _merged(left)
        if bucket < pairs:
            part = Part(v, u, w, c, told)
            del u, w
            served = root(part.served(told, customers))
            p = Seats(bucket, part.keys, c, part, pairs, Ratios(DISCOUNT)).predictive(served, tables[part.owners])
            return [np.log10(p, out=p)], at
        return [np.log10((c + 0.1) / (v.total + 0.1 * (v.distinct + 1))), (c > 0).astype(float)], at

    def summed(bucket, units, blobs, each):
        for unit, blob in zip(units, blobs):
            u = _unpack(blob.as_buffer())
            at = np.repeat(u["i"], u["n"])
            yield unit, 1 if bucket < pairs else 2, partial_sums(u["d"], *(x[at] for x in each))

    def table(rows) -> pa.Table:
        unit, kind, blob = list(zip(*rows)) or ([], [], [])
        return pa.table({"unit": pa.array(unit, pa.int64()), "kind": pa.array(kind, pa.int32()), "blob": pa.array(blob, pa.binary())})

    def of_whole(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return table([])
        bucket = left["bucket"][0].as_py()
        each, _ = values(left, right)
        return table(list(summed(bucket, left["units"][0].as_py(), left["blobs"][0].values, each)))

    def of_salts(left: pa.Table, right: pa.Table) -> pa.Table:
        each, at = [], []
        if left.num_rows:
            each, at = values(left, right)
        return pa.table({"bucket": left["bucket"], "salt": left["salt"], "each": pa.array([[x[own].tobytes() for x in each] for own in at], pa.list_(pa.binary()))})

    def run_split(batches):
        for b in batches:
            for i, bucket in enumerate(b["bucket"].to_pylist()):
                yield from table(list(summed(bucket, b["units"][i].as_py(), b["blobs"][i].values, [np.frombuffer(x.as_buffer(), np.float64) for x in b["each"][i].values]))).to_batches()

    sums = "unit long, kind int, blob binary"
    by = lambda df: df.groupBy("bucket")
    known = by(split.select("bucket", "salt", "keys")).cogroup(by(told)).applyInArrow(of_salts, "bucket int, salt long, each array<binary>")
    both = split.select("bucket", "salt", "units", "blobs").join(known, ["bucket", "salt"]).select("bucket", "units", "blobs", "each")
    return by(whole).cogroup(by(told)).applyInArrow(of_whole, sums).union(both.mapInArrow(run_split, sums))


def _totals(parts: pa.Table) -> pa.Table:
    """The documents of a unit with their totals."""
    kinds = parts["kind"].to_pylist()
    of = lambda kind: [x.as_buffer() for k, x in zip(kinds, parts["blob"]) if k == kind]
    docs = pa.ipc.open_stream(of(0)[0]).read_all()
    score, (base, known) = added(of(1), 1, docs.num_rows)[0], added(of(2), 2, docs.num_rows)
    n_known = np.rint(docs["n_known"].to_numpy() + known).astype(np.int64)
    return pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": docs["n_tokens"], "n_known": n_known, "base_score": docs["base_score"].to_numpy() + base, "score": score})


def scores(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of each row of docs."""
    sc = docs.sparkSession.sparkContext
    held = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))) % 10 == 0
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), held.alias("held"))
    v, unigrams = _vocabulary(own)
    pairs = min(MOST_BUCKETS, max(8, -(-v.total // BUCKET_TOKENS)))
    rares, salts = max(4, pairs // 2), max(1, -(-v.total // (pairs * BUCKET_TOKENS)))
    vocabulary = sc.broadcast(v)

    def gather(parts: pa.Table) -> pa.Table:
        if parts["bucket"][0].as_py() < pairs + rares:
            return _gather(parts)
        n = parts.num_rows
        empty = pa.array([b""] * n, pa.binary())
        return pa.table({"bucket": parts["bucket"], "salt": parts["salt"], "keys": empty, "units": pa.array([[x] for x in parts["unit"].to_pylist()], pa.list_(pa.int64())), "blobs": pa.array([[x] for x in parts["blob"].to_pylist()], pa.list_(pa.binary()))})

    dealt = _deal(own, vocabulary, pairs, rares, salts)
    state = stored(dealt.groupBy("bucket", "salt").applyInArrow(gather, _GATHERED), "restaurants")
    seats = state.where(F.col("bucket") < pairs + rares)
    salted = [r["bucket"] for r in seats.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").collect()]  # of pairs + rares buckets
    whole, split = seats.where(~F.col("bucket").isin(salted)), seats.where(F.col("bucket").isin(salted))
    known = unigrams.where("c > 1").select(F.col("w").bitwiseOR(F.lit(-(1 << 63))).alias("code"), "c")
    counts = stored(_asked(seats, pairs, salted).join(known, "code").select("bucket", "code", "c", F.lit(None).cast("binary").alias("blob")), "word-counts")
    tables = stored(_first_pass(seats, counts, vocabulary, pairs, pairs * salts), "tables")
    served = stored(tables.where("t is null").groupBy("id").applyInArrow(_served, "bucket int, blob binary"), "customers")
    customers, hot, sizes = np.zeros(v.rare), np.zeros(len(v.contexts)), [[np.zeros(0, np.int64)], [np.zeros(0)]]
    for r in served.where("bucket < 0").collect():  # a few distinct numbers of tables a shard, and at most 1 / FREQUENT words
        b = _unpack(r["blob"])
        if r["bucket"] == -2:
            customers[b["k"].astype(np.int64)] = b["n"]
        else:
            sizes[0].append(b["k"].astype(np.int64))
            sizes[1].append(b["n"])
    for r in tables.where("t is not null").groupBy("id").agg(F.sum("t").alias("t")).collect():  # at most 2 * pairs contexts
        hot[r["id"]] = r["t"]
    sizes = [np.concatenate(x) for x in sizes]
    size, which = np.unique(np.concatenate((np.rint(customers[customers > 0]).astype(np.int64), sizes[0])), return_inverse=True)
    held = np.bincount(which, np.concatenate((np.ones(int((customers > 0).sum())), sizes[1])), len(size))
    model = sc.broadcast((v, Root(size, held, v.distinct + 1), customers, hot))
    told = counts.union(served.where("bucket >= 0").select("bucket", F.lit(None).cast("long"), F.lit(None).cast("long"), "blob"))
    rows = state.where(F.col("bucket") >= pairs + rares).select(F.col("units")[0].alias("unit"), F.lit(0).alias("kind"), F.col("blobs")[0].alias("blob"))
    parts = rows.union(_second_pass(whole, split, told, model, pairs))
    total = parts.groupBy("unit").applyInArrow(_totals, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return total.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(v.total).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
