"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its five-word shingles; the weight is the shingle's count in the
text times idf = ln((1 + S) / (q + S)), where q is the share of all documents that hold the
shingle, counted exactly for every shingle, and 0 for one of a single document. For that, units of documents deal their
shingles to shards by ranges of the hash; a shard sends each unit the counts of its own, and a unit, its texts with it, weighs
and samples them. No counts are collected or broadcast. S keeps the weights of shingles
that many near copies share from vanishing, so a large group of copies stays together, while a
passage that all documents hold weighs nothing. Each sample (ICWS, Ioffe 2010) is the pair
(shingle, quantised weight) of least `ln a`; its three random variates come from tables of
2**16 entries indexed by a hash of the shingle, and a tie inside a table cell goes to the
least shingle hash. Samples are banded. The members of a band are compared by exact weighted
Jaccard similarity with its leader, the member that shares most bands with others, so the pairs
are as many as the members; links of at least THRESHOLD are closed to classes.

A band that then still holds two classes is dealt anew by differences from a centre C, the consensus of some of its
members (the median weight of each shingle), which leaves each member its own edits alone. With d the sum of absolute differences of
weights, similarity of at least THRESHOLD is d(x, y) <= g, where g is (1 - THRESHOLD) / (1 + THRESHOLD) of the weight of both. Let L be the
member nearest to C: all members of other classes are compared with L. If x and L are not linked, then d(x, C) + d(L, C) > g, and as
d(y, C) >= d(L, C) for any y, x can be linked to y only if they share a difference: a shingle of which both have more than C, or
both less. So new bands are (C, difference), for the DELTAS differences of either kind of least hash of each member; all links are in
them where texts have no more differences than that. Members that can have no partner in a new band of less go: if nothing that C lacks is shared, those with R(y) - A(y) < R(x) + A(x) - g (A: the weight that C lacks, R: the
weight that the text lacks). Keys that one class alone holds make no band. A sketch of fixed size,
the bounds of each cell of keys, drops most of these and of those members before they are dealt, and the bounds of each key the rest. The new bands are treated in the same way; one of FEW members at most is compared whole and
ends there. All members of a band lie on one side of C in its difference, so the next consensus is closer to them there: the rounds end,
with pairs and rows linear in the members.

Defined results: a null text counts as the empty text; equal texts are always one class; texts
without words join no other class; a text of one to four words is one shingle; a class is named by
its least doc_id (null only if it has no other); repeated rows share their class, and `keep` returns one of them. Extra columns
of any name are carried by `keep` and ignored by `classes`.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shingles as sh
from .pitman_yor import to_ipc
from .tables import stored

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 5
#: Differences of a kind by which a member is dealt anew: of texts with more, links that share an eighth of the longer one's are missed by one centre in 1.4 %.
DELTAS = 32
#: What sets two linked texts apart at most, as a share of the weight of both.
APART = (1 - THRESHOLD) / (1 + THRESHOLD)
#: Members of different classes in a band of up to so many are compared with each other; larger ones have a leader.
FEW = 32
#: About so many members, by a hash of the text, make a consensus; it is a mere point of reference, and all members are compared with it.
VOTERS = 32
S = 0.5
#: The share below which a shingle's q is taken as 0: none is, but that of one document alone.
RARE = 0.0
#: Shingles of a unit of documents and rows of it, at most one group of texts more; and shingles of a shard.
UNIT_SHINGLES, UNIT_DOCS, SHARD_SHINGLES = 600_000, 60_000, 1_500_000
#: Cells of the sketch of keys: a fixed size, whatever the corpus.
CELLS, BLOCKS = 1 << 20, 64


class Weights:
    """The idf of shingles by the shares of documents that hold them; shingles that are not named have share 0."""

    def __init__(self, hashes: np.ndarray, shares: np.ndarray):
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.idf = np.log((1 + S) / (shares[order] + S)).astype(np.float32)
        self.common = np.float32(np.log((1 + S) / S))

    def __call__(self, hashes: np.ndarray, tf: np.ndarray) -> np.ndarray:
        w = np.full(len(hashes), self.common, np.float32)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes
            w[hit] = self.idf[at[hit]]
        return w * tf.astype(np.float32)


def _sets(texts: pa.Array):
    """(first, last, shingle hashes, text numbers, counts) of groups of texts, each shingle once a text, in text order."""
    for first, last, data, offs in sh.groups(texts):
        start, end, doc = sh.word_spans(data, offs)
        h, d = sh.shingle_hashes(sh.word_hashes(data, start, end), doc, last - first, SHINGLE)
        key = h ^ (d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        new = np.ones(len(key), bool)
        new[1:] = key[order][1:] != key[order][:-1]
        at = np.flatnonzero(new)
        tf = np.diff(np.append(at, len(key)))
        pick = order[at]
        back = np.argsort(pick)
        pick, tf = pick[back], tf[back]
        yield first, last, h[pick], d[pick], tf


def _planes(a: np.ndarray) -> bytes:
    """An array's bytes by plane, compressed."""
    return pa.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes(), codec="zstd", asbytes=True)


def _flat(blob, n: int, kind) -> np.ndarray:
    """The n numbers of _planes."""
    size = np.dtype(kind).itemsize
    raw = pa.decompress(blob, decompressed_size=n * size, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).ravel()


def _deal(texts: DataFrame, shards: int) -> DataFrame:
    """The distinct shingles of each unit of texts(node, text, doc_id) by shard, ascending, with the documents that hold them; below 0, the texts themselves."""

    def run(batches):
        from pyspark import TaskContext

        np.seterr(over="ignore")
        unit, held, rows = TaskContext.get().partitionId() << 32, [], []

        def flush():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32), np.arange(shards + 1, dtype=np.uint64))
            whole = to_ipc(pa.concat_tables(rows))
            spread = int(sh.mix(np.array([unit], np.uint64))[0]) % shards
            out = [(-1 - spread, unit, len(whole), pa.compress(whole, codec="zstd", asbytes=True), b"")]
            for j in np.flatnonzero(np.diff(cuts)).tolist():
                own = slice(cuts[j], cuts[j + 1])
                out.append((j, unit, int(cuts[j + 1] - cuts[j]), _planes(np.diff(h[own], prepend=np.uint64(0))), _planes(c[own].astype(np.uint32))))
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["shard", "unit", "n", "blob", "docs"])

        for b in batches:
            table = pa.Table.from_batches([b])
            for first, last, h, _, _ in _sets(b.column("text")):
                held.append(h)
                rows.append(table.slice(first, last - first))
                if sum(map(len, held)) >= UNIT_SHINGLES or sum(r.num_rows for r in rows) >= UNIT_DOCS:
                    yield flush()
                    unit, held, rows = unit + 1, [], []
        if rows:
            yield flush()

    return texts.select("node", "text", "doc_id").mapInArrow(run, "shard int, unit long, n long, blob binary, docs binary")


def _counted(parts: pa.Table) -> pa.Table:
    """For each unit, how many documents of all hold each of its shingles of the shard; texts pass as they are."""
    out = parts.select(["unit", "shard", "n", "blob"])
    if parts["shard"][0].as_py() < 0:
        return out
    n = parts["n"].to_pylist()
    h = np.concatenate([np.cumsum(_flat(x.as_buffer(), m, np.uint64), dtype=np.uint64) for x, m in zip(parts["blob"], n)])
    c = np.concatenate([_flat(x.as_buffer(), m, np.uint32) for x, m in zip(parts["docs"], n)])
    _, at = np.unique(h, return_inverse=True)
    total = np.bincount(at, c)[at].astype(np.uint32)
    blobs = [_planes(x) for x in np.split(total, np.cumsum(n)[:-1])]
    return out.set_column(3, "blob", pa.array(blobs, pa.binary()))


def sampled(texts: DataFrame) -> DataFrame:
    """node, doc_id, band keys, and the weights of the shingles in text order (by `_planes`), of each row of texts(node, text, doc_id)."""
    n, size = texts.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    shards = max(16, -(-(size or 0) // (5 * SHARD_SHINGLES)))  # words of five bytes or so
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(parts: pa.Table) -> pa.Table:
        np.seterr(over="ignore")
        parts = parts.sort_by("shard")
        whole = pa.decompress(parts["blob"][0].as_buffer(), decompressed_size=parts["n"][0].as_py(), codec="zstd")
        docs = pa.ipc.open_stream(whole).read_all().combine_chunks()
        sets = list(_sets(docs["text"]))
        docs_of = [_flat(x.as_buffer(), m, np.uint32) for x, m in zip(parts["blob"][1:], parts["n"][1:].to_pylist())]
        held = np.concatenate([np.zeros(0, np.uint32), *docs_of])
        distinct, at = np.unique(np.concatenate([h for _, _, h, _, _ in sets]), return_inverse=True)
        h, d, tf = (np.concatenate(x) for x in zip(*((h, d + first, tf) for first, _, h, d, tf in sets)))
        w = Weights(distinct, np.where(held > 1, held / n, 0.0)).idf[at] * tf.astype(np.float32)
        del sets, docs_of, distinct, at, tf
        packed = [_planes(x) for x in np.split(w, np.searchsorted(d, np.arange(1, docs.num_rows)))]
        solid, keys = np.zeros(docs.num_rows, bool), np.zeros((docs.num_rows, BANDS), np.uint64)
        own, k = _sampler()(h, d, w)
        solid[own], keys[own] = True, k
        ends = np.concatenate(([0], np.cumsum(np.where(solid, BANDS, 0)))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[solid].ravel().view(np.int64)))
        return pa.table([docs["node"], docs["doc_id"], lists, pa.array(packed, pa.binary())], names=["node", "doc_id", "keys", "w"])

    told = _deal(texts, shards).groupBy("shard").applyInArrow(_counted, "unit long, shard int, n long, blob binary")
    return told.groupBy("unit").applyInArrow(run, f"node long, doc_id {kind}, keys array<long>, w binary")


@functools.cache
def _sampler() -> Sampler:
    """Made once a worker, which drops it in the steps after (see _blobs)."""
    return Sampler(Weights(np.zeros(0, np.uint64), np.zeros(0)))


class Rows:
    """The rows of a table, each made when it is asked for, once for a unit of documents: all of them would be twice as large as the variates."""

    def __init__(self, row):
        self._row = row

    def __getitem__(self, k: int) -> np.ndarray:
        return self._row(k)


class Sampler:
    """BANDS * ROWS consistent weighted samples, combined to one 64-bit key for each band."""

    def __init__(self, weights: Weights):
        rng = np.random.Generator(np.random.PCG64(7))
        self.weights = weights
        k, self.cells = BANDS * ROWS, 1 << 16

        def drawn(one):
            out = np.empty((k, self.cells), np.float32)
            for row in out:
                row[:] = one()
            return out

        self.r = drawn(lambda: rng.gamma(2.0, 1.0, self.cells))
        self.lnc = drawn(lambda: np.log(rng.gamma(2.0, 1.0, self.cells)))
        self.beta = drawn(lambda: rng.random(self.cells))
        self.odd = rng.integers(0, 1 << 62, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        lnw = np.log(weights.common)
        self.table = Rows(lambda j: self._pack(j, slice(None), lnw))
        #: The least logarithm of a weight that, up to the common one, is sampled like that.
        self.low = Rows(lambda j: self.r[j] * (np.floor(lnw / self.r[j] + self.beta[j]) - self.beta[j]))

    def _pack(self, k: int, cell: np.ndarray, lnw) -> np.ndarray:
        """ln a as sortable upper 32 bits, the scrambled quantised weight in the lower."""
        r, beta = self.r[k][cell], self.beta[k][cell]
        t = np.floor(lnw / r + beta)
        bits = (self.lnc[k][cell] - r * (t - beta + np.float32(1))).astype(np.float32).view(np.uint32)
        bits = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
        return (bits << np.uint64(32)) | (sh.mix(t.astype(np.int64).view(np.uint64)) >> np.uint64(32))

    def __call__(self, h: np.ndarray, doc: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text numbers that have shingles, band keys)."""
        solid = w > 0
        if not solid.all():
            h, doc, w = h[solid], doc[solid], w[solid]
        docs, at = np.unique(doc, return_index=True)
        if not len(docs):
            return docs, np.zeros((0, BANDS), np.uint64)
        odd, lnw, more = (w != self.weights.common).any(), np.log(w), w > self.weights.common
        low = sh.mix(h) & np.uint64(0xFFFFFFFF)
        keys = np.zeros((len(docs), BANDS), np.uint64)
        for k in range(BANDS * ROWS):
            cell = ((h * self.odd[k]) >> np.uint64(48)).astype(np.int64)
            v = self.table[k][cell]
            if odd:
                other = np.flatnonzero((lnw < self.low[k][cell]) | more)
                v[other] = self._pack(k, cell[other], lnw[other])
            v ^= low
            b = k // ROWS
            keys[:, b] = sh.mix(keys[:, b] + np.minimum.reduceat(v, at) + np.uint64(b + 1))
        return docs, keys


def _blobs(texts: DataFrame) -> DataFrame:
    """(node, hashes, w): the sorted 32-bit shingle hashes and their weights, of texts(node, text, w) with the weights of `sampled`."""

    def run(batches):
        np.seterr(over="ignore")
        _sampler.cache_clear()  # its tables would stay in the worker for the rounds to come
        for b in batches:
            node, packed, out = b.column(0).to_pylist(), b.column(2), []
            for first, last, h, d, _ in _sets(b.column(1)):
                bounds = np.searchsorted(d, np.arange(last - first + 1))
                for j in range(last - first):
                    h32 = (h[bounds[j] : bounds[j + 1]] >> np.uint64(32)).astype(np.uint32)
                    order = np.argsort(h32, kind="stable")
                    out.append((node[first + j], h32[order].tobytes(), _planes(_flat(packed[first + j].as_buffer(), len(h32), np.float32)[order])))
            cols = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["node", "hashes", "w"])

    return texts.mapInArrow(run, "node long, hashes binary, w binary")


def weighted_jaccard(ha: np.ndarray, wa: np.ndarray, hb: np.ndarray, wb: np.ndarray) -> float:
    """Of two weighted sets given by sorted hashes; 0 for two empty ones."""
    at = np.searchsorted(hb, ha)
    at[at == len(hb)] = 0
    both = hb[at] == ha if len(hb) else np.zeros(len(ha), bool)
    least = float(np.minimum(wa[both], wb[at[both]]).sum(dtype=np.float64)) if both.any() else 0.0
    rest = float(wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64)) - least
    return least / rest if rest > 0 else 0.0


def _loaded(hashes, w) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and weights of a row of _blobs."""
    h = np.frombuffer(hashes.as_buffer(), np.uint32)
    return h, _flat(w.as_buffer(), len(h), np.float32)


def _verified(pairs: DataFrame, blobs: DataFrame) -> DataFrame:
    """The pairs(node, lead) whose similarity is at least THRESHOLD."""

    def run(batches):
        _sampler.cache_clear()
        for b in batches:
            cols = b.columns
            ok = [weighted_jaccard(*_loaded(*(c[i] for c in cols[2:4])), *_loaded(*(c[i] for c in cols[4:6]))) >= THRESHOLD for i in range(b.num_rows)]
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    mine = pairs.join(blobs, "node")
    theirs = blobs.select(F.col("node").alias("lead"), *(F.col(c).alias(f"{c}_l") for c in ("hashes", "w")))
    both = mine.join(theirs, "lead").select("node", "lead", "hashes", "w", "hashes_l", "w_l")
    return both.mapInArrow(run, "node long, lead long")


def consensus(sets: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and the lower median of their weights in the sets (0 where a set lacks them), where it is not 0."""
    h, w = (np.concatenate([x[k] for x in sets]) for k in (0, 1))
    order = np.lexsort((w, h))
    values, first, held = np.unique(h[order], return_index=True, return_counts=True)
    at = (len(sets) - 1) // 2 - (len(sets) - held)
    return values[at >= 0], w[order][(first + at)[at >= 0]]


def _differences(rows: DataFrame, blobs: DataFrame) -> DataFrame:
    """rows(key, node) with a text's apart = d(x, C), reach = R + A and surplus = R - A from its band's consensus C, its size, and keys, those of the bands that differences deal it to, odd for those of less."""

    def vote(voters: pa.Table) -> pa.Table:
        h, w = consensus([_loaded(*(voters[c][i] for c in ("hashes", "w"))) for i in range(voters.num_rows)])
        return pa.table({"key": voters["key"][:1], "ch": pa.array([h.tobytes()], pa.binary()), "cw": pa.array([w.tobytes()], pa.binary())})

    def least(values):
        values = sh.mix(values + np.uint64(1))
        return np.partition(values, DELTAS)[:DELTAS] if len(values) > DELTAS else values

    def run(batches):
        np.seterr(over="ignore")
        one = np.uint64(1)
        for b in batches:
            keys, counts, new = b.column(0).to_numpy().view(np.uint64), [], []
            for i in range(b.num_rows):
                h, w = _loaded(*(b.column(c)[i] for c in (2, 3)))
                ch, cw = (np.frombuffer(b.column(c)[i].as_buffer(), t) for c, t in ((4, np.uint32), (5, np.float32)))
                at = np.searchsorted(ch, h)
                at[at == len(ch)] = 0
                both = ch[at] == h if len(ch) else np.zeros(len(h), bool)
                own = np.zeros(len(ch), np.float32)
                own[at[both]] = w[both]
                short = (cw - own).astype(np.float64)
                more = ~both
                more[both] = short[at[both]] < 0
                lacks, rest = float(w[~both].sum(dtype=np.float64)), float(short.sum())
                counts.append((lacks + float(np.abs(short).sum()), rest + lacks, rest - lacks, float(w.sum(dtype=np.float64))))
                new.append(np.concatenate((sh.mix(keys[i] + least(h[more])) & ~one, sh.mix(keys[i] + least(ch[short > 0])) | one)).view(np.int64))
            cols = [pa.array(c, pa.float64()) for c in zip(*counts)] if counts else [pa.array([], pa.float64())] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols, pa.array(new, pa.list_(pa.int64()))], names=["key", "node", "apart", "reach", "surplus", "size", "keys"])

    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("one"))
    thin = F.pmod(F.xxhash64("node", F.lit(5)), F.greatest(F.lit(1), (F.col("n") / VOTERS).cast("long"))) == 0
    voters = rows.join(sizes, "key").where(thin | (F.col("node") == F.col("one"))).select("key", "node")
    centres = stored(voters.join(blobs, "node").select("key", "hashes", "w").groupBy("key").applyInArrow(vote, "key long, ch binary, cw binary"), "centres")
    both = rows.join(blobs, "node").join(centres, "key").select("key", "node", "hashes", "w", "ch", "cw")
    return both.mapInArrow(run, "key long, node long, apart double, reach double, surplus double, size double, keys array<long>")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) of the nodes of edges(a, b): label is the least node reached. Labels spread and jump until none changes."""
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), name)
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), name)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b").groupBy(F.col("a").alias("node")).agg(F.min("lb").alias("lb"))
        spread = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "lb").alias("label"))
        jump = spread.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = stored(spread.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("next", "label")).alias("label")), name)
        if new.where("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels(node, label) after links(node, lead); every node of links has a label."""
    of = lambda c, name: labels.select(F.col("node").alias(c), F.col("label").alias(name))
    links = stored(links, "links")
    if links.isEmpty():
        return labels
    edges = links.join(of("node", "a"), "node").join(of("lead", "b"), "lead").where("a <> b").select("a", "b").distinct()
    new = components(edges).select(F.col("node").alias("label"), F.col("label").alias("to"))
    return stored(labels.join(new, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")


def classes_of_texts(texts: DataFrame, copies: DataFrame) -> DataFrame:
    """(node, label) of the texts with a verified link, and others, of texts(node, text, doc_id); copies(node, doc_id) names one row of each."""
    drawn = stored(sampled(texts), "sampled")
    keys = stored(drawn.select("node", F.explode("keys").alias("key")).distinct(), "bands")
    crowded = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(keys.join(crowded, "key"), "members")
    # what many near copies were made from shares the most bands with them, so it leads its bands
    fame = stored(members.groupBy("node").agg(F.sum("n").alias("fame")), "fame")
    involved = fame.select("node").join(copies, "node").join(drawn.select("node", "w").dropDuplicates(["node"]), "node")
    found = texts.join(involved.select(F.col("node").alias("n2"), F.col("doc_id").alias("d2"), "w").hint("shuffle_hash"), (F.col("node") == F.col("n2")) & F.col("doc_id").eqNullSafe(F.col("d2")))
    blobs = stored(_blobs(found.select("node", "text", "w")).dropDuplicates(["node"]), "blobs")
    led = stored(_led(members.select("key", "node").join(fame, "node"), F.struct(-F.col("fame"), "node")).where("node <> lead").select("node", "lead").distinct(), "led")
    labels = _relabelled(fame.select("node", F.col("node").alias("label")), _verified(led, blobs))
    # bands of one leader are dealt anew as one
    rows = stored(_open(led.select(F.col("lead").alias("key"), "node").union(led.select(F.col("lead").alias("key"), F.col("lead").alias("node")).distinct()).join(labels, "node")).where("n > 2"), "open")
    while not rows.isEmpty():
        told = stored(_differences(rows.where(F.col("n") > FEW).select("key", "node"), blobs), "differences")
        led = _led(told.select("key", "node", "apart").join(labels, "node"), F.struct("apart", "node", "label"))
        pairs = led.where("label <> top.label").select("node", "lead").union(_met(rows.where(F.col("n") <= FEW))).distinct()
        labels = _relabelled(labels, _verified(pairs, blobs))
        # a large band is dealt out by all tasks
        placed = stored(told.repartition(F.col("node")).join(labels, "node").select("keys", "node", "label", "apart", "reach", "surplus", "size"), "placed")
        rows = stored(_open(_able(stored(_dealt(placed, mixed_cells(placed)), "dealt"))), "open")
    return labels


def _cell(keys: np.ndarray) -> np.ndarray:
    """A key's cell; those of more and of less share none."""
    return ((keys >> np.uint64(45)) << np.uint64(1) | keys & np.uint64(1)).astype(np.int64)


def _none(cells: int) -> tuple[np.ndarray, np.ndarray]:
    """For each cell, the minima so far of (label, ~label) and of (reach, -surplus, -size)."""
    return np.full((2, cells), np.iinfo(np.int64).max), np.full((3, cells), np.inf)


def _by_cell(batches):
    """The minima of the cells that the keys of a task fall into, packed a block."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId() % BLOCKS
    labels, bounds = _none(CELLS)
    for b in batches:
        keys = b.column(0)
        cell = _cell(keys.flatten().to_numpy().view(np.uint64))
        label, reach, surplus, size = (np.repeat(c.to_numpy(), keys.value_lengths().to_numpy()) for c in b.columns[1:])
        for least, value in zip([*labels, *bounds], [label, ~label, reach, -surplus, -size]):
            np.minimum.at(least, cell, value)
    for block, (x, y) in enumerate(zip(np.split(labels, BLOCKS, 1), np.split(bounds, BLOCKS, 1))):
        at = np.flatnonzero(np.isfinite(y[0]))
        if len(at):
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "part": pa.array([part], pa.int32()), "at": [at.astype(np.int32).tobytes()], "labels": [x[:, at].tobytes()], "bounds": [y[:, at].tobytes()]})


def _merged(parts: pa.Table, mixed: bool) -> pa.Table:
    """A block's minima over some tasks, of all cells or of those with two labels."""
    labels, bounds = _none(CELLS // BLOCKS)
    for at, x, y in zip(parts["at"], parts["labels"], parts["bounds"]):
        at = np.frombuffer(at.as_buffer(), np.int32)
        labels[:, at] = np.minimum(labels[:, at], np.frombuffer(x.as_buffer(), np.int64).reshape(2, -1))
        bounds[:, at] = np.minimum(bounds[:, at], np.frombuffer(y.as_buffer(), np.float64).reshape(3, -1))
    at = np.flatnonzero(np.isfinite(bounds[0]) & ((labels[0] != ~labels[1]) | (not mixed)))
    packed = {"at": at.astype(np.int32), "labels": labels[:, at], "bounds": bounds[:, at]}
    return pa.table({"block": parts["block"][:1], **{c: pa.array([x.tobytes()], pa.binary()) for c, x in packed.items()}})


def mixed_cells(placed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The cells in which the keys of placed(keys, label, reach, surplus, size, ...) have two labels or more, and the minima there
    of reach, -surplus and -size. A key of two labels is in such a cell; others may be too, the more of them the more keys
    there are, for the number of cells is fixed, and with it what the driver holds (at most CELLS minima of each kind)."""
    packed = "at binary, labels binary, bounds binary"
    parts = placed.select("keys", "label", "reach", "surplus", "size").mapInArrow(_by_cell, f"block int, part int, {packed}")
    parts = parts.groupBy("block", "part").applyInArrow(lambda t: _merged(t, False), f"block int, {packed}")
    rows = parts.groupBy("block").applyInArrow(lambda t: _merged(t, True), f"block int, {packed}").select("block", "at", "bounds").collect()
    at = [np.frombuffer(r["at"], np.int32).astype(np.int64) + r["block"] * (CELLS // BLOCKS) for r in rows]
    bounds = [np.frombuffer(r["bounds"], np.float64).reshape(3, -1) for r in rows]
    return np.concatenate([np.zeros(0, np.int64), *at]), np.concatenate([np.zeros((3, 0)), *bounds], 1)


def _dealt(placed: DataFrame, mixed: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """A row of placed for each of its keys in mixed cells, but for those that `_able` drops by the bounds of the cell, which are no tighter than the key's."""
    shared = placed.sparkSession.sparkContext.broadcast(mixed)

    def run(batches):
        at, bounds = shared.value
        slot = np.full(CELLS, -1)
        slot[at] = np.arange(len(at))
        for b in batches:
            keys = b.column(0)
            flat = keys.flatten().to_numpy()
            to, row = slot[_cell(flat.view(np.uint64))], np.repeat(np.arange(b.num_rows), keys.value_lengths().to_numpy())
            flat, row, to = flat[to >= 0], row[to >= 0], to[to >= 0]
            reach, surplus, size = (c.to_numpy()[row] for c in b.columns[4:])
            low, rest, most = bounds[0][to], -bounds[1][to], -bounds[2][to]
            g = (size + most) * APART + 0.01
            able = (flat & 1 == 0) | ((rest >= reach - g) & (surplus >= low - 2 * APART * most - 0.01))
            row = pa.array(row[able])
            yield pa.RecordBatch.from_arrays([pa.array(flat[able]), *(c.take(row) for c in b.columns[1:])], names=["key", *b.schema.names[1:]])

    return placed.mapInArrow(run, "key long, node long, label long, apart double, reach double, surplus double, size double")


def _met(rows: DataFrame) -> DataFrame:
    """The pairs (node, lead) of different labels in keys of FEW rows at most."""
    band = rows.groupBy("key").agg(F.collect_list(F.struct("node", "label")).alias("m"))
    later = lambda x: F.transform(F.filter("m", lambda y: (y["node"] > x["node"]) & (y["label"] != x["label"])), lambda y: F.struct(y["node"].alias("node"), x["node"].alias("lead")))
    return band.select(F.explode(F.flatten(F.transform("m", later))).alias("p")).select("p.node", "p.lead")


def _open(rows: DataFrame) -> DataFrame:
    """The rows(key, node, label) of keys with two labels or more, with n, the members."""
    many = rows.groupBy("key").agg((F.min("label") != F.max("label")).alias("mixed"), F.count(F.lit(1)).alias("n")).where("mixed").select("key", "n")
    return rows.join(many, "key").select("key", "node", "label", "n")


def _able(rows: DataFrame) -> DataFrame:
    """rows(key, node, label, apart, reach, surplus, size) without those that no other of the key can be linked to by what they share there."""
    most = rows.groupBy("key").agg((F.min("label") != F.max("label")).alias("mixed"), *(f(c).alias(n) for f, c, n in ((F.max, "size", "long"), (F.min, "reach", "low"), (F.max, "surplus", "rest")))).where("mixed").drop("mixed")
    g = (F.col("size") + F.col("long")) * APART + 0.01  # sums are rounded
    able = (F.col("key").bitwiseAND(1) == 0) | ((F.col("rest") >= F.col("reach") - g) & (F.col("surplus") >= F.col("low") - 2 * APART * F.col("long") - 0.01))
    return rows.join(most, "key").where(able).select("key", "node", "label")


def _led(rows: DataFrame, by: Column) -> DataFrame:
    """rows(key, node, ...) with top, the least of `by` in the band, and lead, its node."""
    first = rows.groupBy("key").agg(F.min(by).alias("top"))
    return rows.join(first, "key").withColumn("lead", F.col("top.node"))


def _noded(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, text, md5 and node, a hash of the text that no two different texts share."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.md5(body).alias("md5"), F.xxhash64(body).alias("node"))


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, md5 of the text and class_id of each row of docs."""
    texts = _noded(docs, text, doc_id)
    copies = stored(texts.groupBy("node", "md5").agg(F.min("doc_id").alias("doc_id")), "copies")
    twins = copies.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("node").alias("twin"))
    if not twins.isEmpty():  # two texts of one 64-bit hash
        told = lambda df: df.join(twins, df["node"] == twins["twin"], "left").withColumn("node", F.when(F.col("twin").isNull(), F.col("node")).otherwise(F.xxhash64("md5"))).drop("twin")
        texts, copies = told(texts), stored(told(copies), "copies")
    labels = classes_of_texts(texts.drop("md5"), copies.drop("md5"))
    named = copies.join(labels, "node", "left").select("md5", "doc_id", F.coalesce("label", "node").alias("label"))
    names = named.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    by_text = named.join(names, "label").select("md5", "class_id")
    return texts.select("doc_id", "md5").join(by_text, "md5").select("doc_id", "md5", "class_id")


def keep(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of docs for each class: that of the class's least doc_id."""
    found = stored(classes(docs, text, doc_id), "classes")
    rows = found.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class_id", "md5").agg(F.count(F.lit(1)).alias("n"))
    first = stored(rows.groupBy("class_id").agg(F.min_by("n", "md5").alias("n"), F.min("md5").alias("md5")), "kept")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(doc_id).alias("_id"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("_md5"))

    def of(picked: DataFrame) -> DataFrame:
        own = picked.select("class_id", "md5")
        return held.join(own, held["_id"].eqNullSafe(own["class_id"]) & (held["_md5"] == own["md5"]), "left_semi")

    out = of(first.where("n = 1"))
    repeated = first.where("n > 1")
    if not repeated.isEmpty():
        out = out.union(of(repeated).dropDuplicates(["_id", "_md5"]))
    return out.select("_row.*")
