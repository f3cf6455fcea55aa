"""Approximate nearest neighbours by inner product over randomly rotated one-bit codes.

Every vector is taken relative to the mean of its length class, turned by a seeded random rotation into BITS times as many
coordinates (zeros are added first), and kept as the signs of these, packed, with three scalars: its distance from the mean, how well
the signs agree with the turned vector, and its share of the inner product with the mean. For a turned query these give an unbiased
estimate of the inner product and the width of its error, EPS standard deviations. A vector is reranked, by the exact inner product of the
original vectors in double precision, if the upper end of its estimate reaches the least score that may still count.

A query set meets all codes in cells of a grid: queries are dealt into blocks, codes into others, and a cell holds one block of each, of
BLOCK_BYTES of vectors at most, so no task and no group holds more however many there are. A cell returns the best k of each
query; of v blocks of codes, where v is large, the candidates of root(v) blocks' worth, a sample by hash, give each query a floor first, so that all cells
together return about 2 * k * root(v) rows a query, not k * v. The work is queries times codes by nature; a code costs a query BITS times dimension
multiplications of 32-bit floats.

Defined results: vectors that are null, empty or zero, or hold a null or non-finite component take no part; vectors of different length do not meet, each
length is searched apart; a query's own row is no candidate of its, but a repeated row is, and rows with one id are separate queries and candidates;
a row with a null id is a candidate with a null id, after all others at ties; fewer candidates than k give fewer rows; ties go to the smaller id. Columns
beyond the id and the vector are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

K = 20
#: Code bits a dimension, standard deviations of the estimate's error, and the seed of the rotations.
BITS, EPS, SEED = 4, 3.5, 7
#: Bytes of 32-bit vectors in a block of queries or codes: 65,536 vectors of 64 dimensions.
BLOCK_BYTES = 1 << 24
#: Codes that a block has at least, where the data is dealt into more blocks than BLOCK_BYTES asks for, so that all tasks have one.
LEAST_BLOCK = 4096
#: Blocks of codes from which on floors are found first.
FLOORS_FROM = 16
#: Bytes of the lengths' means that are broadcast; beyond them the join is left to the planner.
MOST_MEANS = 1 << 25
#: Codes and queries that are estimated at once.
TILE_CODES, TILE_QUERIES = 4096, 512
#: So many times k codes of a first tile are scored for a floor.
FIRST = 4


def code_bits(dim: int) -> int:
    return -(-BITS * dim // 64) * 64


@functools.lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """code_bits(dim) x dim with orthonormal columns: a random rotation of the vectors that zeros make longer."""
    rng = np.random.default_rng([SEED, dim])
    q, r = np.linalg.qr(rng.standard_normal((code_bits(dim), dim)))
    return np.ascontiguousarray((q * np.sign(np.diag(r))).astype(np.float32))


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """A list column without nulls whose lists have dim numbers each."""
    own = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return own.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def usable(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """vec_id, dim and vector of the rows that take part, each with a uid of its own."""
    v = F.col(vector)
    if vectors.schema[vector].dataType.simpleString() != "array<float>":
        v = v.cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    kept = vectors.where(v.isNotNull() & (F.size(v) > 0)).where(F.coalesce(fine, F.lit(False)))
    return kept.select(F.monotonically_increasing_id().alias("uid"), F.col(vec_id).alias("vec_id"), F.size(v).alias("dim"), v.alias("vector"))


def centres(rows: DataFrame) -> DataFrame:
    """dim and centre, the mean of its vectors: sums of a task's batches first, so a task sends one row a length and coordinate at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                m = _matrix(b.column("vector").filter(pa.array(dims == d)), d).astype(np.float64)
                n, s = sums.get(d, (0, np.zeros(d)))
                sums[d] = (n + len(m), s + m.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([n for n, _ in sums.values()], pa.int64()), pa.array([s.tolist() for _, s in sums.values()], pa.list_(pa.float64()))], names=["dim", "n", "sums"])

    part = rows.select("dim", "vector").mapInArrow(run, "dim int, n long, sums array<double>")
    spread = part.select("dim", "n", F.posexplode("sums").alias("at", "s")).groupBy("dim", "at").agg((F.sum("s") / F.sum("n")).cast("float").alias("mean"))
    return spread.groupBy("dim").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "mean"))), lambda x: x["mean"]).alias("centre"))


def encode(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, distance from the centre, agreement, share of the centre's inner product, and the turned vectors, of rows of one length."""
    own, c = vectors.astype(np.float64), centre.astype(np.float64)
    gap = own - c
    far = np.linalg.norm(gap, axis=1)
    turned = gap.astype(np.float32) @ rotation(vectors.shape[1]).T
    with np.errstate(invalid="ignore", divide="ignore"):
        agree = np.where(far > 0, np.abs(turned).sum(axis=1, dtype=np.float64) / (far * math.sqrt(turned.shape[1])), 1.0)
    return np.packbits(turned >= 0, axis=1), far, agree, own @ c - c @ c / 2, turned


def index(rows: DataFrame, is_query: Column | None = None) -> DataFrame:
    """The rows of `usable` with their codes: bits, far, agree and share, and turned, which is null where is_query is false. Written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, ask = b.column("dim").to_numpy(), b.column("query").to_numpy(zero_copy_only=False)
            for d in np.unique(dims).tolist():
                mine = pa.array(dims == d)
                part = b.filter(mine)
                n = part.num_rows
                bits, far, agree, share, turned = encode(_matrix(part.column("vector"), d), np.asarray(part.column("centre")[0].as_py(), np.float32))
                asked = ask[dims == d]
                sizes = np.where(asked, turned.shape[1], 0)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * bits.shape[1]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(bits))])
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(turned[asked].ravel(), pa.float32()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("uid", "vec_id", "dim", "vector", "query")), packed, pa.array(far), pa.array(agree), pa.array(share), lists], names=["uid", "vec_id", "dim", "vector", "query", "bits", "far", "agree", "share", "turned"])

    asked = F.lit(True) if is_query is None else F.coalesce(is_query, F.lit(False))
    known = stored(rows.withColumn("query", asked), "vectors")  # a uid is dealt once
    kind = {c: known.schema[c].dataType.simpleString() for c in known.columns}
    means = centres(known)
    if sum(4 * d for d in _counts(known)) <= MOST_MEANS:
        means = F.broadcast(means)
    full = known.join(means, "dim").select("uid", "vec_id", "dim", "vector", "query", "centre")
    return stored(full.mapInArrow(run, f"uid long, vec_id {kind['vec_id']}, dim int, vector {kind['vector']}, query boolean, bits binary, far double, agree double, share double, turned array<float>"), "codes")


FOUND = "query_uid long, query_id {0}, uid long, vec_id {0}, score double"


def _best(query: np.ndarray, score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's best k, by falling score and then rising order."""
    at = np.lexsort((order, -score, query))
    q = query[at]
    starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.empty(0, np.int64)
    place = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    return at[place < k]


def _below(score):
    """A little less, by more than 32-bit floats differ."""
    return score - 1e-6 * np.abs(score) - 1e-30


def scan(asked: dict[str, np.ndarray], codes: dict[str, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries and codes, and exact scores: the best k codes of each query that reach its floor. `order` ranks the codes' ids."""
    dim, bits = codes["vector"].shape[1], codes["bits"].shape[1] * 8
    width = np.sqrt(np.maximum(0, 1 - codes["agree"] ** 2)) / codes["agree"] * EPS / math.sqrt(bits - 1)
    exact_q, exact_v = asked["vector"].astype(np.float64), codes["vector"].astype(np.float64)
    q_far = np.linalg.norm(asked["turned"].astype(np.float64), axis=1)
    n = len(exact_q)
    # one product with four more coordinates gives the upper ends of the estimates: share of the code, share of the query and the slack of both
    left = np.concatenate([asked["turned"], np.stack([np.ones(n), asked["share"], np.abs(asked["share"]) * 2e-6, q_far], axis=1)], axis=1, dtype=np.float32)
    slack = np.stack([codes["share"] + 2e-6 * np.abs(codes["share"]), np.ones(len(exact_v)), np.ones(len(exact_v)), codes["far"] * (width + 1e-5)], axis=1)
    scale = codes["far"] / (codes["agree"] * math.sqrt(bits))
    exact = lambda v, q: np.einsum("ij,j->i", exact_v[v], exact_q[q])  # noqa: E731  equal vectors have equal scores, wherever they stand
    floor = _below(asked["floor"])
    held = [tuple(np.empty(0, t) for t in (np.int64, np.int64, np.float64)) for _ in range(0, n, TILE_QUERIES)]
    for b in range(0, len(exact_v), TILE_CODES):
        vs = slice(b, min(b + TILE_CODES, len(exact_v)))
        signs = (np.unpackbits(codes["bits"][vs], axis=1).astype(np.float32) * 2 - 1) * scale[vs, None].astype(np.float32)
        right = np.concatenate([signs, slack[vs]], axis=1, dtype=np.float32).T
        for tile, a in enumerate(range(0, n, TILE_QUERIES)):
            qs = slice(a, min(a + TILE_QUERIES, n))
            upper = left[qs] @ right
            if vs.stop - b > FIRST * k and np.isinf(floor[qs]).any():  # of the highest ends, the k-th exact score is a floor too, or the one after it, as a query may be among the codes
                top = np.argpartition(upper, -FIRST * k, axis=1)[:, -FIRST * k :]
                floor[qs] = np.maximum(floor[qs], _below(np.array([np.partition(exact(b + t, a + i), -k - 1)[-k - 1] for i, t in enumerate(top)])))
            qi, vi = np.divmod(np.flatnonzero(upper >= floor[qs, None].astype(np.float32)), vs.stop - b)
            cuts = np.searchsorted(qi, np.arange(qs.stop - a + 1))
            found = [held[tile]]
            for i in range(qs.stop - a):
                near = vi[cuts[i] : cuts[i + 1]] + b
                near = near[codes["uid"][near] != asked["uid"][a + i]]
                score = exact(near, a + i)
                if len(score) > k:  # what is below the k-th goes; ties with it stay
                    high = score >= _below(np.partition(score, len(score) - k)[len(score) - k])
                    near, score = near[high], score[high]
                found.append((np.full(len(near), a + i), near, score))
            all_q, all_v, score = (np.concatenate(x) for x in zip(*found))
            keep = _best(all_q, score, codes["order"][all_v], k)
            all_q, all_v, score = (x[keep] for x in (all_q, all_v, score))
            held[tile] = all_q, all_v, score
            count = np.bincount(all_q - a, minlength=qs.stop - a)
            last = np.cumsum(count) - 1  # rows of a query stand together, the best first
            if len(score):
                floor[qs] = np.where(count == k, np.maximum(floor[qs], _below(score[last.clip(0)])), floor[qs])
    q, v, score = (np.concatenate(x) for x in zip(*held))
    fine = score >= asked["floor"][q]
    return q[fine], v[fine], score[fine]


def _columns(t: pa.Table, dim: int, code: bool) -> dict[str, np.ndarray]:
    got = {"uid": t.column("uid").to_numpy(), "vector": _matrix(t.column("vector"), dim), "share": t.column("share").to_numpy()}
    if code:
        bits = t.column("bits").combine_chunks()
        bits = bits.chunk(0) if isinstance(bits, pa.ChunkedArray) else bits
        raw = np.frombuffer(bits.buffers()[2], np.uint8)
        start = bits.offset * (code_bits(dim) // 8)
        got |= {"bits": raw[start : start + len(bits) * code_bits(dim) // 8].reshape(len(bits), -1), "far": t.column("far").to_numpy(), "agree": t.column("agree").to_numpy()}
        place = pc.sort_indices(t.select(["vec_id", "uid"]), [("vec_id", "ascending"), ("uid", "ascending")], null_placement="at_end").to_numpy()
        got["order"] = np.empty(len(place), np.int64)
        got["order"][place] = np.arange(len(place))
    else:
        got |= {"turned": _matrix(t.column("turned"), code_bits(dim)), "floor": t.column("floor").to_numpy()}
    return got


def _blocks(n_asked: dict[int, int], n_codes: dict[int, int], spread: int) -> tuple[dict[int, int], dict[int, int]]:
    """Blocks of queries and of codes, by length."""
    rows = lambda d: max(1, BLOCK_BYTES // (4 * d))
    q = {d: max(1, -(-n // rows(d))) for d, n in n_asked.items()}
    return q, {d: max(1, -(-n_codes.get(d, 0) // rows(d)), min(-(-spread // q[d]), n_codes.get(d, 0) // LEAST_BLOCK)) for d in q}


def _cells(asked: DataFrame, codes: DataFrame, q_blocks: dict[int, int], v_blocks: dict[int, int], k: int, id_type: str) -> DataFrame:
    """The best k of each query in every block of codes, from its floor on."""
    of = lambda pairs: F.create_map(*[F.lit(x) for p in pairs.items() for x in p])[F.col("dim")]  # noqa: E731  one entry a length
    block = lambda n: F.pmod(F.xxhash64("uid"), of(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), of(n) - 1))
    left = asked.select("dim", block(q_blocks).alias("qb"), every(v_blocks).alias("vb"), "uid", "vec_id", "vector", "turned", "share", "floor")
    right = codes.where(F.col("dim").isin(*q_blocks)).select("dim", every(q_blocks).alias("qb"), block(v_blocks).alias("vb"), "uid", "vec_id", "vector", "bits", "far", "agree", "share")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # both sides come from one table: without names of its own the right one is read as the left
    key = ["dim", "qb", "vb"]
    schema = FOUND.format(id_type)

    def run(q: pa.Table, v: pa.Table) -> pa.Table:
        id_kind = (q if q.num_columns else v).schema.field("vec_id").type  # a side without rows may come without columns
        out = pa.schema([("query_uid", pa.int64()), ("query_id", id_kind), ("uid", pa.int64()), ("vec_id", id_kind), ("score", pa.float64())])
        if not q.num_rows or not v.num_rows:
            return out.empty_table()
        dim = q.column("dim")[0].as_py()
        qi, vi, score = scan(_columns(q, dim, False), _columns(v, dim, True), k)
        return pa.Table.from_arrays([q.column("uid").take(pa.array(qi)), q.column("vec_id").take(pa.array(qi)), v.column("uid").take(pa.array(vi)), v.column("vec_id").take(pa.array(vi)), pa.array(score)], schema=out)

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, schema)


def _counts(rows: DataFrame) -> dict[int, int]:
    """Rows of each length; one row a length passes through the driver."""
    return {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}


def _ranked(found: DataFrame, k: int) -> DataFrame:
    own = Window.partitionBy("query_uid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "uid")
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)


def search(coded: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank from 1, vec_id and score of the k nearest rows of `index` to each of its queries."""
    id_type = coded.schema["vec_id"].dataType.simpleString()
    asked = coded.where("query").withColumn("floor", F.lit(float("-inf")))
    n_asked, n_codes = _counts(asked), _counts(coded)
    if not n_asked:
        return coded.sparkSession.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")
    spread = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    q_blocks, v_blocks = _blocks(n_asked, n_codes, spread)
    share = {d: 1 / math.sqrt(v) for d, v in v_blocks.items() if v >= FLOORS_FROM}
    if share:
        part = F.create_map(*[F.lit(x) for d, s in share.items() for x in (d, int(s * (1 << 30)))])[F.col("dim")]
        drawn = coded.where(F.pmod(F.xxhash64("uid", F.lit("sample")), F.lit(1 << 30)) < part)
        fewer = {d: -(-v_blocks[d] // max(1, math.isqrt(v_blocks[d]))) for d in share}
        some = _ranked(_cells(asked.where(F.col("dim").isin(*share)), drawn, {d: q_blocks[d] for d in share}, fewer, k, id_type), k)
        floors = stored(some.groupBy(F.col("query_uid").alias("uid")).agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("_floor")), "floors")
        asked = asked.join(floors, "uid", "left").withColumn("floor", F.coalesce("_floor", "floor")).drop("_floor")
    found = _ranked(_cells(asked, coded, q_blocks, v_blocks, k, id_type), k)
    return found.select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = K, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """The k nearest other rows of each row of vectors for which is_query, a condition on vec_id, holds."""
    return search(index(usable(vectors, vector, vec_id), is_query), k)
