"""Merkle manifest of a dataset: a digest a row, a tree a group, a tree over the groups, and every row's proof.

Leaves are digests of the rows' fields, made by Spark's own functions; only digests travel further. They are numbered inside their group by a range
shuffle and the counts of its ranges, and dealt into aligned blocks of FANOUT ** depth leaves. A block is a contiguous numpy matrix of 64-byte digests, which is
reshaped by fanout and hashed row by row, level by level; its top is a node of the group's tree, since blocks are aligned. Tops are numbered already, so they
are dealt into blocks again until each group has one, then the tops of the groups, in order, likewise give the root. On the way down each block
learns the siblings above its top, and every row's proof is read out of the block's levels by index arithmetic.

No task holds more than a block and the siblings above it, however large a group is, and no table but that of digests grows with the rows. Groups may be as many as rows.

Defined results: a null field is told from an empty one; a null group is the first group; rows ascend by their order column, null first, then by leaf, so
rows that agree in both have equal leaves and any of their places; a lone leaf is its group's root, a lone group's root the
root, and their proofs lack those levels; an empty table has no rows; columns that are not named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

FANOUT, DEPTH = 16, 3
#: Hexadecimal characters of a digest.
WIDTH = 64


def field(value: Column) -> Column:
    """`-` for null, else the value's length in bytes, a colon and the value; numbers in decimal."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def height(size: int) -> int:
    """Levels above `size` nodes until one remains."""
    n = 0
    while size > 1:
        size, n = -(-size // FANOUT), n + 1
    return n


def above(nodes: np.ndarray) -> np.ndarray:
    """The next level of a level's matrix, WIDTH bytes a row: full runs are rows of one reshaped matrix, the last run may be shorter."""
    full = len(nodes) // FANOUT
    runs = list(nodes[: full * FANOUT].reshape(full, FANOUT * WIDTH))
    if len(nodes) % FANOUT:
        runs.append(nodes[full * FANOUT :].reshape(-1))
    return np.frombuffer("".join(sha256(r).hexdigest() for r in runs).encode(), np.uint8).reshape(-1, WIDTH)


def _block(t: pa.Table, depth: int) -> tuple[pa.Table, list[np.ndarray]]:
    """A block's rows in order, and its levels from the nodes up to its top or the group's."""
    t = t.take(pa.array(np.argsort(t.column("at").to_numpy(), kind="stable")))
    nodes = np.frombuffer("".join(t.column("node").to_pylist()).encode(), np.uint8).reshape(-1, WIDTH)
    levels = [nodes]
    for _ in range(min(depth, height(t.column("size")[0].as_py()))):
        levels.append(above(levels[-1]))
    return t, levels


def siblings(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each node of the lowest level: for each level below the top, the rows of its run in np.concatenate(levels), which of them
    are there and are not the node's own ancestor (both nodes x levels x FANOUT), and its ancestor's place in the run (nodes x levels)."""
    n, depth = len(levels[0]), len(levels) - 1
    own = np.arange(n)[:, None] // FANOUT ** np.arange(depth)
    first = own // FANOUT * FANOUT
    run = first[:, :, None] + np.arange(FANOUT)
    sizes = np.array([len(x) for x in levels[:depth]], np.int64)
    there = (run < sizes[None, :, None]) & (run != own[:, :, None])
    start = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if depth else sizes
    return run + start[None, :, None], there, own - first


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings of given lengths, one after another in data."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


_TOPS = "grp string, block long, node string, size long"
_PATHS = "grp string, at long, lefts array<string>, rights array<string>, peak string"


def _top(depth: int):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        _, levels = _block(t, depth)
        blocks = -(-t.column("size")[0].as_py() // FANOUT**depth)
        return pa.table({"grp": pa.array([key[0].as_py()]), "block": pa.array([key[1].as_py()], pa.int64()), "node": pa.array([levels[-1].tobytes().decode()]), "size": pa.array([blocks], pa.int64())})

    return run


def _path(depth: int):
    """The siblings of each node of a block up to its group's root, left and right of the way, a string a level."""

    def run(key: tuple, nodes: pa.Table, upper: pa.Table) -> pa.Table:
        t, levels = _block(nodes, depth)
        rows, there, place = siblings(levels)
        every, up, at = np.concatenate(levels), upper.slice(0, 1).to_pylist()[0], np.arange(FANOUT)
        side = lambda i, test: [every[rows[i, k][there[i, k] & test(at, place[i, k])]].tobytes().decode() for k in range(rows.shape[1])]
        lefts = [side(i, np.less) + up["lefts"] for i in range(t.num_rows)]
        rights = [side(i, np.greater) + up["rights"] for i in range(t.num_rows)]
        lists = pa.list_(pa.string())
        return pa.table({"grp": t.column("grp"), "at": t.column("at"), "lefts": pa.array(lefts, lists), "rights": pa.array(rights, lists), "peak": pa.array([up["peak"]] * t.num_rows, pa.string())})

    return run


def _blocks(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("at") / FANOUT**depth).cast("long"))


def uppers(nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """grp, block, lefts, rights and peak: the siblings above each block's top, and the root of its group, of nodes(grp, at, size, node)."""
    tops = stored(_blocks(nodes.select("grp", "at", "size", "node"), depth).groupBy("grp", "block").applyInArrow(_top(depth), _TOPS), "tops")
    if tops.where("block > 0").isEmpty():
        none = F.array().cast("array<string>")
        return tops.select("grp", "block", none.alias("lefts"), none.alias("rights"), F.col("node").alias("peak"))
    return paths(tops.select("grp", F.col("block").alias("at"), "size", "node"), depth).withColumnRenamed("at", "block")


def paths(nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """grp, at, lefts, rights and peak of each of nodes(grp, at, size, node). A round for each `depth` levels."""
    key = ["grp", "block"]
    own = _blocks(nodes.select("grp", "at", "size", "node"), depth).groupBy(*key)
    return stored(own.cogroup(uppers(nodes, depth).groupBy(*key)).applyInArrow(_path(depth), _PATHS), "paths")


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """rows with `at`, their place in their grp in this order, from 0, and `size`, how many the grp has. Rows are dealt out by range over all groups and numbered in their range;
    the counts of the ranges, one row a range and group, give the offsets. What `order` leaves equal must be few."""
    n = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = stored(rows.repartitionByRange(n, F.col("grp"), *order).withColumn("_range", F.spark_partition_id()), "dealt")
    counts = dealt.groupBy(F.col("grp").alias("_grp"), F.col("_range").alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy("_grp")
    before = own.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_grp", "_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(own).alias("size"))
    inside = dealt.withColumn("_inside", F.row_number().over(Window.partitionBy("grp", "_range").orderBy(*order)) - 1)
    placed = inside.join(offsets, (F.col("grp") == F.col("_grp")) & (F.col("_range") == F.col("_at")))
    return placed.withColumn("at", (F.col("_before") + F.col("_inside")).cast("long")).drop("_grp", "_at", "_before", "_inside", "_range")


def manifest(docs: DataFrame, leaf: Column, group: str = "source", order: str = "doc_id", claim: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """The order column, leaf, at, size, subroot, root, proof and folded_root of each row of docs.

    proof has the digests of all siblings on the way to the root, level by level, left to right; at and size tell which are left of the way. folded_root is what `claim`, or
    the leaf where it is None, gives with these siblings: it equals root only if the claimed leaf is the leaf.
    """
    kind = docs.schema[order].dataType.simpleString()
    # a group's name sorts like the group, null first, and is never null
    rows = docs.select(F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("n")).alias("grp"), F.col(order).alias("key"), leaf.alias("node"), (leaf if claim is None else claim).alias("claim"))
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()), "leaves")
    placed = stored(_blocks(numbered(rows, F.col("key").asc_nulls_first(), F.col("node"), F.col("uid")), depth).drop("uid"), "placed")
    own = stored(uppers(placed, depth), "uppers")
    groups = numbered(own.where("block = 0").select(F.lit("all").alias("grp"), F.col("grp").alias("name"), F.col("peak").alias("node")), F.col("name"))
    groups = stored(groups, "groups")
    top = paths(groups, depth).select("at", F.col("lefts").alias("_lefts"), F.col("rights").alias("_rights"), F.col("peak").alias("root"))
    top = groups.select("at", F.col("name").alias("grp")).join(top, "at").drop("at")
    full = own.join(top, "grp").select("grp", "block", F.concat("lefts", "_lefts").alias("lefts"), F.concat("rights", "_rights").alias("rights"), F.col("peak").alias("subroot"), "root")

    def proved(key: tuple, nodes: pa.Table, upper: pa.Table) -> pa.Table:
        t, levels = _block(nodes, depth)
        n, up = t.num_rows, upper.slice(0, 1).to_pylist()[0]
        run, there, place = siblings(levels)
        # the siblings above the block are rows behind its levels, the same for each of its nodes
        beyond = "".join(a + b for a, b in zip(up["lefts"], up["rights"])).encode()
        every = np.concatenate([*levels, np.frombuffer(beyond, np.uint8).reshape(-1, WIDTH)])
        last = np.arange(len(every) - len(beyond) // WIDTH, len(every))
        rows = np.concatenate([run.reshape(n, -1), np.broadcast_to(last, (n, len(last)))], axis=1)
        mask = np.concatenate([there.reshape(n, -1), np.ones((n, len(last)), bool)], axis=1)
        data = every[rows[mask]].reshape(-1)
        lengths = mask.sum(axis=1) * WIDTH
        # bytes on the left of the way and of all siblings, a level
        counts = [(p * WIDTH, c * WIDTH) for p, c in zip(place.T, there.sum(axis=2).T)]
        higher = [(len(a), len(a) + len(b)) for a, b in zip(up["lefts"], up["rights"])]
        folded, start, buffer = [], 0, memoryview(np.ascontiguousarray(data))
        for i, node in enumerate(t.column("claim").to_pylist()):
            for left, both in [*((int(p[i]), int(c[i])) for p, c in counts), *higher]:
                h = sha256(buffer[start : start + left])
                h.update(node.encode())
                h.update(buffer[start + left : start + both])
                node, start = h.hexdigest(), start + both
            folded.append(node)
        same = lambda x: pa.array([x] * n, pa.string())
        return pa.Table.from_arrays(
            [t.column("key"), t.column("node"), t.column("at"), t.column("size"), same(up["subroot"]), same(up["root"]), _strings(data, lengths).cast(pa.string()), pa.array(folded, pa.string())],
            names=["key", "leaf", "at", "size", "subroot", "root", "proof", "folded_root"],
        )

    ends = ["grp", "block"]
    schema = f"key {kind}, leaf string, at long, size long, subroot string, root string, proof string, folded_root string"
    return placed.groupBy(*ends).cogroup(full.groupBy(*ends)).applyInArrow(proved, schema).withColumnRenamed("key", order)
