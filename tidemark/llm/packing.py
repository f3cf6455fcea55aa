"""Packing by optimal length buckets.

One pass counts documents by length cell (exact up to 64 words, then 64 cells an octave, so the
histogram is bounded whatever the lengths). Dynamic programming over it chooses at most BUCKETS
upper bounds so that padding every document to its bucket's bound wastes least. Inside a bucket,
documents in a seeded random order form batches of as many rows as the token budget holds at the
bucket's width, one at least.

Defined results: a token is a word; a null or blank text has length 0 and lies in the first
bucket; a document longer than the budget has a batch of its own; an empty table has no batches;
repeated rows are packed one by one; input columns that clash with added names are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import running_sum, shuffled_by
from .tables import stored, words

BUCKETS = 16
TOKEN_BUDGET = 32768
FINE = 64
SEED = "pack"


def cell(length: Column) -> Column:
    """The upper bound of a length's cell."""
    step = F.pow(F.lit(2.0), F.greatest(F.lit(0.0), F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double"))) - 6)).cast("long")
    return (F.ceil(length / step) * step).cast("long")


def bounds(histogram: list[tuple[int, int, int]], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of least total padding for cells (upper bound, documents, words), by dynamic programming."""
    cells = sorted(histogram)
    if not cells:
        return []
    top = np.array([max(c[0], 1) for c in cells], float)
    n = np.concatenate(([0.0], np.cumsum([c[1] for c in cells], dtype=float)))
    w = np.concatenate(([0.0], np.cumsum([c[2] for c in cells], dtype=float)))
    m = len(cells)
    best = top * n[1:] - w[1:]
    cuts = []
    for _ in range(min(buckets, m) - 1):
        # cost of cells i..j in one bucket, after the best split of the cells before i
        cost = best[None, :-1] + (top[1:, None] * (n[2:, None] - n[None, 1:-1]) - (w[2:, None] - w[None, 1:-1]))
        cost = np.where(np.tri(m - 1, dtype=bool), cost, np.inf)
        at = np.argmin(cost, axis=1)
        better = cost[np.arange(m - 1), at]
        cut = np.full(m, -1)
        gain = better < best[1:]
        cut[1:][gain] = at[gain]
        best = best.copy()
        best[1:][gain] = better[gain]
        cuts.append(cut)
    out, j = [], m - 1
    for cut in reversed(cuts):
        if cut[j] >= 0:
            out.append(int(top[j]))
            j = int(cut[j])
    out.append(int(top[j]))
    return sorted(set(out))


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """doc_id, n_tokens, bucket_length, batch (its number inside the bucket), slot and batch_id of each row."""
    sizes = stored(docs.select(F.col(doc_id).alias("doc_id"), F.size(words(F.col(text))).cast("long").alias("n_tokens")).withColumn("_cell", cell(F.col("n_tokens"))), "lengths")
    cells = sizes.groupBy("_cell").agg(F.count(F.lit(1)), F.sum("n_tokens")).collect()
    tops = bounds([tuple(r) for r in cells], buckets)
    width = F.lit(None).cast("long")
    for t in reversed(tops):
        width = F.when(F.col("_cell") <= t, F.lit(t).cast("long")).otherwise(width)
    out = sizes.withColumn("bucket_length", width).withColumn("_order", shuffled_by(SEED, "doc_id")).withColumn("_one", F.lit(1))
    out = running_sum(out, "bucket_length", "_order", "_one", "_at", ties=("n_tokens",))
    rows = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_length"))).cast("long")
    out = out.withColumns({"batch": F.floor(F.col("_at") / rows).cast("long"), "slot": (F.col("_at") % rows).cast("long")})
    return out.select("doc_id", "n_tokens", "bucket_length", "batch", "slot", F.concat_ws("-", "bucket_length", "batch").alias("batch_id"))
