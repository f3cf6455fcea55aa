"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in Spark functions alone.

A text's paragraphs are its lines, long ones cut every PIECE code points; their 64-bit hashes are
its digests, each counted once. A fingerprint deals the digests out to groups of about
GROUP by their first bits and keeps a table of cells for each group; a digest enters one cell in each
of three thirds of the table, and a cell holds a count, the xor of its digests and the xor
of their checks. Groups nest and tables add up, so a fingerprint folds to fewer groups. Two versions' fingerprints are subtracted cell by cell, and peeling takes out digest after
digest from cells that hold just one, until the difference is recovered or stuck. A stuck
group is sketched anew with larger tables; after the last size the digests are compared one by one.

Defined results: a null text is the empty text, which has no digests; two texts without digests have likeness
1, a text with and one without 0; texts are ordered by doc_id (null last), then by themselves, and the last is
followed by the first; a lone text follows itself; repeated rows are separate documents; ids are of any type that has an order; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemark.operators.ranges import dealt as dealt_out

from .tables import let

PIECE = 128
GROUP = 16
CELLS = 24
RETRIES = (96, 384)
ROUNDS = 24
_CHECK = 0xFFFF


def digests(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(rf"[^\n]{{1,{PIECE}}}"), F.lit(0)), lambda p: F.xxhash64(p)))


def group_bits(n: Column) -> Column:
    """The binary logarithm of the number of groups: the least that leaves about GROUP digests to a group."""
    return F.when(n <= GROUP, F.lit(0)).otherwise(F.ceil(F.log2(n / GROUP)).cast("int"))


def _placed(own: Column, cells: Column) -> Column:
    """Digests with their check and their three cells."""
    third = F.floor(cells / 3).cast("int")

    def place(d):
        h = F.xxhash64(d, cells)
        at = lambda bits, k: (F.pmod(F.shiftrightunsigned(h, bits), third.cast("long")).cast("int") + third * k)
        return F.struct(d.alias("k"), F.xxhash64(d, F.lit("check")).bitwiseAND(_CHECK).alias("x"), at(0, 0).alias("a"), at(21, 1).alias("b"), at(42, 2).alias("c"))

    return F.transform(own, place)


def _at(p: Column, i: Column) -> Column:
    return (p["a"] == i) | (p["b"] == i) | (p["c"] == i)


def table(own: Column, cells: Column) -> Column:
    """The cells of a group's digests."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("x"))
    add = lambda acc, p: F.struct((acc["n"] + 1).alias("n"), acc["k"].bitwiseXOR(p["k"]).alias("k"), acc["x"].bitwiseXOR(p["x"]).alias("x"))
    third = F.floor(cells / 3).cast("int")
    part = lambda ps, k, c: F.transform(F.sequence(third * k, third * (k + 1) - 1), lambda i: F.aggregate(F.filter(ps, lambda p: p[c] == i), zero, add))
    return let(_placed(own, cells), lambda ps: F.concat(*(part(ps, k, c) for k, c in enumerate("abc"))))


def difference(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: F.struct((p["n"] - q["n"]).alias("n"), p["k"].bitwiseXOR(q["k"]).alias("k"), p["x"].bitwiseXOR(q["x"]).alias("x")))


def peel(cells: Column, size: Column) -> Column:
    """(cells, found): what is left of a difference after ROUNDS rounds, and the digests recovered with their side (1 or -1)."""
    start = F.struct(cells.alias("cells"), F.array().cast("array<struct<k:bigint,s:int>>").alias("found"), F.lit(True).alias("go"))

    def take(cell, pure, i):
        hits = F.filter(pure, lambda p: _at(p, i))
        less = lambda acc, p: F.struct((acc["n"] - p["s"]).alias("n"), acc["k"].bitwiseXOR(p["k"]).alias("k"), acc["x"].bitwiseXOR(p["x"]).alias("x"))
        return F.aggregate(hits, cell, less)

    def round_(state, _):
        single = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (F.xxhash64(c["k"], F.lit("check")).bitwiseAND(_CHECK) == c["x"]))
        keys = F.array_distinct(F.transform(single, lambda c: F.struct(c["k"].alias("k"), c["n"].alias("s"))))

        def step(found):
            placed = F.zip_with(found, _placed(F.transform(found, lambda f: f["k"]), size), lambda f, p: F.struct(p["k"].alias("k"), p["x"].alias("x"), p["a"].alias("a"), p["b"].alias("b"), p["c"].alias("c"), f["s"].alias("s")))
            left = let(placed, lambda pure: F.transform(state["cells"], lambda c, i: take(c, pure, i)))
            stuck = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(False).alias("go"))
            return F.when(F.size(found) == 0, stuck).otherwise(F.struct(left.alias("cells"), F.concat(state["found"], found).alias("found"), F.lit(True).alias("go")))

        return F.when(state["go"], let(keys, step)).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_)


def _known(left: Column) -> Column:
    """How many digests were recovered, or -1 where cells are left."""
    return F.when(F.forall(left["cells"], lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["x"] == 0)), F.size(left["found"])).otherwise(F.lit(-1))


def _retried(a: Column, b: Column) -> Column:
    """How many digests two groups differ in, recovered from larger and larger sketches; one with fewer cells than the least possible difference is not tried."""
    least = F.abs(F.size(a) - F.size(b))

    def attempt(known, size):
        left = peel(difference(table(a, size), table(b, size)), size)
        return F.when((known >= 0) | (least > size), known).otherwise(let(left, _known))

    tried = F.aggregate(F.array(*[F.lit(c) for c in RETRIES]), F.lit(-1), attempt)
    exact = F.size(F.array_except(a, b)) + F.size(F.array_except(b, a))
    return let(tried, lambda t: F.when(t >= 0, t).otherwise(exact))


def split(own: Column, used: Column, bits: Column) -> Column:
    """own, equal in its first `used` bits, as 2 ** bits groups in the order of the bits that follow: a bit a step, so a digest is looked at twice a bit."""

    def step(groups, i):
        bit = lambda d: F.call_function("shiftrightunsigned", d, F.lit(64) - used - i).bitwiseAND(F.lit(1).cast("long"))
        return F.flatten(F.transform(groups, lambda g: F.array(F.filter(g, lambda d: bit(d) == 0), F.filter(g, lambda d: bit(d) == 1))))

    return F.when(bits <= 0, F.array(own)).otherwise(F.aggregate(F.sequence(F.lit(1), bits), F.array(own), step))


def tables(own: Column) -> Column:
    """The fingerprint as arrays: the table of each group of digests."""
    return F.transform(split(own, F.lit(0), group_bits(F.size(own))), lambda g: table(g, F.lit(CELLS)))


def folded(t: Column, n: Column) -> Column:
    """The tables of n groups from those of more: groups nest, and tables add up cell by cell."""
    add = lambda x, y: F.zip_with(x, y, lambda p, q: F.struct((p["n"] + q["n"]).alias("n"), p["k"].bitwiseXOR(q["k"]).alias("k"), p["x"].bitwiseXOR(q["x"]).alias("x")))
    each = (F.size(t) / n).cast("int")
    sums = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.aggregate(F.slice(t, i * each + 2, each - 1), t[i * each], add))
    return F.when(F.size(t) == n, t).otherwise(sums)


def _sum(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda s, d: s + d)


def recovered(ta: Column, tb: Column) -> Column:
    """How many digests two fingerprints differ in, for each group of the smaller one, to whose groups the other is folded: they are subtracted and peeled; -1 where that is stuck."""
    n = F.least(F.size(ta), F.size(tb))
    return F.zip_with(folded(ta, n), folded(tb, n), lambda x, y: let(peel(difference(x, y), F.lit(CELLS)), _known))


def apart(a: Column, b: Column, found: Column) -> Column:
    """How many digests a and b differ in: what `recovered` found; its stuck groups are split to the finer of both groupings and sketched anew from the digests."""
    some, most = (f(group_bits(F.size(a)), group_bits(F.size(b))) for f in (F.least, F.greatest))
    finer = lambda x, y: _sum(F.zip_with(split(x, some, most - some), split(y, some, most - some), _retried))
    pairs = F.arrays_zip(found.alias("found"), split(a, F.lit(0), some).alias("a"), split(b, F.lit(0), some).alias("b"))
    again = F.transform(pairs, lambda p: F.when(p["found"] >= 0, p["found"]).otherwise(finer(p["a"], p["b"])))
    return F.when(F.forall(found, lambda d: d >= 0), _sum(found)).otherwise(_sum(again))


def likeness(a: Column, b: Column, d: Column) -> Column:
    """Shared digests over all digests of two texts that differ in d, 0 to 1."""
    both = (F.size(a) + F.size(b)).cast("double")
    return F.when(both == 0, F.lit(1.0)).otherwise((both - d) / (both + d))


def encoded(t: Column) -> Column:
    """The fingerprint as text: the number of groups, then base64 of all cells (count, digest, check)."""
    each = F.transform(t, lambda cells: F.array_join(F.transform(cells, lambda c: F.concat(F.lpad(F.hex(c["n"]), 2, "0"), F.lpad(F.hex(c["k"]), 16, "0"), F.lpad(F.hex(c["x"]), 4, "0"))), ""))
    return F.concat(F.size(t).cast("string"), F.lit(":"), F.base64(F.unhex(F.array_join(each, ""))))


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """docs(doc_id, text) with next_text, that of the next row by doc_id and text; after the last row the first.

    Texts are shuffled once, to ranges of doc_id cut at sampled quantiles; just the first row of each
    range is looked up again, for the last row of the range before.
    """
    n = ranges or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if isinstance(docs.schema["doc_id"].dataType, NumericType):
        cuts = sorted(set(docs.where("doc_id is not null").stat.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n))) if n > 1 else []
        cuts = [int(c) for c in cuts]
        at = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(_range_of(F.col("doc_id"), cuts))
        dealt = docs.withColumn("_range", at)
    else:  # ids of any other type that has an order
        dealt = dealt_out(docs, [F.col("doc_id").isNull(), F.col("doc_id")], max(2, n)).drop("_bounds")
    firsts = sorted((r["_range"], r["first"]) for r in dealt.groupBy("_range").agg(F.min("doc_id").alias("first")).collect())  # one row a range
    if not firsts:
        return docs.withColumn("next_text", F.lit(None).cast("string"))
    follows = [(firsts[i][0], firsts[(i + 1) % len(firsts)][1]) for i in range(len(firsts))]
    spark = docs.sparkSession
    follow = spark.createDataFrame(follows, f"_r int, _first {docs.schema['doc_id'].dataType.simpleString()}")
    heads = docs.join(F.broadcast(follow), F.col("doc_id").eqNullSafe(F.col("_first"))).groupBy("_r").agg(F.min("text").alias("_head"))
    w = Window.partitionBy("_range").orderBy(F.col("doc_id").asc_nulls_last(), "text")
    led = dealt.withColumns({"_lead": F.lead("text").over(w), "_last": F.lead(F.lit(True)).over(w).isNull()})
    out = led.join(heads, F.col("_range") == F.col("_r"), "left")
    return out.withColumn("next_text", F.when(F.col("_last"), F.col("_head")).otherwise(F.col("_lead"))).drop("_range", "_lead", "_last", "_r", "_head")


def _range_of(value: Column, cuts: list[int]) -> Column:
    """The number of cuts at or below value, by halving."""
    if not cuts:
        return F.lit(0)

    def half(lo, hi):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < cuts[mid], half(lo, mid)).otherwise(half(mid + 1, hi))

    return half(0, len(cuts))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of each row of docs."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(own).withColumn("n_chars", F.length("text"))
    tail = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars") - tail), F.substring("next_text", F.lit(1), tail)))
    rows = rows.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("_a"), digests(F.col("edited")).alias("_e"), digests(F.col("next_text")).alias("_n"))
    # one expression for all three texts, and for both pairs: each is analysed once
    rows = rows.withColumn("_t", F.transform(F.array("_a", "_e", "_n"), tables))
    # a step a column: nested further, the analyzer's rounds don't suffice
    rows = rows.withColumn("_f", F.transform(F.slice("_t", 2, 2), lambda t: recovered(F.col("_t")[0], t)))
    rows = rows.withColumn("_d", F.zip_with(F.array("_e", "_n"), "_f", lambda x, found: apart(F.col("_a"), x, found)))
    a, e, n, d = F.col("_a"), F.col("_e"), F.col("_n"), F.col("_d")
    return rows.select("doc_id", "n_chars", "edited_sha256", encoded(F.col("_t")[0]).alias("fingerprint"), encoded(F.col("_t")[1]).alias("edited_fingerprint"), likeness(a, e, d[0]).alias("near_edited"), likeness(a, n, d[1]).alias("near_next"))
