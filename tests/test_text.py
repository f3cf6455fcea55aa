from pyspark.sql import functions as F

from tidemark.functions import text as t


def values(spark, column, rows, kind="string"):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], f"x {kind}").select(column).collect()]


def test_strip_and_blank(spark):
    rows = [" a ", "\n", " x　", "", "​z"]
    assert values(spark, t.strip(F.col("x")), rows) == [r.strip() for r in rows]
    assert values(spark, t.is_blank(F.col("x")), [*rows, None]) == [False, True, False, True, False, True]


def test_truncate_counts_code_points(spark):
    rows = ["a" * 10, "b" * 11, "c\nd", "😀" * 12, "  e  "]
    want = [x if len(x := r.replace("\n", " ").strip()) <= 10 else x[:9] + "…" for r in rows]
    assert values(spark, t.truncate(F.col("x"), 10), rows) == want


def test_buckets_and_tokens(spark):
    rows = [0, 3, 4, 7, 20, 21, 100, 101, 10_000, 10_001]
    assert values(spark, t.length_bucket(F.col("x")), rows, "int") == ["short"] * 5 + ["medium"] * 2 + ["long"] * 2 + ["nan"]
    assert values(spark, t.estimated_tokens(F.col("x")), rows, "int") == [0, 1, 1, 1, 5, 5, 25, 25, 2500, 2500]


def test_names_booleans_words(spark):
    assert values(spark, t.display_name(F.col("x")), ["x: y", ":", "plain", " : z"]) == ["x", ":", "plain", " : z"]
    assert values(spark, t.to_boolean(F.col("x")), ["TRUE", " no", "1", "maybe", "", None]) == [True, False, True, None, None, None]
    long = " ".join(f"w{i}" for i in range(20))
    assert values(spark, t.first_words(F.col("x")), [long, " a  b "]) == [" ".join(f"w{i}" for i in range(15)), "a  b"]
