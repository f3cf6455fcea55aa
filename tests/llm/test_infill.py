import hashlib
import random

from frames import empty_documents, odd_documents
from pyspark.sql import functions as F

from tidemark.llm import infill


def by_hand(doc_id, text):
    """The contract read once more, with Python's own strings."""
    t = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    p, q = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, len(t), "plain", None, None, t)
    a, m, z = t[:p], t[p:q], t[q:]
    if h4 % 100 < 20:
        return (doc_id, len(t), "spm", p, q - p, f"<S>{z}<P>{a}<M>{m}")
    return (doc_id, len(t), "psm", p, q - p, f"<P>{a}<S>{z}<M>{m}")


def texts():
    rng = random.Random(3)
    letters = "ab \n\té日😀<>PSḾ\x00'"
    sizes = [0, 1, 2, 255, 256, 257, 511, 512, 513, 5000] * 12
    return [(i, "".join(rng.choice(letters) for _ in range(n))) for i, n in enumerate(sizes)]


def test_equals_plain_strings_and_comes_back(spark):
    rows = [*texts(), (1000, None), (1001, "x<P>y"), (1002, "<S"), (1003, "a<M>"), (1004, "<<S"), (None, "no id at all"), (1005, "é" * 300_000)]
    got = infill.transform(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((by_hand(*r) for r in rows), key=str)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    text = dict(rows)
    assert all(r.back == (text[r.doc_id] or "") for r in got)


def test_slices_change_nothing(spark, monkeypatch):
    import pyarrow as pa

    b = pa.RecordBatch.from_pydict({"doc_id": ["1", "2", "3", "4", "5"], "text": ["aa", None, "b" * 50, "", "c"]})
    monkeypatch.setattr(infill, "SLICE_BYTES", 4)
    assert [p.num_rows for p in infill._slices(b)] == [2, 1, 2] and sum(p.num_rows for p in infill._slices(b.slice(0, 0))) == 0


def test_rates_and_seed(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text "), F.col("id").cast("string")).alias("text"))
    forms = {r.form: r["count"] for r in infill.transform(docs, rate=50, spm_rate=50, seed="it's").groupBy("form").count().collect()}
    assert 900 < forms["plain"] < 1100 and 430 < forms["psm"] < 570
    assert infill.transform(docs, rate=0).where("form <> 'plain'").count() == 0


def test_odd_tables(spark):
    odd = odd_documents(spark).withColumn("form", F.lit("x")).withColumn("output", F.lit(1))
    rows = infill.transform(odd).collect()
    assert sorted((tuple(r) for r in rows), key=str) == sorted((by_hand(r.doc_id, r.text) for r in odd.collect()), key=str)
    assert infill.transform(empty_documents(spark)).count() == 0
    named = infill.transform(odd.select(F.concat(F.lit("d"), "doc_id").alias("key"), F.col("text").alias("body")), "body", "key")
    assert named.schema["doc_id"].dataType.simpleString() == "string" and named.count() == 8
