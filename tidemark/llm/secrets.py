"""Secret scans with multipart credential linking.

Parts found in a text are strong (an assignment, an access identifier, a long hexadecimal run)
or weak (an unlabelled 40-character key, an endpoint). Strong parts always count. A weak part
counts only if a complementary part stands in the same scope (a block between blank lines),
however far apart, or within `reach` characters where that is given: an access identifier or an endpoint
for a key; an access identifier, an assignment or a key for an endpoint. The interval join of weak parts with their anchors is a window over each
scope's parts in order, which looks at the nearest anchor on either side, so it is linear in
the number of parts.

Defined results: a null text is the empty text; a text without spans has zero counts, the hash
of the empty string and empty spans; repeated rows give equal rows; columns beyond doc_id and
text are ignored by `scan` and carried by `redact`.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Kinds of spans in their order at equal starts.
KINDS = ("assign", "access", "hex", "key", "endpoint")
STRONG = ("assign", "access", "hex")
MASK = "[REDACTED]"

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
LONG_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
KEY = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(r"""(?a)\b(?:https?|ftp|ssh|mysql|postgres(?:ql)?|mongodb|redis|amqp)://[^\s"'<>]{4,}|\b[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.(?:amazonaws\.com|internal|local)(?::\d{2,5})?\b""")
#: Each endpoint holds one of these.
HINTS = ("://", ".amazonaws.com", ".internal", ".local")
BLANK_LINE = re.compile(r"\n[\x20\t\r]*\n")


def parts(text: str) -> list[tuple[int, str, int, int]]:
    """(start, kind, end, scope) of the strong and weak parts of one text, in code points."""
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), "access", m.end()) for m in LONG_ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in LONG_HEX.finditer(text)]
    anchors = any(k != "hex" for _, k, _ in found)
    endpoints = [(m.start(), "endpoint", m.end()) for m in ENDPOINT.finditer(text)] if any(x in text for x in HINTS) else []
    if anchors or endpoints:  # a weak part counts only beside an anchor or the other weak kind
        strong = sorted(found)
        taken, at = [(s, e) for s, _, e in strong], 0
        weak = sorted([(m.start(), "key", m.end()) for m in KEY.finditer(text) if _mixed(m[0])] + endpoints)
        reach = -1
        for s, k, e in weak:
            while at < len(taken) and taken[at][0] <= s:
                reach = max(reach, taken[at][1])
                at += 1
            if reach <= s and (at == len(taken) or taken[at][0] >= e):
                found.append((s, k, e))
    if not found:
        return []
    found.sort(key=lambda x: (x[0], KINDS.index(x[1])))
    breaks = [m.end() for m in BLANK_LINE.finditer(text)] if anchors or endpoints else []
    out, scope = [], 0
    for s, k, e in found:
        while scope < len(breaks) and breaks[scope] <= s:
            scope += 1
        out.append((s, k, e, scope))
    return out


def _mixed(word: str) -> bool:
    return any(c.isupper() for c in word) and any(c.islower() for c in word) and any(c.isdigit() for c in word)


_PARTS = "array<struct<start:int,kind:string,end:int,scope:int>>"
_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("scope", pa.int32())]))


def _find(batches):
    for b in batches:
        found = [[dict(zip(("start", "kind", "end", "scope"), x)) for x in parts(t)] if t else [] for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(found, _ARROW)], names=["doc_id", "uid", "parts"])


def linked(rows: DataFrame, reach: int | None = None) -> DataFrame:
    """rows(uid, ..., start, kind, end, scope) without the weak parts that have no complementary part in their scope, or none within reach."""
    near = Window.partitionBy("uid", "scope").orderBy("start", "kind", "end")
    back, ahead = near.rowsBetween(Window.unboundedPreceding, -1), near.rowsBetween(1, Window.unboundedFollowing)
    for_key, for_endpoint = F.col("kind").isin("access", "endpoint"), F.col("kind").isin("access", "assign", "key")

    def close(test):
        before = F.max(F.when(test, F.col("end"))).over(back)
        after = F.min(F.when(test, F.col("start"))).over(ahead)
        if reach is None:
            return before.isNotNull() | after.isNotNull()
        return F.coalesce(F.col("start") - before <= reach, F.lit(False)) | F.coalesce(after - F.col("end") <= reach, F.lit(False))

    flagged = rows.withColumns({"_for_key": close(for_key), "_for_endpoint": close(for_endpoint)})
    ok = F.col("kind").isNull() | F.col("kind").isin(*STRONG) | ((F.col("kind") == "key") & F.col("_for_key")) | ((F.col("kind") == "endpoint") & F.col("_for_endpoint"))
    return flagged.withColumn("kind", F.when(ok, F.col("kind"))).drop("_for_key", "_for_endpoint")


def _order(kind):
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", reach: int | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of each row of docs, with found, the spans as an array."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("uid"))
    id_type = keyed.schema["doc_id"].dataType.simpleString()
    found = keyed.mapInArrow(_find, f"doc_id {id_type}, uid long, parts {_PARTS}")
    # texts with strong parts alone need no link, and so no shuffle
    weak = F.exists("parts", lambda p: ~p["kind"].isin(*STRONG))
    span = lambda p: F.struct(p["start"].alias("start"), _order(p["kind"]).alias("rank"), p["kind"].alias("kind"), p["end"].alias("end"))
    rows = found.select("doc_id", "uid", F.explode(F.when(weak, F.col("parts")).otherwise(F.array(F.struct(F.lit(None).cast("int").alias("start"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("int").alias("end"), F.lit(-1).alias("scope"))))).alias("p"), F.when(~weak, F.transform("parts", span)).alias("strong"))
    rows = linked(rows.select("doc_id", "uid", "strong", "p.*"), reach)
    here = F.struct("start", _order(F.col("kind")).alias("rank"), "kind", "end")
    spans = rows.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.first("strong", True).alias("strong"), F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), here))).alias("own"))
    spans = spans.select("doc_id", F.coalesce("strong", "own").alias("found"))
    base = F.filter("found", lambda x: x["kind"].isin(*STRONG))
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    return spans.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"), "found")


def redact(docs: DataFrame, text: str = "text", chars: str = "n_chars", reach: int | None = None) -> DataFrame:
    """docs with every span replaced by MASK, and the length in `chars` kept right. No row is dropped."""
    body = F.coalesce(F.col(text), F.lit(""))
    key = F.md5(body)  # spans follow from the text alone, which 128 bits tell apart
    names = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), key.alias("_key"))
    spans = scan(docs.select(key.alias("key"), body.alias("text")), "text", "key", reach).where(F.size("found") > 0)
    spans = spans.select("doc_id", F.transform("found", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("found")).dropDuplicates(["doc_id"])
    both = held.join(spans, F.col("_key") == F.col("doc_id"), "left")
    # walk over the spans in order, copying the text between them; overlapping spans merge
    text_of = F.col("_row")[text]
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    walked = F.aggregate(
        "found", start,
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(text_of, acc["at"] + 1, s["start"] - acc["at"]), F.lit(MASK))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text_of, acc["at"] + 1, F.length(text_of))),
    )
    both = both.withColumn("_clean", F.when(F.col("found").isNull(), text_of).otherwise(walked))
    cols = []
    for c in names:
        value = F.col("_clean") if c == text else F.length("_clean").cast(docs.schema[c].dataType) if c == chars else F.col("_row")[c]
        cols.append(value.alias(c))
    return both.select(*cols)
