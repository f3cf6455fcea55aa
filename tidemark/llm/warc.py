"""WARC archives: writing, a normaliser for monolithic gzip files, and reading by offset index.

`write` makes one record a row and lets Spark's text writer compress each file as one gzip stream,
as many crawl tools do. `normalise` inflates each such stream once, in pieces, rewrites every
record as a gzip member of its own, and writes a sidecar index of (offset, length, record id) beside
it; Spark's text writer writes both, with an empty gzip member as line separator, so archive and
index are valid multi-member gzip files on any file system Spark knows. `read` joins archives and
index by file and inflates just the members that the index names.

Equal payloads of at least LEAST_BYTES are stored once: the record of the largest page_id is the
response, the others revisit it. Defined results: a null html is the empty payload; rows that repeat
the largest page_id are all responses; a null page_id revisits if the group has another id, and is a response if not;
line ends in urls are escaped; an empty table makes no records; further columns are ignored.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import scratch

LEAST_BYTES = 1000
#: Bounds the size of a monolithic file, which one task inflates.
RECORDS_A_FILE = 5000
#: Bytes inflated at a time.
PIECE = 1 << 16
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: An empty gzip member: what stands between two records' members.
EMPTY = gzip.compress(b"", mtime=0)


def records(pages: DataFrame) -> DataFrame:
    """The WARC record of each row of pages(page_id, url, html) as text, without its closing line ends."""
    rows = pages.select("page_id", F.translate(F.coalesce("url", F.lit("about:blank")), "\r\n \t", "++++").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"size": F.octet_length("html").cast("long"), "digest": F.sha1("html")})
    large = rows.where(F.col("size") >= LEAST_BYTES)
    first = large.groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("digest").alias("_digest"), "first")
    rows = rows.join(first, (F.col("digest") == F.col("_digest")) & (F.col("size") >= LEAST_BYTES), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(CRLF * 2))
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    more = F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn("first"), F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}"))).otherwise(F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), kind, F.lit(f"{CRLF}WARC-Record-ID: "), urn("page_id"), F.lit(f"{CRLF}WARC-Date: {DATE}{CRLF}WARC-Target-URI: "), F.col("url"),
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(CRLF), more, F.lit(f"Content-Type: application/http;msgtype=response{CRLF}Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF * 2),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write(pages: DataFrame, path: str) -> None:
    """Monolithic gzip files of the records of pages under path."""
    records(pages).write.option("compression", "gzip").option("lineSep", CRLF * 2).option("maxRecordsPerFile", RECORDS_A_FILE).text(path)


def inflated(data: bytes) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, in pieces."""
    at = 0
    while at < len(data):
        z = zlib.decompressobj(31)
        while not z.eof:
            piece = data[at : at + PIECE]
            if not piece:
                raise ValueError("the gzip stream ends early")
            at += len(piece)
            yield z.decompress(piece)
        at -= len(z.unused_data)


def split(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a stream, each with its closing line ends."""
    held = bytearray()
    need = -1  # length of the record at the front, where known
    for piece in pieces:
        held += piece
        while True:
            if need < 0:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                head = bytes(held[:end]).lower()
                if not head.startswith(b"warc/"):
                    raise ValueError("not a WARC record")
                size = next(int(x.split(b":", 1)[1]) for x in head.split(b"\r\n") if x.startswith(b"content-length:"))
                need = end + 4 + size + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = -1
    if held.strip():
        raise ValueError("the last record is cut off")


def fields(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block."""
    head, _, rest = record.partition(b"\r\n\r\n")
    named = dict(x.split(":", 1) for x in head.decode("utf-8").split(CRLF)[1:])
    named = {k.strip().lower(): v.strip() for k, v in named.items()}
    return named, rest[: int(named["content-length"])]


def _members(batches):
    seq = offset = 0
    for b in batches:
        for content in b.column(0):
            seqs, kinds, values = [], [], []
            for record in split(inflated(content.as_py())):
                member = gzip.compress(record, 6, mtime=0)
                line = f"{offset} {len(member)} {fields(record)[0]['warc-record-id']}\n"
                seqs += [seq, seq]
                kinds += ["warc", "index"]
                values += [member, gzip.compress(line.encode(), mtime=0)]
                offset += len(member) + len(EMPTY)
                seq += 1
                if len(values) >= 512:
                    yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(seqs, pa.int64()), pa.array(values, pa.binary())], names=["kind", "seq", "value"])
                    seqs, kinds, values = [], [], []
            if values:
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(seqs, pa.int64()), pa.array(values, pa.binary())], names=["kind", "seq", "value"])


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Archives under target/kind=warc with a member a record, and their indexes under target/kind=index with the same file names."""
    files = spark.read.format("binaryFile").load(source).select("content")
    out = files.mapInArrow(_members, "kind string, seq long, value binary").sortWithinPartitions("kind", "seq")
    out.select("kind", F.col("value").cast("string").alias("value")).write.partitionBy("kind").option("encoding", "ISO-8859-1").option("lineSep", EMPTY.decode("latin-1")).text(target)


def _index_rows(batches):
    for b in batches:
        names, offsets, sizes = [], [], []
        for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for line in gzip.decompress(content).decode().splitlines():
                o, n, _ = line.split(" ", 2)
                names.append(name)
                offsets.append(int(o))
                sizes.append(int(n))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64())], names=["name", "offset", "size"])


def _read_rows(batches):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    number = lambda urn: None if urn is None or urn == "<urn:page:null>" else int(urn[len("<urn:page:") : -1])
    for b in batches:
        rows = []
        for content, places in zip(b.column(0), b.column(1).to_pylist()):
            data = content.as_py()
            for p in places:
                named, block = fields(gzip.decompress(data[p["offset"] : p["offset"] + p["size"]]))
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = named["warc-payload-digest"].removeprefix("sha1:")
                size = next(int(x.split(b":", 1)[1]) for x in http.lower().split(b"\r\n") if x.startswith(b"content-length:"))
                if named["warc-type"] == "response" and (size != len(payload) or digest != sha1(payload).hexdigest()):
                    raise ValueError(f"{named['warc-record-id']}: the payload differs from its digest")
                rows.append((number(named["warc-record-id"]), named["warc-target-uri"], size, digest, named["warc-type"], number(named.get("warc-refers-to"))))
        cols = list(zip(*rows)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type and refers_to of each record of normalised archives."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/kind=warc")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):  # no records, no files
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    index = files.load(f"{path}/kind=index").select(name.alias("name"), "content").mapInArrow(_index_rows, "name string, offset long, size long")
    places = index.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("offset", "size"))).alias("places"))  # as many as one archive has records
    both = files.load(f"{path}/kind=warc").select(name.alias("name"), "content").join(places, "name").select("content", "places")
    return both.mapInArrow(_read_rows, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the archives of pages to the shared folder, normalises them, and reads them back."""
    spark = pages.sparkSession
    first, second = scratch(spark, "warc-stream"), scratch(spark, "warc")
    write(pages, first)
    normalise(spark, first, second)
    return read(spark, second)
