"""Keyed tables at rest that several writers share: buckets of a key, immutable folders, and commits that are compared and set.

A table is a folder. `_commits` holds a file a version, named by its number; the highest one that says something is the table. It names, for each bucket of the key, the folders
that hold its rows. Folders are written once and never changed, so readers see one version to the end, and a writer replaces the buckets that it changes and names
the others again. Buckets are Spark's own (hash of the key, modulo their number, in the names of the files), so two tables with as many buckets are joined by
their key without a shuffle.

A writer says which number it has read; its commit must be the next one. The file appears at once with its whole content, or not at all if another writer was first:
by a hard link on a local file system, elsewhere by a rename, which must not replace (HDFS refuses; a store without an atomic rename needs a committer of its own).
"""

from __future__ import annotations

import hashlib
import json
import random
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Buckets of a new table. Choose them so that a bucket's rows fit a task: as many as the shuffle partitions of the jobs that join it.
BUCKETS = 16


class Conflict(Exception):
    """Another writer has committed since the version was read."""


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    fs, p = file_system(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Whether the file path was made, with all of text at once; False if it was there."""
    fs, target = file_system(spark, path)
    hidden = f"{target.getParent()}/.{uuid.uuid4().hex}"
    write_text(spark, hidden, text)
    source = file_system(spark, hidden)[1]
    try:
        if fs.getUri().getScheme() != "file":
            return bool(fs.rename(source, target))
        local = lambda p: spark._jvm.java.io.File(p.toUri().getPath()).toPath()
        try:
            spark._jvm.java.nio.file.Files.createLink(local(target), local(source))
        except Exception as e:  # the driver's bridge has one class for all of Java's
            if "FileAlreadyExistsException" not in str(e):
                raise
            return False
        return True
    finally:
        fs.delete(source, False)


@dataclass(frozen=True)
class Version:
    """What a table was when it was read: the number of its last commit, and its folders by bucket. number is 0 where there is no commit."""

    spark: SparkSession
    base: str
    number: int
    key: str | None = None
    buckets: int = 0
    schema: StructType | None = None
    parts: tuple[tuple[int, str], ...] = ()
    note: dict = field(default_factory=dict)
    #: The one folder of a table that is not bucketed.
    plain: str | None = None
    #: Tells this reading from others of the same version.
    token: str = field(default_factory=lambda: uuid.uuid4().hex, compare=False)

    @property
    def exists(self) -> bool:
        return self.schema is not None or self.plain is not None

    def path(self, bucket: int, folder: str) -> str:
        return f"{self.base}/{folder}/bucket={bucket}"

    def only(self, buckets: Iterable[int]) -> Version:
        """The rows of some buckets."""
        wanted = set(buckets)
        return replace(self, parts=tuple(p for p in self.parts if p[0] in wanted))

    def table(self) -> DataFrame | None:
        """The rows as a scan of files; None where there is no version."""
        if self.plain is not None:
            return self.spark.read.parquet(f"{self.base}/{self.plain}")
        if self.schema is None:
            return None
        if not self.parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self.path(b, f) for b, f in self.parts])

    def bucketed(self) -> DataFrame:
        """The rows as a table that Spark knows to be bucketed by the key: joins and groups by it need no shuffle of this side.

        The session's catalog gets an entry for each version that is read so, over the files as they are.
        """
        if self.schema is None:
            raise ValueError(f"{self.base} is no bucketed table")
        if not self.parts:
            return self.spark.createDataFrame([], self.schema)
        name = self._name()
        if not self.spark.catalog.tableExists(name):
            quoted = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            self.spark.sql(f"CREATE TABLE {name} ({columns}, _part STRING) USING parquet PARTITIONED BY (_part) CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION {quoted(f'{self.base}/_none')}")
            # a partition for each bucket and folder
            self.spark.sql(f"ALTER TABLE {name} ADD " + " ".join(f"PARTITION (_part={quoted(f'{b}.{f}')}) LOCATION {quoted(self.path(b, f))}" for b, f in self.parts))
        return self.spark.table(name).drop("_part")

    def _name(self) -> str:
        return f"tidemark_{hashlib.md5(repr((self.base, self.parts, self.token)).encode()).hexdigest()}"

    def forget(self) -> None:
        """Drops the catalog's entry, once nothing reads the table any more. Its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name()}")


def commits(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the commit files, the highest first."""
    fs, folder = file_system(spark, f"{base}/_commits")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def read(spark: SparkSession, base: str) -> Version:
    """The version of the highest commit. A commit that says nothing is one whose writer died; the one before it holds, but its number is taken."""
    numbers = commits(spark, base)
    last = numbers[0] if numbers else 0
    for n in numbers:
        text = read_text(spark, f"{base}/_commits/{n:012d}").strip()
        if text.startswith("{"):
            m = json.loads(text)
            return Version(spark, base, last, m["key"], m["buckets"], StructType.fromJson(m["schema"]), tuple((b, f) for b, f in m["parts"]), m["note"])
        if text:
            return Version(spark, base, last, plain=text)
    return Version(spark, base, last)


def commit(version: Version, text: str) -> int:
    """Makes text the commit after version, or raises Conflict."""
    number = version.number + 1
    if not publish(version.spark, f"{version.base}/_commits/{number:012d}", text):
        raise Conflict(f"{version.base}: version {number} was committed by another writer")
    return number


def _told(v: Version) -> str:
    return json.dumps({"key": v.key, "buckets": v.buckets, "schema": v.schema.jsonValue(), "parts": [list(p) for p in v.parts], "note": v.note})


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets)).cast("int")


def write_folder(rows: DataFrame, base: str, key: str, buckets: int) -> tuple[tuple[int, str], ...]:
    """rows in a new folder under base, a file for each bucket that has any; the buckets and the folder, which no commit names yet."""
    spark, folder = rows.sparkSession, f"rows-{uuid.uuid4().hex}"
    made = f"tidemark_{folder.replace('-', '_')}"
    dealt = rows.withColumn("bucket", bucket(key, buckets)).repartition("bucket")
    dealt.write.format("parquet").partitionBy("bucket").bucketBy(buckets, key).sortBy(key).option("path", f"{base}/{folder}").saveAsTable(made)
    spark.sql(f"DROP TABLE {made}")  # an external table: its files stay
    fs, p = file_system(spark, f"{base}/{folder}")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return tuple(sorted((int(n.split("=")[1]), folder) for n in names if n.startswith("bucket=")))


def drop_folders(spark: SparkSession, base: str, parts: Iterable[tuple[int, str]]) -> None:
    """Deletes folders that no commit has named."""
    for folder in {f for _, f in parts}:
        fs, p = file_system(spark, f"{base}/{folder}")
        fs.delete(p, True)


def update(spark: SparkSession, base: str, schema: StructType, key: str, change: Callable[[Version], tuple[Version, Iterable[tuple[int, str]]] | None], buckets: int = BUCKETS, attempts: int = 20, wait: float = 0.2) -> Version:
    """Applies change to the table's last version and commits what it returns, with the parts that it has written; where another writer was first, reads again and retries.

    change gets a version, the empty one of a table that is not there yet, and may run several times; None leaves the table as it is.
    """
    for n in range(attempts):
        found = read(spark, base)
        if found.plain is not None:
            raise ValueError(f"{base} is a table without buckets")
        own = found if found.exists else replace(found, key=key, buckets=buckets, schema=schema)
        done = change(own)
        if done is None:
            return found
        after, written = done
        try:
            return replace(after, number=commit(replace(after, number=found.number), _told(after)))
        except Conflict:
            drop_folders(spark, base, written)
            if n + 1 == attempts:
                raise
            time.sleep(wait * (n + 1) * random.random())  # two that meet do not meet again
    raise ValueError("attempts must be at least 1")


def create(spark: SparkSession, base: str, schema: StructType, key: str, buckets: int = BUCKETS) -> Version:
    """The table at base, made without rows if it is not there."""
    while not (found := read(spark, base)).exists:
        new = replace(found, key=key, buckets=buckets, schema=schema)
        try:
            return replace(new, number=commit(new, _told(new)))
        except Conflict:  # another writer has made it
            continue
    return found


def rebucket(spark: SparkSession, base: str, key: str, buckets: int, attempts: int = 20) -> Version:
    """The table at base dealt anew into so many buckets of key, as its next version. All of it is rewritten."""
    for n in range(attempts):
        found = read(spark, base)
        rows = found.table()
        new = Version(spark, base, found.number, key, buckets, rows.schema, write_folder(rows, base, key, buckets), found.note)
        try:
            return replace(new, number=commit(new, _told(new)))
        except Conflict:
            drop_folders(spark, base, new.parts)
            if n + 1 == attempts:
                raise
    raise ValueError("attempts must be at least 1")


def append(rows: DataFrame, base: str, key: str, buckets: int = BUCKETS, note: dict | None = None) -> Version:
    """rows added to the table at base, which is made if it is not there. What is there is neither read nor rewritten."""
    spark = rows.sparkSession
    found = read(spark, base)
    n = found.buckets if found.exists else buckets
    written = write_folder(rows, base, key, n)

    def change(v: Version):
        if v.buckets != n:
            raise ValueError(f"{base} has {v.buckets} buckets, not {n}")
        return replace(v, parts=v.parts + written, note={**v.note, **(note or {})}), ()  # they serve the next attempt as well

    try:
        return update(spark, base, rows.schema, key, change, n)
    except Exception:
        drop_folders(spark, base, written)
        raise


def replace_buckets(base: str, staged: Version, change: Callable[[DataFrame, DataFrame], DataFrame], note: dict | None = None, attempts: int = 20) -> Version:
    """Writes change(old rows, staged rows) over the buckets that staged has, and names all others again.

    staged is a version of rows at rest with the table's buckets, such as `stage` makes; both sides come bucketed, so a join by the key shuffles neither.
    """
    touched = sorted({b for b, _ in staged.parts})

    def rewrite(v: Version):
        if v.buckets != staged.buckets:
            raise ValueError(f"{base} has {v.buckets} buckets, not {staged.buckets}")
        if not touched:
            return (replace(v, note={**v.note, **note}), ()) if note else None
        own = v.only(touched)
        written = write_folder(change(own.bucketed(), staged.bucketed()).select(v.schema.names), base, v.key, v.buckets)
        own.forget()
        kept = tuple(p for p in v.parts if p[0] not in touched)
        return replace(v, parts=kept + written, note={**v.note, **(note or {})}), written

    return update(staged.spark, base, staged.schema, staged.key, rewrite, staged.buckets, attempts)


def stage(rows: DataFrame, base: str, key: str, buckets: int) -> Version:
    """rows written once under base, to be read as often as wanted; no commit names them. `drop_folders` takes their parts away again."""
    parts = write_folder(rows, base, key, buckets)
    return Version(rows.sparkSession, base, 0, key, buckets, rows.schema, parts)


def vacuum(spark: SparkSession, base: str, keep: int = 2, age: float = 7 * 86_400.0, now: Callable[[], float] = time.time) -> list[str]:
    """Deletes the folders of rows that none of the last `keep` commits names, and returns their names.

    Readers of older versions lose them. A folder younger than `age` seconds stays: a writer may be about to commit it, or a job may be reading it.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    named: set[str] = set()
    for n in [n for n in commits(spark, base) if read_text(spark, f"{base}/_commits/{n:012d}").strip()][:keep]:
        text = read_text(spark, f"{base}/_commits/{n:012d}").strip()
        named |= {f for _, f in json.loads(text)["parts"]} if text.startswith("{") else {text}
    fs, folder = file_system(spark, base)
    gone = []
    for s in fs.listStatus(folder) if fs.exists(folder) else []:
        name = s.getPath().getName()
        if s.isDirectory() and name.startswith(("rows-", "version-")) and name not in named and s.getModificationTime() / 1000 < now() - age:
            fs.delete(s.getPath(), True)
            gone.append(name)
    return sorted(gone)
