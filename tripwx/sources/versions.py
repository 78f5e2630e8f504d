"""Versioned datasets: readers see the old rows or the new ones, whole.

Every write goes to a folder of its own under ``data``; then one small commit
file that names the folder is created under ``commits``.  Creating a file
that must not exist is atomic on file systems and on object stores (a put
that fails if the object is there), and nothing is ever renamed or written
over.  The dataset is the folder of the commit with the highest number, so:

* a writer that dies before its commit leaves the old version in place;
* a job may read the dataset that it replaces, as that version stays;
* of two writers that commit the same number one fails, and nothing is lost.

A commit file that lacks its last line (a store that shows files while they
are written) is not there yet.  ``vacuum`` deletes versions no longer wanted,
and folders that no commit names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

END = "end"
KEEP = 2


class CommitConflict(RuntimeError):
    """Another writer has committed this version number."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _read_file(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def commits(spark: SparkSession, location: str) -> list[dict]:
    """All whole commits, oldest first: number, folder, rows, base (the
    number that the writer saw)."""
    found = []
    for name in _names(spark, f"{location}/commits"):
        if name.startswith((".", "_")):
            continue
        lines = _read_file(spark, f"{location}/commits/{name}").split("\n")
        if lines[-1] == END:
            found.append(json.loads(lines[0]))
    return sorted(found, key=lambda c: c["number"])


def exists(spark: SparkSession, location: str) -> bool:
    return bool(commits(spark, location))


def read(spark: SparkSession, location: str, number: int | None = None) -> DataFrame:
    """The newest version, or the one numbered ``number``."""
    found = [c for c in commits(spark, location) if number in (None, c["number"])]
    if not found:
        raise ValueError(f"{location} has no version" + ("" if number is None else f" {number}"))
    return spark.read.parquet(f"{location}/data/{found[-1]['folder']}")


def _create(spark: SparkSession, path: str, text: str) -> None:
    """Create a file that must not exist."""
    from py4j.protocol import Py4JJavaError

    p, fs = _fs(spark, path)
    try:
        stream = fs.create(p, False)
    except Py4JJavaError as problem:
        if fs.exists(p):
            raise CommitConflict(path) from problem
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_version(df: DataFrame, location: str, partition_by: list[str] | None = None) -> str:
    """Step 1: the rows in a folder that no reader knows yet."""
    folder = uuid.uuid4().hex
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{location}/data/{folder}")
    return folder


def commit(spark: SparkSession, location: str, folder: str, base: int, rows: int) -> int:
    """Step 2: the folder becomes version ``base`` + 1, unless that exists."""
    p, fs = _fs(spark, f"{location}/commits")
    fs.mkdirs(p)
    number = base + 1
    text = json.dumps({"number": number, "folder": folder, "rows": rows, "base": base}) + "\n" + END
    _create(spark, f"{location}/commits/{number:012d}", text)
    return number


def publish(df: DataFrame, location: str, partition_by: list[str] | None = None, expected_rows: int | None = None,
            keep: int = KEEP) -> int:
    """Replace the dataset at ``location`` by ``df``, which may read it;
    returns the new version's number.  The rows that were written are
    counted from the files' footers and must be ``expected_rows``, if given."""
    spark = df.sparkSession
    before = commits(spark, location)
    base = before[-1]["number"] if before else 0
    folder = write_version(df, location, partition_by)
    rows = spark.read.schema(df.schema).parquet(f"{location}/data/{folder}").count()
    if expected_rows is not None and rows != expected_rows:
        raise RuntimeError(f"{location}/data/{folder} holds {rows} rows, not {expected_rows}")
    number = commit(spark, location, folder, base, rows)
    vacuum(spark, location, keep)
    return number


def vacuum(spark: SparkSession, location: str, keep: int = KEEP) -> list[str]:
    """Deletes the data of all but the newest ``keep`` versions, commit
    files first.  Folders without a commit are left: a writer may be about to
    commit one (``orphans`` lists them)."""
    old = commits(spark, location)[:-keep] if keep > 0 else []
    for c in old:
        for path in (f"{location}/commits/{c['number']:012d}", f"{location}/data/{c['folder']}"):
            p, fs = _fs(spark, path)
            fs.delete(p, True)
    return [c["folder"] for c in old]


def orphans(spark: SparkSession, location: str) -> list[str]:
    """Folders that no commit names: writers that died, or that still write."""
    named = {c["folder"] for c in commits(spark, location)}
    return [name for name in _names(spark, f"{location}/data") if name not in named]
