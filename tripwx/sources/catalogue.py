"""A catalogue of Parquet files: path, size, row count and schema of each.

The files' footers are read by ONE distributed job: executors open them
with Arrow's file systems (local, NFS, S3, GCS, ABFS, HDFS) and read nothing
but the footer.  The driver reads none and runs no job per file.  A catalogue
is a table: stored, it is brought up to date by reading the footers of new
and changed files only, and any scan of drifting files plans from it.

Stores that Arrow does not know are served through Spark's own reader
(``schemas_by_spark``): the sorted files are halved until each part has one
mergeable schema, so the number of jobs follows the number of schema changes
along the list, not the number of files.
"""

from __future__ import annotations

import json
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILES_PER_TASK = 256
LISTING = "path string, bytes bigint, modified timestamp"
FOOTER = "rows bigint, row_groups int, schema string, problem string"


def list_files(spark: SparkSession, *paths: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, bytes, modified) of the files at and under ``paths``.  Spark
    lists large folders in a distributed job; contents are not touched."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(list(paths))
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def _spark_type(field: pa.Field, column):
    """Spark's type of a flat Parquet column, None where only Spark can say
    (nested, INT96 and fixed-length columns)."""
    t = field.type
    fixed = column is not None and column.physical_type == "FIXED_LEN_BYTE_ARRAY" and not pa.types.is_decimal(t)
    if column is None or column.physical_type == "INT96" or fixed:
        return None
    named = {pa.bool_(): "boolean", pa.int8(): "tinyint", pa.int16(): "smallint", pa.int32(): "int", pa.int64(): "bigint",
             pa.uint8(): "smallint", pa.uint16(): "int", pa.uint32(): "bigint", pa.uint64(): "decimal(20,0)", pa.float32(): "float",
             pa.float64(): "double", pa.string(): "string", pa.large_string(): "string", pa.binary(): "binary", pa.date32(): "date"}
    if t in named:
        return named[t]
    if pa.types.is_timestamp(t) and t.unit in ("ms", "us"):
        return "timestamp" if t.tz else "timestamp_ntz"
    return f"decimal({t.precision},{t.scale})" if pa.types.is_decimal(t) else None


def _schema_of(footer) -> str:
    """The file's schema as JSON: [[name, type], ..], from the types the file
    itself declares; a column whose type only Spark can tell has none."""
    written = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    if written:
        return json.dumps([[f["name"], f["type"]] for f in json.loads(written)["fields"]])
    flat = {footer.schema.column(i).path: footer.schema.column(i) for i in range(len(footer.schema))}
    return json.dumps([[f.name, _spark_type(f, flat.get(f.name))] for f in footer.schema.to_arrow_schema()])


def _opened(fs, stores: dict, path: str):
    """The file system of a path, kept in ``stores`` by place, and the file's name in it."""
    scheme, _, rest = path.partition("://") if "://" in path else ("file", "", path.removeprefix("file:"))
    if scheme == "file":
        return stores.setdefault("file", fs.LocalFileSystem()), "/" + rest.lstrip("/")
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    place, _, key = rest.partition("/")
    if (scheme, place) not in stores:
        stores[scheme, place] = fs.FileSystem.from_uri(f"{scheme}://{place}/{key}")[0]
    return stores[scheme, place], f"/{key}" if scheme == "hdfs" else f"{place}/{key}"


def _read_footers(batches):
    """Adds a file's footer to its row; what cannot be opened says why."""
    from pyarrow import fs, parquet

    stores: dict = {}
    for batch in batches:
        out = []
        for path in batch.column("path").to_pylist():
            try:
                store, name = _opened(fs, stores, path)
                with store.open_input_file(name) as file:
                    footer = parquet.read_metadata(file)
                out.append((footer.num_rows, footer.num_row_groups, _schema_of(footer), None))
            except (OSError, ValueError, pa.ArrowException) as problem:
                out.append((None, None, None, str(problem)[:500]))
        kinds = (pa.int64(), pa.int32(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *[pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]],
            [*batch.schema.names, "rows", "row_groups", "schema", "problem"])


def footers(files: DataFrame) -> DataFrame:
    """``files`` (path, bytes, modified) with rows, row_groups, schema and
    problem (why the footer could not be read), ``FILES_PER_TASK`` files a task."""
    tasks = min(files.count() // FILES_PER_TASK + 1, 10_000)
    return files.repartition(tasks, "path").mapInArrow(_read_footers, f"{LISTING}, {FOOTER}")


def catalogue(spark: SparkSession, *paths: str) -> DataFrame:
    """The catalogue of the Parquet files at and under ``paths``, not stored."""
    return footers(list_files(spark, *paths))


def update(spark: SparkSession, location: str, *paths: str) -> DataFrame:
    """The stored catalogue at ``location``, brought up to date: rows of
    unchanged files (same path, size and time) stay, new and changed files are
    read, rows of vanished files go.  Each update is a version of its own
    (see ``versions``), so readers never meet half of one."""
    from tripwx.sources import versions

    now = list_files(spark, *paths)
    same = ["path", "bytes", "modified"]
    if versions.exists(spark, location):
        old = versions.read(spark, location)
        stay = old.join(now, same, "left_semi").filter("problem IS NULL")
        rows = stay.unionByName(footers(now.join(stay.select(*same), same, "left_anti")))
    else:
        rows = footers(now)
    versions.publish(rows, location)
    return versions.read(spark, location)


def schema_groups(files: DataFrame) -> list[tuple[T.StructType | None, list[str]]]:
    """(schema, sorted paths) per different schema of a catalogue; the
    schema is None if a column's type is left to Spark.  The driver gets the paths,
    which it needs to plan the scans.  A file without a readable footer is an error."""
    broken = files.filter("problem IS NOT NULL").select("path", "problem").limit(3).collect()
    if broken:
        raise ValueError("no footer read: " + "; ".join(f"{r.path}: {r.problem}" for r in broken))
    rows = files.groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    out = []
    for r in sorted(rows, key=lambda r: r.paths[0]):
        columns = json.loads(r.schema)
        known = all(t is not None for _, t in columns)
        fields = [{"name": name, "type": t, "nullable": True, "metadata": {}} for name, t in columns]
        out.append((_struct(fields) if known else None, r.paths))
    return out


def _struct(fields: list[dict]) -> T.StructType:
    def kind(t):
        return t if isinstance(t, dict) else {"bigint": "long", "int": "integer", "smallint": "short", "tinyint": "byte"}.get(t, t)
    return T.StructType.fromJson({"type": "struct", "fields": [{**f, "type": kind(f["type"])} for f in fields]})


def schemas_by_spark(spark: SparkSession, paths: list[str]) -> list[tuple[T.StructType | None, list[str]]]:
    """(schema, paths) of runs of neighbouring files whose schemas Spark can
    merge; footers are read by Spark's own jobs, one per run tried."""
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    try:
        return [(spark.read.option("mergeSchema", "true").parquet(*paths).schema, list(paths))]
    except (PySparkException, Py4JJavaError) as problem:
        if len(paths) == 1 or "MERGE" not in str(problem):
            raise
        half = len(paths) // 2
        return schemas_by_spark(spark, paths[:half]) + schemas_by_spark(spark, paths[half:])


def report(files: DataFrame) -> DataFrame:
    """(schema, files, rows, bytes) of a catalogue."""
    return files.groupBy("schema").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))


# the footer reader travels to the executors by value: a cluster needs no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
