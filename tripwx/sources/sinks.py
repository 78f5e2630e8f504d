"""Sinks and catalog: Parquet / CSV writes, managed and external tables,
and an in-place overwrite that survives a failed write."""

from __future__ import annotations

import contextlib
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  max_records_per_file: int | None = None, files_per_value: int | None = None,
                  rebalance: bool = True) -> str:
    """K1: overwrite a Parquet folder.  Large tables are written in parallel
    (optionally partitioned, e.g. by date, for partition pruning later),
    never funnelled through one task.

    Written straight from a scan, every task would write one file per
    partition value it holds (tasks x values files).  By default a
    partitioned write is first rebalanced on the partition columns (AQE's
    REBALANCE: partitions sized to the advisory size, a skewed value split
    over several tasks).  ``files_per_value=k`` instead shuffles rows by
    (partition values, row hash mod k): at most k files per value, a hot
    value still spread over k tasks."""
    if partition_by and files_per_value:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_value))
        df = df.repartition(*[F.col(c) for c in partition_by], salt)
    elif partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)
    return path


def write_single_file(df: DataFrame, path: str, fmt: str = "parquet", header: bool = True) -> str:
    """K2/K3: one output file.  Only for small results (aggregates, lookups,
    hourly rows): the work before runs in parallel, one task writes."""
    w = df.repartition(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", str(header).lower()).csv(path)
    else:
        w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, max_records_per_file: int | None = None) -> str:
    """K4: multi-file CSV with header, written in parallel."""
    w = df.write.mode("overwrite").option("header", str(header).lower())
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.csv(path)
    return path


def write_many(df: DataFrame, targets: list[tuple[str, str]]) -> None:
    """One result to several (format, path) targets, computed once."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for fmt, path in targets:
            if fmt == "csv":
                write_csv(df, path)
            else:
                write_parquet(df, path)
    finally:
        df.unpersist()


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """K8: CREATE DATABASE IF NOT EXISTS (optionally at a location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def save_table(df: DataFrame, table: str, drop_first: bool = True) -> str:
    """K5/K7: (drop and) overwrite a managed table."""
    spark = df.sparkSession
    if drop_first:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    df.write.mode("overwrite").saveAsTable(table)
    return table


def bucketed_table(df: DataFrame, table: str, keys: list[str], buckets: int, path: str) -> str:
    """Store ``df`` as an external table in ``buckets`` files, dealt and
    sorted by ``keys``.  Tables stored alike join and aggregate on the keys
    without a shuffle, every time; only this write shuffles.  All rows of one key
    are one file, so pick keys of which none holds more rows than a task can sort."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    dealt = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return table


def external_parquet_table(spark: SparkSession, table: str, ddl_columns: str, location: str) -> DataFrame:
    """Declare a table over an existing Parquet folder and describe
    it.  A table of that name over another folder is an error."""
    if spark.catalog.tableExists(table):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
        there = rows[0]["data_type"] if rows else ""
        if _plain(there) != _plain(location):
            raise ValueError(f"table {table} exists over {there}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl_columns}) USING parquet LOCATION '{location}'")
    return spark.sql(f"DESCRIBE TABLE {table}")


def _plain(location: str) -> str:
    """A location without ``file:`` and surplus slashes."""
    return "/" + location.removeprefix("file:").strip("/")


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a folder, by its ``name=value`` subfolders."""
    _, p, fs = _fs(spark, path)
    names = []
    while fs.exists(p):
        parts = [s.getPath() for s in fs.listStatus(p) if s.isDirectory() and "=" in s.getPath().getName()]
        if not parts:
            break
        p = parts[0]
        names.append(p.getName().split("=", 1)[0])
    return names


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def safe_overwrite(df: DataFrame, output: str, staging: str | None = None, expected_rows: int | None = None) -> int:
    """K6: replace ``output`` with ``df`` even when ``df`` reads ``output``.

    The result is first written to a staging folder next to the output,
    partitioned as the old output is, and its row count read back from the
    written files (it must be ``expected_rows``, if the caller knows them);
    only then is the old output renamed aside, the staging folder renamed
    into place and the old copy deleted.  (An ``Observation`` would count
    while writing, but a session that holds one cannot ship ML models.)  A failure before the swap leaves the old output
    intact; a failed rename raises.  Returns the rows written.
    """
    spark = df.sparkSession
    staging = staging or f"{output.rstrip('/')}__staging_{uuid.uuid4().hex[:8]}"
    _, out_p, fs = _fs(spark, output)
    _, stage_p, _ = _fs(spark, staging)
    _, old_p, _ = _fs(spark, f"{output.rstrip('/')}__old_{uuid.uuid4().hex[:8]}")
    if fs.exists(stage_p):
        fs.delete(stage_p, True)
    write_parquet(df, staging, partition_by=[c for c in partition_columns(spark, output) if c in df.columns] or None)
    rows = spark.read.parquet(staging).count()
    if expected_rows is not None and rows != expected_rows:
        raise RuntimeError(f"{staging} holds {rows} rows, not {expected_rows}")
    had_old = fs.exists(out_p)
    if had_old and not fs.rename(out_p, old_p):
        raise RuntimeError(f"{output} could not be renamed; nothing was changed")
    if not fs.rename(stage_p, out_p):
        if had_old:
            fs.rename(old_p, out_p)
        raise RuntimeError(f"{staging} could not take the place of {output}")
    if had_old:
        fs.delete(old_p, True)
    return rows


@contextlib.contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep a frame for several actions, release it afterwards."""
    df = df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
