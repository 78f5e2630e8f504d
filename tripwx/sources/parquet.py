"""Parquet sources: plain scan, multi-path scan, dataset discovery, and a
scan that tolerates type drift between files."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from tripwx.operators import schema
from tripwx.operators.schema import ColumnSpec
from tripwx.sources import catalogue


def scan(spark: SparkSession, *paths: str, columns: list[str] | None = None, **options) -> DataFrame:
    """``spark.read.parquet``; a projection given here reaches the scan's
    ReadSchema.  Options Parquet does not know (e.g. CSV's ``header`` or
    ``inferSchema``) are ignored, as Spark ignores them."""
    reader = spark.read
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.parquet(*paths)
    return df.select(*columns) if columns else df


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discover(spark: SparkSession, path: str, suffix: str = ".parquet") -> list[str]:
    """A file -> itself; a folder -> its direct ``*suffix`` files, sorted;
    a missing path or a folder without such files -> ValueError.
    Only file names are listed on the driver, no data is read."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        raise ValueError(f"no such file or folder: {path}")
    if fs.isFile(p):
        return [p.toString()]
    files = sorted(s.getPath().toString() for s in fs.listStatus(p)
                   if s.isFile() and s.getPath().getName().endswith(suffix))
    if not files:
        raise ValueError(f"{path} holds no *{suffix} file")
    return files


def scan_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Folder of Parquet files (non-recursive, only ``*.parquet``)."""
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(*discover(spark, path))


def scan_aligned(spark: SparkSession, paths: list[str], specs: list[ColumnSpec],
                 strategy: str = "groups", files: DataFrame | None = None) -> DataFrame:
    """Read files whose column types drift (int in one, double or text
    in another; a column missing from some) as one table of ``specs``.

    ``strategy="groups"`` takes each file's schema from a catalogue (``files``,
    or one made here by a single distributed job over the footers), reads
    the files of equal schema as one splittable scan, aligns each group with
    ``try_cast`` and unions the groups: the plan grows with the number of
    different schemas, not of files, and the driver reads no footer.
    ``strategy="spark"`` finds the schemas by Spark's reader alone, for stores
    that only Spark reaches.  ``strategy="schema"`` is one scan with the
    declared schema, for drift that the Parquet reader can widen itself.
    """
    if strategy == "schema":
        ddl = ", ".join(f"{schema.quote(s.name)} {s.dtype}" for s in specs)
        return spark.read.schema(ddl).parquet(*paths)
    if strategy == "spark":
        groups = catalogue.schemas_by_spark(spark, paths)
    else:
        groups = catalogue.schema_groups(catalogue.catalogue(spark, *paths) if files is None else files)
    frames = [schema.align((spark.read.schema(found) if found else spark.read).parquet(*group), specs)
              for found, group in groups]
    return functools.reduce(DataFrame.unionByName, frames)
