"""Lineage cuts: intermediate results written as Parquet to the shared folder."""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession

from tripwx.session import scratch_path


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session has ended: the folder stays for its owner to clear
        pass


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back.

    A lost executor then costs a re-read, never a recomputation, and every
    consumer sees the same rows.  The folder goes when the driver ends."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    atexit.register(_delete, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the folder of a ``cut`` that nothing reads any more."""
    for path in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        _delete(df.sparkSession, path)
