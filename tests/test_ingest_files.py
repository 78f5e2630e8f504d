"""Folders that the source queries write grow in files, not in rows a file."""

import glob

import pytest
from pyspark.sql import functions as F

from tripwx.plans import q_io

ROWS = 95


@pytest.fixture()
def tables(spark, tmp_dir):
    n, day = F.col("id"), F.lit("2019-03-01 00:00:00").cast("timestamp_ntz")
    made = {
        "lineitem": [n.alias("l_orderkey"), n.alias("l_partkey"), (n % 20 + 1).alias("l_suppkey"), (n % 7 + 1).cast("int").alias("l_linenumber"),
                     (n % 50 + 1).cast("double").alias("l_quantity"), (n * 100.0).alias("l_extendedprice"), F.lit(0.05).alias("l_tax"),
                     day.alias("l_shipdate")],
        "orders": [n.alias("o_orderkey"), n.alias("o_custkey"), day.alias("o_orderdate"), (n * 1000.0 + 50000).alias("o_totalprice"),
                   F.lit("1-URGENT").alias("o_orderpriority")],
        "customer": [n.alias("c_custkey"), F.concat(F.lit("C"), n).alias("c_name"), F.lit("BUILDING").alias("c_mktsegment")],
        "supplier": [n.alias("s_suppkey"), (n % 5).alias("s_nationkey"), F.concat(F.lit("S"), n).alias("s_name")]}
    for name, columns in made.items():
        spark.range(ROWS).select(*columns).write.parquet(f"{tmp_dir}/{name}.parquet")
    return tmp_dir


def test_source_folders_grow_in_files(spark, tables, monkeypatch):
    monkeypatch.setattr(q_io, "FILE_ROWS", 10, raising=False)
    folders = {}

    def scratch(spark, label):
        folders[label] = f"{tables}/{label}"
        return folders[label]
    monkeypatch.setattr(q_io, "scratch_path", scratch)
    assert q_io.q_scan_glob(spark, tables).count() == ROWS
    assert q_io.q_pipeline_ingest(spark, tables).count() > 0
    assert q_io.q_scan_csv_glob(spark, tables).count() > 0
    for folder, kind in (("glob", "parquet"), ("ingest/taxi_raw", "parquet"), ("ingest/bike_raw", "csv"), ("bike_csv", "csv")):
        files = glob.glob(f"{tables.removeprefix('file:')}/{folder}/*.{kind}")
        # every file is bounded, so their number follows the rows
        assert len(files) >= ROWS / 10, folder
        reader = spark.read.option("header", "true").format(kind)
        assert max(reader.load(f).count() for f in files) <= 10, folder
