"""File catalogue (footers by one distributed job, incremental, planning
without footer reads) and versioned datasets (whole versions after any failure)."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader

from tripwx.operators.schema import ColumnSpec
from tripwx.sources import catalogue, versions
from tripwx.sources import parquet as pq

SPECS = [ColumnSpec("id", "bigint"), ColumnSpec("n", "double")]


def drifting(spark, base, files=12):
    """Files in turn with an int, a text, a double and no column n."""
    kinds = [F.col("id").cast("int"), F.concat(F.lit(""), "id"), F.col("id") / 2, None]
    for i in range(files):
        part = spark.range(i * 10, i * 10 + 10)
        kind = kinds[i % 4]
        (part if kind is None else part.withColumn("n", kind)).coalesce(1).write.parquet(f"{base}/part={i:02d}")


def expected(files=12):
    def n(i, k):
        return [float(k), float(k), k / 2, None][i % 4]
    return sorted(((k, n(k // 10, k)) for k in range(files * 10)), key=str)


def test_catalogue_holds_rows_bytes_and_schemas(spark, tmp_dir):
    drifting(spark, tmp_dir)
    rows = catalogue.catalogue(spark, tmp_dir).collect()
    assert len(rows) == 12 and sum(r.rows for r in rows) == 120 and all(r.bytes > 0 and r.problem is None for r in rows)
    kinds = {tuple(map(tuple, json.loads(r.schema))) for r in rows}
    assert kinds == {(("id", "long"), ("n", t)) for t in ("integer", "string", "double")} | {(("id", "long"),)}


def test_scan_plans_without_a_footer_read(spark, tmp_dir, monkeypatch):
    """Counts the reads that are not given a schema: Spark would open footers for them."""
    drifting(spark, tmp_dir)
    files = sorted(r.path for r in catalogue.list_files(spark, tmp_dir).collect())
    opened = []
    parquet = DataFrameReader.parquet

    def counting(self, *paths, **options):
        if not getattr(self, "_given", False):
            opened.extend(paths)
        return parquet(self, *paths, **options)

    def schema(self, given, keep=DataFrameReader.schema):
        self._given = True
        return keep(self, given)
    monkeypatch.setattr(DataFrameReader, "parquet", counting)
    monkeypatch.setattr(DataFrameReader, "schema", schema)
    df = pq.scan_aligned(spark, files, SPECS)
    assert opened == []
    assert sorted((tuple(r) for r in df.collect()), key=str) == expected()
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 4      # one plan a schema


def test_scan_by_spark_alone(spark, tmp_dir):
    drifting(spark, tmp_dir, 8)
    files = sorted(r.path for r in catalogue.list_files(spark, tmp_dir).collect())
    df = pq.scan_aligned(spark, files, SPECS, strategy="spark")
    assert sorted((tuple(r) for r in df.collect()), key=str) == expected(8)


def test_update_reads_only_what_is_new(spark, tmp_dir, monkeypatch):
    drifting(spark, f"{tmp_dir}/data", 4)
    asked = []

    def counting(files, real=catalogue.footers):
        asked.append(sorted(r.path.split("part=")[1][:2] for r in files.select("path").collect()))
        return real(files)
    monkeypatch.setattr(catalogue, "footers", counting)
    at = f"{tmp_dir}/catalogue"
    assert catalogue.update(spark, at, f"{tmp_dir}/data").count() == 4
    spark.range(5).coalesce(1).write.parquet(f"{tmp_dir}/data/part=99")
    spark.range(7).coalesce(1).write.mode("overwrite").parquet(f"{tmp_dir}/data/part=00")
    rows = catalogue.update(spark, at, f"{tmp_dir}/data").collect()
    assert sorted(r.rows for r in rows) == [5, 7, 10, 10, 10]
    assert asked == [["00", "01", "02", "03"], ["00", "99"]]


def test_types_without_spark_metadata(spark, tmp_dir):
    """Files of other writers: types from the Parquet schema; nested ones are left to Spark."""
    import datetime as dt
    import os

    import pyarrow as pa
    import pyarrow.parquet as arrow_parquet
    os.makedirs(tmp_dir)
    table = pa.table({"a": pa.array([1], pa.uint32()), "b": pa.array(["x"]), "c": pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("us")),
                      "d": pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("us", "UTC")), "e": pa.array([None], pa.decimal128(9, 2)),
                      "f": pa.array([dt.date(2024, 1, 1)]), "g": pa.array([b"x"]), "h": pa.array([1.5], pa.float32())})
    arrow_parquet.write_table(table, f"{tmp_dir}/plain.parquet")
    arrow_parquet.write_table(pa.table({"n": [[1, 2]]}), f"{tmp_dir}/nested.parquet")
    groups = catalogue.schema_groups(catalogue.catalogue(spark, tmp_dir))
    known = {paths[0].rsplit("/", 1)[1]: found for found, paths in groups}
    spark_says = spark.read.parquet(f"{tmp_dir}/plain.parquet").schema
    types = dict((f.name, f.dataType.simpleString()) for f in known["plain.parquet"].fields)
    own = dict((f.name, f.dataType.simpleString()) for f in spark_says.fields)
    assert types == own and types["e"] == "decimal(9,2)"
    assert known["nested.parquet"] is None


def test_broken_file_is_an_error(spark, tmp_dir):
    drifting(spark, tmp_dir, 2)
    p, fs = versions._fs(spark, f"{tmp_dir}/part=55/broken.parquet")
    out = fs.create(p)
    out.write(bytearray(b"no parquet"))
    out.close()
    files = catalogue.catalogue(spark, tmp_dir)
    assert files.filter("problem IS NOT NULL").count() == 1
    with pytest.raises(ValueError, match="broken.parquet"):
        catalogue.schema_groups(files)


# ---------------------------------------------------------------- versions
def numbers(spark, at):
    return sorted(r[0] for r in versions.read(spark, at).collect())


def test_a_job_replaces_what_it_reads(spark, tmp_dir):
    assert not versions.exists(spark, tmp_dir)
    assert versions.publish(spark.range(10), tmp_dir) == 1
    assert versions.publish(versions.read(spark, tmp_dir).filter("id % 2 = 0"), tmp_dir, expected_rows=5) == 2
    assert numbers(spark, tmp_dir) == [0, 2, 4, 6, 8]
    assert versions.read(spark, tmp_dir, 1).count() == 10
    versions.publish(spark.range(1), tmp_dir)
    assert [c["number"] for c in versions.commits(spark, tmp_dir)] == [2, 3]          # the third publish keeps two
    with pytest.raises(ValueError, match="no version 1"):
        versions.read(spark, tmp_dir, 1)
    with pytest.raises(RuntimeError, match="holds 3 rows, not 4"):
        versions.publish(spark.range(3), tmp_dir, expected_rows=4)
    assert numbers(spark, tmp_dir) == [0] and len(versions.orphans(spark, tmp_dir)) == 1


@pytest.mark.parametrize("step", ["write_version", "commit", "_create", "vacuum"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_failure_between_any_two_steps_leaves_a_whole_version(spark, tmp_dir, monkeypatch, step, when):
    versions.publish(spark.range(3), tmp_dir)
    real = getattr(versions, step)

    def failing(*args, **kwargs):
        if when == "after":
            real(*args, **kwargs)
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(versions, step, failing)
        with pytest.raises(OSError, match="lost"):
            versions.publish(versions.read(spark, tmp_dir).selectExpr("id + 10 AS id"), tmp_dir)
    committed = step == "vacuum" or (step in ("commit", "_create") and when == "after")
    assert numbers(spark, tmp_dir) == ([10, 11, 12] if committed else [0, 1, 2])
    versions.publish(versions.read(spark, tmp_dir).selectExpr("id + 100 AS id"), tmp_dir)
    assert numbers(spark, tmp_dir) == ([110, 111, 112] if committed else [100, 101, 102])


def test_two_writers_and_a_half_written_commit(spark, tmp_dir):
    versions.publish(spark.range(2), tmp_dir)
    ours, theirs = (versions.write_version(spark.range(n), tmp_dir) for n in (3, 4))
    versions.commit(spark, tmp_dir, ours, 1, 3)
    with pytest.raises(versions.CommitConflict):
        versions.commit(spark, tmp_dir, theirs, 1, 4)
    assert numbers(spark, tmp_dir) == [0, 1, 2]
    versions._create(spark, f"{tmp_dir}/commits/{3:012d}", '{"number": 3, "folder": "nowhere"')
    assert numbers(spark, tmp_dir) == [0, 1, 2]
    assert versions.orphans(spark, tmp_dir) == [theirs]


def test_paths_of_all_kinds():
    """Names inside a store; one connection a place."""
    made = []

    class Stores:
        LocalFileSystem = staticmethod(lambda: "local")

        class FileSystem:
            @staticmethod
            def from_uri(uri):
                made.append(uri)
                return uri.split("/")[2], None
    stores = {}
    ask = ["file:/a/b c.parquet", "/a/b.parquet", "file:///a/b.parquet", "s3a://bucket/x/y=1/z", "s3://bucket/k", "hdfs://host:8020/p/q"]
    assert [catalogue._opened(Stores, stores, p) for p in ask] == [
        ("local", "/a/b c.parquet"), ("local", "/a/b.parquet"), ("local", "/a/b.parquet"),
        ("bucket", "bucket/x/y=1/z"), ("bucket", "bucket/k"), ("host:8020", "/p/q")]
    assert made == ["s3://bucket/x/y=1/z", "hdfs://host:8020/p/q"]
