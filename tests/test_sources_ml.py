import pytest
from pyspark.sql import functions as F

from tripwx.operators import ml
from tripwx.operators.schema import ColumnSpec
from tripwx.sources import csv as csv_src
from tripwx.sources import parquet as pq
from tripwx.sources import sinks


def test_scan_aligned_both_strategies(spark, tmp_dir):
    spark.createDataFrame([(1, 2)], "a bigint, n int").write.parquet(f"{tmp_dir}/x")
    spark.createDataFrame([(2, 2.5)], "a bigint, n double").write.parquet(f"{tmp_dir}/y")
    spark.createDataFrame([(3,)], "a bigint").write.parquet(f"{tmp_dir}/z")
    files = [f for d in "xyz" for f in pq.discover(spark, f"{tmp_dir}/{d}")]
    specs = [ColumnSpec("a", "bigint"), ColumnSpec("n", "double")]
    one = sorted(map(tuple, pq.scan_aligned(spark, files, specs).collect()))
    per = sorted(map(tuple, pq.scan_aligned(spark, files, specs, strategy="schema").collect()))
    assert one == per == [(1, 2.0), (2, 2.5), (3, None)]


def test_scan_aligned_wide_drift(spark, tmp_dir):
    for name, ddl, rows in [("i", "a int, n int", [(1, 1)]), ("l", "a bigint, n bigint", [(2, 2)]), ("d", "a double, n double", [(3.0, 2.5)]),
                            ("t", "a string, n string", [("4", "x")]), ("m", "a bigint", [(5,)])]:
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_dir}/{name}")
    files = [f for d in "ildtm" for f in pq.discover(spark, f"{tmp_dir}/{d}")]
    got = pq.scan_aligned(spark, files, [ColumnSpec("a", "bigint"), ColumnSpec("n", "double")])
    assert sorted(map(tuple, got.collect())) == [(1, 1.0), (2, 2.0), (3, 2.5), (4, None), (5, None)]


def test_lookup_csv_by_header(spark, tmp_dir):
    before = spark.conf.get("spark.sql.csv.parser.columnPruning.enabled")
    spark.createDataFrame([("latitude,longitude,LocationID",), ("40.7,-73.9,1",)], "value string").coalesce(1).write.text(f"{tmp_dir}/zz")
    row = csv_src.scan_lookup_csv(spark, f"{tmp_dir}/zz", ["LocationID", "latitude"]).first()
    assert (row.LocationID, row.latitude) == ("1", "40.7")
    assert spark.conf.get("spark.sql.csv.parser.columnPruning.enabled") == before


def test_bike_text_that_is_no_time(spark):
    from tripwx.plans import trips
    ddl = ("tripduration int, starttime string, stoptime string, `start station name` string, `start station latitude` double, "
           "`start station longitude` double, `end station name` string, `end station latitude` double, "
           "`end station longitude` double, bikeid int, usertype string")
    rows = [(60, t, t, " A ", 40.7, -73.9, "B", 40.8, -73.8, 1, "Subscriber")
            for t in ("2024-01-02 03:04:05", "not a time", "2024-01-02T03:04:05")]
    df = spark.createDataFrame(rows, ddl)
    assert trips.bike_trips(df).count() == 2
    assert [r.starttime is None for r in trips.bike_profiled(df).collect()] == [False, True, False]


def test_external_table_elsewhere(spark, tmp_dir):
    from tripwx.sources import sinks
    spark.range(3).write.parquet(f"{tmp_dir}/one")
    spark.range(9).write.parquet(f"{tmp_dir}/two")
    sinks.external_parquet_table(spark, "elsewhere_t", "id bigint", f"{tmp_dir}/one")
    sinks.external_parquet_table(spark, "elsewhere_t", "id bigint", f"{tmp_dir}/one")
    with pytest.raises(ValueError):
        sinks.external_parquet_table(spark, "elsewhere_t", "id bigint", f"{tmp_dir}/two")
    spark.sql("DROP TABLE elsewhere_t")


def test_safe_overwrite_keeps_partitions(spark, tmp_dir):
    from tripwx.sources import sinks
    path = f"{tmp_dir}/parts"
    spark.range(20).selectExpr("id", "id % 4 AS date").write.partitionBy("date").parquet(path)
    assert sinks.safe_overwrite(spark.read.parquet(path).where("id > 3"), path) == 16
    with pytest.raises(RuntimeError):
        sinks.safe_overwrite(spark.read.parquet(path), path, expected_rows=3)
    assert sinks.partition_columns(spark, path) == ["date"]
    assert spark.read.parquet(path).where("date = 1").count() == 4


def test_perfect_prediction_scores_one(spark):
    m = ml.metrics(spark.createDataFrame([(1, 1.0), (0, 0.0), (0, 0.0)], "is_taxi int, prediction double")).first()
    assert (m["accuracy"], m["weighted_f1"]) == (1.0, 1.0)


def test_discover_errors(spark, tmp_dir):
    with pytest.raises(ValueError):
        pq.discover(spark, f"{tmp_dir}/missing")
    spark.createDataFrame([("t",)], "v string").write.text(f"{tmp_dir}/texts")
    with pytest.raises(ValueError):
        pq.discover(spark, f"{tmp_dir}/texts")


def test_lookup_csv_quotes_and_short_rows(spark, tmp_dir):
    lines = ["LocationID,Zone,longitude,latitude", '1,"Upper, ""East""",-73.9,40.7', "2,Short",
             '3,"Plain",,']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_dir}/z")
    rows = csv_src.scan_lookup_csv(spark, f"{tmp_dir}/z", ["LocationID", "Zone", "longitude", "latitude"]).collect()
    assert [r["LocationID"] for r in rows] == ["1", "3"]
    assert rows[0]["Zone"] == 'Upper, "East"' and rows[1]["longitude"] is None


def test_safe_overwrite_in_place(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.range(10).write.parquet(path)
    n = sinks.safe_overwrite(spark.read.parquet(path).filter("id % 2 = 0"), path)
    assert n == 5 and spark.read.parquet(path).count() == 5


def test_balance_and_split_are_reproducible(spark):
    df = spark.createDataFrame([(i, 1 if i % 4 else 0) for i in range(2000)], "k int, is_taxi int")
    a = ml.balance_classes(df, "is_taxi", ["k"])
    b = ml.balance_classes(df.repartition(7), "is_taxi", ["k"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    counts = ml.class_counts(a)
    assert abs(counts[1] - counts[0]) < 100
    s = ml.split_hash(a, ["k"])
    frac = s.filter(F.col("split") == "train").count() / s.count()
    assert 0.75 < frac < 0.85
    sampled = ml.balance_classes(df, "is_taxi", method="sample")
    assert ml.class_counts(sampled)[0] == 500


def test_metrics_match_evaluator(spark):
    rows = [(1, 1.0)] * 50 + [(1, 0.0)] * 10 + [(0, 0.0)] * 30 + [(0, 1.0)] * 20
    pred = spark.createDataFrame(rows, "is_taxi int, prediction double")
    m = ml.metrics(pred).first()
    ev = ml.evaluate(pred.withColumn("is_taxi", F.col("is_taxi").cast("double")))
    assert abs(m["accuracy"] - ev["accuracy"]) < 1e-12
    assert abs(m["weighted_f1"] - ev["f1"]) < 1e-12
    assert m["rows"] == 110


def test_string_indexer_frequency_then_alphabet(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "s string")
    model = ml.string_indexer("s", "i").fit(df)
    got = {r["s"]: r["i"] for r in model.transform(df).collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_score_keeps_unscored_rows(spark):
    rows = []
    for i in range(400):
        taxi = i % 2
        rows.append((-73.9 - 0.01 * (i % 7), 40.7 + 0.01 * (i % 5), 1.0 + (5.0 if taxi else 0.0) + (i % 3),
                     i % 24, 50.0 + i % 30, 0.0, ["WINTER", "SPRING"][i % 2], "1 - Light Air", taxi))
    schema = ("start_longitude double, start_latitude double, distance double, time_hours int, temp_f double, "
              "precipitation_mm double, season string, beaufort_scale string, is_taxi int")
    train = spark.createDataFrame(rows, schema)
    model = ml.pipeline(num_trees=5, max_depth=3).fit(train)
    new = spark.createDataFrame([(-73.95, 40.75, 2.0, 12, 70.0, 0.0, "AUTUMN", "2 - Light Breeze", 0),
                                 (-73.95, 40.75, 6.0, 12, 70.0, 0.0, "SPRING", "1 - Light Air", 1),
                                 (-73.95, None, 6.0, 12, 70.0, 0.0, "SPRING", "1 - Light Air", 1)], schema)
    assert ml.score(model, new).count() == 1                      # published behaviour: silently skipped
    out = {r["season"] + str(r["start_latitude"]): r for r in ml.score(model, new, keep_unscored=True).collect()}
    assert len(out) == 3
    assert out["AUTUMN40.75"]["predicted_mode"] == "UNSCORED" and out["AUTUMN40.75"]["prediction"] is None
    assert out["SPRINGNone"]["predicted_mode"] == "UNSCORED"
    assert out["SPRING40.75"]["predicted_mode"] in ("YELLOW TAXI", "CITIBIKE")


def test_partitioned_write_bounds_files_per_value(spark, tmp_dir):
    import glob
    import os
    df = spark.range(3000).selectExpr("id", "CAST(id % 3 AS INT) AS d").repartition(12)
    sinks.write_parquet(df, f"{tmp_dir}/p", partition_by=["d"], files_per_value=2)
    for d in range(3):
        files = glob.glob(os.path.join(f"{tmp_dir}/p", f"d={d}", "*.parquet"))
        assert 1 <= len(files) <= 2
    assert spark.read.parquet(f"{tmp_dir}/p").count() == 3000


def test_partitioned_write_rebalanced(spark, tmp_dir):
    df = spark.range(3000).selectExpr("id", "CAST(id % 3 AS INT) AS d").repartition(12)
    sinks.write_parquet(df, f"{tmp_dir}/r", partition_by=["d"])
    back = spark.read.parquet(f"{tmp_dir}/r")
    assert back.count() == 3000 and back.select("d").distinct().count() == 3


def test_year_filter_prunes_date_partitions(spark, tmp_dir):
    import datetime as dt
    from tripwx.functions import columns as C
    rows = [(dt.date(2018 + i % 3, 1 + i % 12, 1), float(i)) for i in range(60)]
    sinks.write_parquet(spark.createDataFrame(rows, "date date, v double"), f"{tmp_dir}/m", partition_by=["date"])
    df = spark.read.parquet(f"{tmp_dir}/m").filter(C.year_range("date", 2019))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2019-01-01" in plan
    assert df.count() == 20


def test_safe_overwrite_keeps_old_output_when_write_fails(spark, tmp_dir):
    path = f"{tmp_dir}/keep"
    spark.range(7).write.parquet(path)
    bad = spark.read.parquet(path).withColumn(
        "boom", F.when(F.col("id") == 3, F.raise_error(F.lit("fail on purpose"))).otherwise(F.lit("ok")))
    with pytest.raises(Exception):
        sinks.safe_overwrite(bad, path)
    assert spark.read.parquet(path).count() == 7      # the old output is untouched
