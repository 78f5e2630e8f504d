from pyspark.sql import functions as F

from tripwx.operators import clean, schema
from tripwx.operators.schema import ColumnSpec


def test_align_casts_and_fills_missing(spark):
    df = spark.createDataFrame([(1, "2.5", "x")], "passenger_count int, trip_distance string, other string")
    out = schema.align(df, [ColumnSpec("passenger_count", "double"), ColumnSpec("trip_distance", "double"),
                            ColumnSpec("PULocationID", "bigint")])
    assert out.dtypes == [("passenger_count", "double"), ("trip_distance", "double"), ("PULocationID", "bigint")]
    assert tuple(out.first()) == (1.0, 2.5, None)


def test_align_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("abc",)], "n string")
    assert schema.align(df, [ColumnSpec("n", "double")]).first()[0] is None


def test_case_insensitive_lookup_and_alternatives(spark):
    df = spark.createDataFrame([("7", "1.5", "2.5")], "locationID string, x string, y string")
    assert schema.find_column(df, "LOCATIONID") == "locationID"
    r = df.select(schema.first_present(df, "LocationID", "locationID").alias("id"),
                  schema.first_present(df, "longitude", "x").alias("lon")).first()
    assert (r["id"], r["lon"]) == ("7", "1.5")


def test_rename_and_drop_special_names(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a", "b")], "`temperature_2m (°C)` double, `cloudcover (%)` double, "
                                                        "`Sensor.ID` string, keep string")
    r = schema.rename(df, {"temperature_2m (°C)": "temp_c", "missing": "x"})
    assert r.columns[0] == "temp_c"
    d = schema.drop_columns(r, ["Sensor.ID", "cloudcover (%)", "not_there"])
    assert d.columns == ["temp_c", "keep"]


def test_funnel_matches_sequential_filters(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else float(i)) for i in range(50)], "k int, v double")
    rules = [clean.Rule("v_not_null", F.col("v").isNotNull()), clean.Rule("v_big", F.col("v") > 10),
             clean.Rule("k_even", F.col("k") % 2 == 0)]
    f = {r["stage"]: r["rows"] for r in clean.funnel(df, rules).collect()}
    seq, expected = df, {"input": df.count()}
    for r in rules:
        seq = seq.filter(r.condition)
        expected[r.name] = seq.count()
    assert f == expected


def test_drop_nulls_variants_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "v double, s string")
    assert clean.drop_nulls(df).count() == 1
    assert clean.drop_nulls(df, ["v"]).count() == 2
    assert clean.drop_nulls(df, ["v", "absent"], existing_only=True).count() == 2


def test_impute_mean_and_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    out = clean.impute_mean(df, ["a", "b", "absent"])
    assert [r["a"] for r in out.collect()] == [1.0, 2.0, 3.0]
    assert all(r["b"] is None for r in out.collect())
    exact = clean.impute_mean(df, ["a"], exact_scale=15)
    assert [r["a"] for r in exact.collect()] == [1.0, 2.0, 3.0]
    fine = spark.createDataFrame([(0.004,), (0.004,), (None,)], "a double")
    assert [r["a"] for r in clean.impute_mean(fine, ["a"], exact_scale=15).collect()] == [0.004] * 3


def test_dedup_collapses_hot_duplicate(spark):
    rows = [(1, "x")] * 300 + [(i, "y") for i in range(600)]
    df = spark.createDataFrame(rows, "k int, s string").repartition(8)
    assert clean.dedup(df).count() == 601
