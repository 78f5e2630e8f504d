import datetime as dt
import math

from pyspark.sql import functions as F

from tripwx.functions import columns as C


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_beaufort_closed_bands_leave_gaps(spark):
    df = spark.createDataFrame([(w,) for w in [0.0, 0.99, 1.0, 5.0, 5.5, 6.0, 117.5, 118.0, None]], "w double")
    got = dict(rows(df.select("w", C.beaufort("w").alias("b")), "w", "b"))
    assert got[0.0] == got[0.99] == "0 - Calm"
    assert got[1.0] == got[5.0] == "1 - Light Air"
    assert got[5.5] == "Unknown"          # between the published integer bands
    assert got[6.0] == "2 - Light Breeze"
    assert got[117.5] == "Unknown"
    assert got[118.0] == "12 - Hurricane"
    assert got[None] == "Unknown"


def test_beaufort_contiguous_has_no_gaps(spark):
    df = spark.createDataFrame([(5.5,), (117.5,)], "w double")
    got = dict(rows(df.select("w", C.beaufort("w", contiguous=True).alias("b")), "w", "b"))
    assert got[5.5] == "1 - Light Air"
    assert got[117.5] == "11 - Violent Storm"


def test_season_months_and_null(spark):
    df = spark.createDataFrame([(m,) for m in [12, 1, 2, 3, 6, 9, None]], "m int")
    got = dict(rows(df.select("m", C.season("m").alias("s")), "m", "s"))
    assert got[12] == got[1] == got[2] == "WINTER"
    assert got[3] == "SPRING" and got[6] == "SUMMER" and got[9] == "FALL"
    assert got[None] == "FALL"


def test_temp_bucket_half_away_from_zero(spark):
    df = spark.createDataFrame([(t,) for t in [-12.5, -12.49, 12.5, 2.5, 0.0, None]], "t double")
    got = dict(rows(df.select("t", C.temp_bucket("t").alias("b")), "t", "b"))
    assert got[-12.5] == -15.0 and got[-12.49] == -10.0
    assert got[12.5] == 15.0 and got[2.5] == 5.0 and got[0.0] == 0.0
    assert got[None] is None


def test_round_stable_ignores_ulp_noise(spark):
    df = spark.createDataFrame([(6.155,), (6.154999999999999,), (-6.155,)], "x double")
    got = [r[0] for r in df.select(C.round_stable("x", 2)).collect()]
    assert got == [6.16, 6.16, -6.16]


def test_haversine_same_point_and_antipodes(spark):
    df = spark.createDataFrame([(40.0, -74.0, 40.0, -74.0), (0.0, 0.0, 0.0, 180.0), (40.7, -74.0, 40.8, -73.9)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(C.haversine("a", "b", "c", "d", "km")).collect()]
    assert got[0] == 0.0
    assert math.isclose(got[1], math.pi * C.EARTH_RADIUS_KM, rel_tol=1e-12)
    assert 13.0 < got[2] < 14.5
    mi = df.select(C.haversine("a", "b", "c", "d", "mi")).collect()[2][0]
    assert math.isclose(mi / got[2], C.EARTH_RADIUS_MI / C.EARTH_RADIUS_KM, rel_tol=1e-12)


def test_flags_null_is_zero(spark):
    df = spark.createDataFrame([(80.0, 29.0), (79.99, 28.99), (None, None)], "t double, w double")
    got = rows(df.select(C.is_hot("t").alias("h"), C.is_windy("w").alias("w")), "h", "w")
    assert got == [(1, 1), (0, 0), (0, 0)]


def test_c_to_f_and_month_segment(spark):
    df = spark.createDataFrame([(0.0, 15), (-40.0, 16), (21.3, 1)], "c double, d int")
    got = rows(df.select(C.c_to_f("c").alias("f"), C.month_segment("d").alias("s")), "f", "s")
    assert got == [(32.0, "early"), (-40.0, "late"), (70.34, "early")]


def test_duration_seconds_ntz_and_negative(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10, 0, 0), dt.datetime(2024, 1, 1, 10, 30, 5)),
         (dt.datetime(2024, 1, 1, 10, 0, 0), dt.datetime(2024, 1, 1, 9, 59, 0))],
        "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(C.duration_seconds("a", "b")).collect()]
    assert got == [1805, -60]
    assert [r[0] for r in df.select(C.duration_unit(C.duration_seconds("a", "b"), "min")).collect()][0] == 1805 / 60


def test_calendar_and_iso_formats(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 2, 3, 4, 5, 6),)], "ts timestamp_ntz")
    r = df.select(*[v.alias(k) for k, v in C.calendar_columns("ts").items()],
                  C.iso_minute("ts").alias("m"), C.iso_second("ts").alias("s"), C.iso_date("ts").alias("d")).first()
    assert (r["date"], r["hour"], r["month"], r["year"]) == (dt.date(2019, 2, 3), 4, 2, "2019")
    assert (r["m"], r["s"], r["d"]) == ("2019-02-03T04:05", "2019-02-03 04:05:06", "2019-02-03")


def test_year_range_matches_year_equality(spark):
    df = spark.createDataFrame([(dt.date(2018, 12, 31),), (dt.date(2019, 1, 1),), (dt.date(2019, 12, 31),),
                                (dt.date(2020, 1, 1),), (None,)], "d date")
    assert df.filter(C.year_range("d", 2019)).count() == df.filter(F.year("d") == 2019).count() == 2


def test_text_normalize(spark):
    df = spark.createDataFrame([("  Broadway & W 60 St ",)], "s string")
    r = df.select(C.normalize_lower("s").alias("l"), C.normalize_upper("s").alias("u")).first()
    assert (r["l"], r["u"]) == ("broadway & w 60 st", "BROADWAY & W 60 ST")
