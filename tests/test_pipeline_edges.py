"""Hand-made fixtures with the edge rows listed in FIXTURES.md, run through
the pipeline functions (weather, taxi, bike, sensor, merged-trip cleaning)."""

import datetime as dt

from pyspark.sql import functions as F

from tripwx.plans import merge, sensor, trips, weather

W_SCHEMA = ("time string, `temperature_2m (°C)` double, `precipitation (mm)` double, `rain (mm)` double, "
            "`cloudcover (%)` double, `cloudcover_low (%)` double, `cloudcover_mid (%)` double, "
            "`cloudcover_high (%)` double, `windspeed_10m (km/h)` double, `winddirection_10m (°)` double")


def _w(time, temp_c=10.0, cloud=50.0, wind=10.0, direction=180.0, precip=0.0, rain=0.0):
    return (time, temp_c, precip, rain, cloud, 1.0, 2.0, 3.0, wind, direction)


def test_weather_cleaning_edges(spark):
    rows = [
        _w("2019-12-01T00:00"),                       # keep, WINTER
        _w("2019-02-01T01:00", cloud=100.0),          # keep (closed range)
        _w("2019-02-01T02:00", cloud=100.01),         # cloud above 100
        _w("2019-02-01T03:00", direction=360.0),      # keep
        _w("2019-02-01T04:00", direction=360.01),     # direction above 360
        _w("2019-02-01T05:00", temp_c=-28.9),         # -20.02 F: below -20
        _w("2019-02-01T06:00", temp_c=46.1),          # 114.98 F: keep
        _w("2019-02-01T07:00", temp_c=46.2),          # 115.16 F: above 115
        _w("2019-02-01T08:00", temp_c=None),          # NULL temperature
        _w("not a time"),                             # unparsable timestamp
        _w("2019-02-01T09:00", rain=-0.1),            # negative rain
    ]
    raw = spark.createDataFrame(rows, W_SCHEMA)
    out = weather.cleaned(raw).orderBy("timestamp").collect()
    assert [r["timestamp"].hour for r in out] == [1, 3, 6, 0]
    assert out[2]["temp_f"] == 114.98
    funnel = {r["stage"]: r["rows"] for r in weather.funnel(raw).collect()}
    assert funnel["input"] == 11 and funnel["not_null"] == 9 and funnel["hour_range"] == 4
    pub = weather.published(raw, 2019).collect()
    assert {r["season"] for r in pub} == {"WINTER"} and all(r["time_hours"] is not None for r in pub)


def test_taxi_edges(spark):
    t0 = dt.datetime(2019, 1, 1, 10, 0, 0)
    raw = spark.createDataFrame([
        (t0, t0 + dt.timedelta(minutes=10), 2.5, 1),
        (None, t0, 1.0, 2),                               # NULL pickup
        (t0, t0 - dt.timedelta(minutes=5), 1.0, 999),     # dropoff before pickup, unknown zone
    ], "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, trip_distance double, PULocationID int")
    zones = spark.createDataFrame([("1", "-73.9", "40.7"), ("2", None, None)], "LocationID string, x string, y string")
    out = {r["distance"]: r for r in trips.taxi_trips(raw, zones).collect()}
    assert out[2.5]["trip_duration"] == 600.0 and out[2.5]["start_longitude"] == -73.9
    assert out[2.5]["date"] == dt.date(2019, 1, 1) and out[2.5]["time_hours"] == 10
    assert out[1.0]["trip_duration"] in (-300.0, None)
    lengths = trips.taxi_with_lengths(raw).collect()
    assert len(lengths) == 2 and sorted(r["trip_time_length"] for r in lengths) == [-300, 600]
    assert {r["tpep_pickup_datetime"] for r in lengths} == {"2019-01-01 10:00:00"}


def test_bike_edges(spark):
    schema = ("tripduration int, starttime timestamp, stoptime timestamp, `start station name` string, "
              "`start station latitude` double, `start station longitude` double, `end station name` string, "
              "`end station latitude` double, `end station longitude` double, bikeid int, usertype string")
    t0 = dt.datetime(2019, 6, 1, 8, 30)
    raw = spark.createDataFrame([
        (600, t0, t0, " Broadway ", 40.7, -73.9, "X", 40.7, -73.9, 1, "Subscriber"),   # same point
        (900, t0, t0, "A", 40.7, -73.9, "B", 40.8, -73.9, None, "Customer"),          # NULL unused column
    ], schema)
    all_scope = trips.bike_trips(raw).collect()
    assert len(all_scope) == 1 and all_scope[0]["distance"] == 0.0 and all_scope[0]["is_taxi"] == 0
    used = trips.bike_trips(raw, dropna_scope="used", duration_unit="min").collect()
    assert len(used) == 2 and sorted(r["trip_duration"] for r in used) == [10.0, 15.0]
    prof = trips.bike_profiled(raw).collect()
    assert prof[0]["start station name"] == "broadway" and [r["is_subscriber"] for r in prof] == [1, 0]


def test_sensor_edges(spark):
    raw = spark.createDataFrame([
        ("s1", "pole", 80.004, "07/04/2019", 23, 40.7, -73.9, 2019, "  queens ", "QN01"),
        ("s2", "pole", 131.0, "07/04/2019", 1, 40.7, -73.9, 2019, "Bronx", "BX01"),    # too hot
        ("s3", "pole", 70.0, "07/04/2019", 24, 40.7, -73.9, 2019, "Bronx", "BX01"),    # hour 24
        ("s4", "pole", 70.0, "13/45/2019", 2, 40.7, -73.9, 2019, "Bronx", "BX01"),     # bad day
    ], "`Sensor.ID` string, `Install.Type` string, AirTemp double, Day string, Hour int, Latitude double, "
       "Longitude double, Year int, Borough string, ntacode string")
    c = sensor.cleaned(raw)
    assert c.columns[0] == "airtemp" and c.count() == 1
    e = sensor.enriched(c, 2019).first()
    assert (e["borough"], e["isHot"], e["day_iso"], e["airtemp"]) == ("QUEENS", 1, "2019-07-04", 80.0)


def test_merged_trip_rule_boundaries(spark):
    base = dict(date=dt.date(2019, 3, 1), time_hours=5, start_longitude=-74.0, start_latitude=40.7,
                trip_duration=100.0, distance=1.0, is_taxi=1, temp_f=None, precipitation_mm=None, rain_mm=1.0,
                cloudcover_pct=1.0, windspeed_kmh=1.0, wind_direction_deg=1.0)
    cases = [({}, True), ({"trip_duration": 0.0}, False), ({"trip_duration": 86399.0}, True),
             ({"trip_duration": 86400.0}, False), ({"distance": -1.0}, False), ({"distance": 0.0}, True),
             ({"distance": 199.99}, True), ({"distance": 200.0}, False), ({"start_latitude": 39.99}, False),
             ({"start_latitude": 40.0}, True), ({"start_latitude": 41.5}, True), ({"start_latitude": 41.51}, False),
             ({"start_longitude": -74.5}, True), ({"start_longitude": -73.0}, True),
             ({"start_longitude": -72.99}, False), ({"date": dt.date(2020, 1, 1)}, False)]
    rows = [dict(base, **chg) for chg, _ in cases]
    cols = list(base)
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows],
                               "date date, time_hours int, start_longitude double, start_latitude double, "
                               "trip_duration double, distance double, is_taxi int, temp_f double, "
                               "precipitation_mm double, rain_mm double, cloudcover_pct double, "
                               "windspeed_kmh double, wind_direction_deg double")
    out = merge.clean_impute(df, 2019)
    assert out.count() == sum(1 for _, keep in cases if keep)
    r = out.first()
    assert r["temp_f"] is None and r["rain_mm"] == 1.0          # all-NULL column stays NULL, no crash
    assert r["month"] == 3 and r["month_segment"] == "early"
    strict = merge.clean_strict(df.withColumn("temp_f", F.lit(50.0)).withColumn("precipitation_mm", F.lit(0.0)))
    # strict: no upper duration/distance bound and no year filter; 5 rows break its rules
    assert strict.count() == 11
