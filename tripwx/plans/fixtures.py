"""Views that shape the driver's generic tables like the reference's inputs.

Each view exists twice, as a Spark DataFrame builder and as a DuckDB CTE
body (``SQL[name]``), written side by side so they stay equal.  Numbers are
built from integers and divided once, so both engines produce the same
doubles bit for bit; NULLs and out-of-range values are injected by key
modulo so every cleaning rule has something to remove.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's read-only tables; the DataFrame (file listing and
    footer schema) is built once per Spark application and path."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _dbl(c):
    return c.cast("double")


# ---------------------------------------------------------------- v_trips
def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical trip rows: click/view events are taxi trips, purchase/signup
    events are bike trips."""
    e = table(spark, sf_dir, "events").filter(
        F.col("event_type").isin("click", "view", "purchase", "signup"))
    v100 = F.round(F.col("value") * 100).cast("bigint")
    return e.select(
        (_dbl(F.col("user_id") % 20 - 746) / 10).alias("start_longitude"),
        F.when(F.col("event_id") % 23 == 0, F.lit(None).cast("double"))
         .otherwise(_dbl(F.col("event_id") % 20 + 399) / 10).alias("start_latitude"),
        F.hour("ts").cast("int").alias("time_hours"),
        F.to_date("ts").alias("date"),
        F.when(F.col("event_id") % 17 == 0, F.lit(0.0)).otherwise(_dbl(v100 * 2)).alias("trip_duration"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double"))
         .otherwise(_dbl(v100) / 100).alias("distance"),
        F.when(F.col("event_type").isin("click", "view"), 1).otherwise(0).alias("is_taxi"),
    )


SQL_TRIPS = """
SELECT CAST(user_id % 20 - 746 AS DOUBLE) / 10 AS start_longitude,
       CASE WHEN event_id % 23 = 0 THEN CAST(NULL AS DOUBLE)
            ELSE CAST(event_id % 20 + 399 AS DOUBLE) / 10 END AS start_latitude,
       CAST(hour(ts) AS INTEGER) AS time_hours,
       CAST(ts AS DATE) AS date,
       CASE WHEN event_id % 17 = 0 THEN 0.0::DOUBLE
            ELSE CAST(CAST(round(value * 100) AS BIGINT) * 2 AS DOUBLE) END AS trip_duration,
       CASE WHEN event_id % 11 = 0 THEN CAST(NULL AS DOUBLE)
            ELSE CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) / 100 END AS distance,
       CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS is_taxi
FROM events
WHERE event_type IN ('click', 'view', 'purchase', 'signup')
"""


# ---------------------------------------------------------- v_weather_raw
WEATHER_RAW_COLUMNS = [
    "time", "temperature_2m (°C)", "precipitation (mm)", "rain (mm)", "cloudcover (%)",
    "cloudcover_low (%)", "cloudcover_mid (%)", "cloudcover_high (%)",
    "windspeed_10m (km/h)", "winddirection_10m (°)",
]


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly raw weather (open-meteo style column names) from error events."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    v100 = F.round(F.col("value") * 100).cast("bigint")
    g = (e.groupBy(F.to_date("ts").alias("d"), F.hour("ts").alias("h"))
          .agg(F.sum(v100).alias("s"), F.count(F.lit(1)).alias("c"),
               F.min(v100).alias("mn"), F.max(v100).alias("mx")))
    hour_key = F.dayofmonth("d") * 24 + F.col("h")
    return g.select(
        F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit("T"),
                 F.lpad(F.col("h").cast("string"), 2, "0"), F.lit(":00")).alias("time"),
        F.when(hour_key % 31 == 0, F.lit(None).cast("double"))
         .otherwise(_dbl(F.floor(_dbl(F.col("s") - 5700 * F.col("c")) / (18 * F.col("c")))) / 10)
         .alias("temperature_2m (°C)"),
        (_dbl(F.col("mn") % 500) / 100).alias("precipitation (mm)"),
        (_dbl(F.col("mn") % 300 - 10) / 100).alias("rain (mm)"),
        (_dbl(F.col("mx") % 10200) / 100).alias("cloudcover (%)"),
        _dbl(F.col("mx") % 100).alias("cloudcover_low (%)"),
        _dbl(F.col("mx") % 50).alias("cloudcover_mid (%)"),
        _dbl(F.col("mx") % 25).alias("cloudcover_high (%)"),
        (_dbl(F.floor(_dbl(F.col("s")) / (2 * F.col("c")))) / 100).alias("windspeed_10m (km/h)"),
        (_dbl(F.col("mx") * 7 % 37000) / 100).alias("winddirection_10m (°)"),
    )


SQL_WEATHER_RAW = """
SELECT strftime(d, '%Y-%m-%d') || 'T' || lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS "time",
       CASE WHEN (day(d) * 24 + h) % 31 = 0 THEN CAST(NULL AS DOUBLE)
            ELSE CAST(floor(CAST(s - 5700 * c AS DOUBLE) / (18 * c)) AS DOUBLE) / 10 END AS "temperature_2m (°C)",
       CAST(mn % 500 AS DOUBLE) / 100 AS "precipitation (mm)",
       CAST(mn % 300 - 10 AS DOUBLE) / 100 AS "rain (mm)",
       CAST(mx % 10200 AS DOUBLE) / 100 AS "cloudcover (%)",
       CAST(mx % 100 AS DOUBLE) AS "cloudcover_low (%)",
       CAST(mx % 50 AS DOUBLE) AS "cloudcover_mid (%)",
       CAST(mx % 25 AS DOUBLE) AS "cloudcover_high (%)",
       CAST(floor(CAST(s AS DOUBLE) / (2 * c)) AS DOUBLE) / 100 AS "windspeed_10m (km/h)",
       CAST(mx * 7 % 37000 AS DOUBLE) / 100 AS "winddirection_10m (°)"
FROM (SELECT CAST(ts AS DATE) AS d, hour(ts) AS h,
             sum(CAST(round(value * 100) AS BIGINT)) AS s, count(*) AS c,
             min(CAST(round(value * 100) AS BIGINT)) AS mn,
             max(CAST(round(value * 100) AS BIGINT)) AS mx
      FROM events WHERE event_type = 'error' GROUP BY 1, 2) g
"""


# ---------------------------------------------------------------- v_zones
def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup (all strings, as read from CSV) from supplier; every 37th
    zone has no coordinates."""
    s = table(spark, sf_dir, "supplier")
    no_xy = F.col("s_suppkey") % 37 == 0
    return s.select(
        F.col("s_suppkey").cast("string").alias("LocationID"),
        F.concat(F.lit("B"), (F.col("s_nationkey") % 5).cast("string")).alias("Borough"),
        F.when(F.col("s_suppkey") % 13 == 0, F.concat(F.col("s_name"), F.lit(', "Upper"')))
         .otherwise(F.col("s_name")).alias("Zone"),
        F.lit("Boro Zone").alias("service_zone"),
        F.when(no_xy, F.lit(None).cast("string"))
         .otherwise((_dbl(F.col("s_suppkey") % 15 - 745) / 10).cast("string")).alias("longitude"),
        F.when(no_xy, F.lit(None).cast("string"))
         .otherwise((_dbl(F.col("s_suppkey") % 15 + 400) / 10).cast("string")).alias("latitude"),
    )


SQL_ZONES = """
SELECT CAST(s_suppkey AS VARCHAR) AS LocationID,
       'B' || CAST(s_nationkey % 5 AS VARCHAR) AS Borough,
       CASE WHEN s_suppkey % 13 = 0 THEN s_name || ', "Upper"' ELSE s_name END AS Zone,
       'Boro Zone' AS service_zone,
       CASE WHEN s_suppkey % 37 = 0 THEN NULL ELSE CAST(CAST(s_suppkey % 15 - 745 AS DOUBLE) / 10 AS VARCHAR) END AS longitude,
       CASE WHEN s_suppkey % 37 = 0 THEN NULL ELSE CAST(CAST(s_suppkey % 15 + 400 AS DOUBLE) / 10 AS VARCHAR) END AS latitude
FROM supplier
"""


# ------------------------------------------------------------- v_taxi_raw
def taxi_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw yellow-taxi rows from lineitem.  Every 7th line number drops off
    before pickup; DOLocationID etc. exist so that the aligners have
    something to drop.  Pickups at a key ending in 9 lie outside all zones."""
    li = table(spark, sf_dir, "lineitem")
    pickup = (F.col("l_shipdate")
              + F.make_dt_interval(F.lit(0), (F.col("l_orderkey") % 24).cast("int"),
                                   (F.col("l_partkey") % 60).cast("int")))
    mins = F.col("l_quantity").cast("int")
    dropoff = F.when(F.col("l_linenumber") == 7, pickup - F.make_dt_interval(F.lit(0), F.lit(0), mins)) \
               .otherwise(pickup + F.make_dt_interval(F.lit(0), F.lit(0), mins))
    return li.select(
        pickup.alias("tpep_pickup_datetime"),
        dropoff.alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.when(F.col("l_suppkey") % 10 == 9, F.col("l_suppkey") + 1_000_000).otherwise(F.col("l_suppkey")).alias("PULocationID"),
        (F.col("l_partkey") % 265).alias("DOLocationID"),
        (F.col("l_extendedprice") / 100).alias("fare_amount"),
        (F.col("l_tax") * 10).alias("tip_amount"),
        (F.col("l_extendedprice") / 100 + F.col("l_tax") * 10).alias("total_amount"),
    )


SQL_TAXI_RAW = """
SELECT l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) + to_minutes(CAST(l_partkey % 60 AS INTEGER))
         AS tpep_pickup_datetime,
       CASE WHEN l_linenumber = 7
            THEN l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) + to_minutes(CAST(l_partkey % 60 AS INTEGER))
                 - to_minutes(CAST(l_quantity AS INTEGER))
            ELSE l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) + to_minutes(CAST(l_partkey % 60 AS INTEGER))
                 + to_minutes(CAST(l_quantity AS INTEGER)) END AS tpep_dropoff_datetime,
       CAST(l_linenumber AS DOUBLE) AS passenger_count,
       l_quantity AS trip_distance,
       CASE WHEN l_suppkey % 10 = 9 THEN l_suppkey + 1000000 ELSE l_suppkey END AS PULocationID,
       l_partkey % 265 AS DOLocationID,
       l_extendedprice / 100 AS fare_amount,
       l_tax * 10 AS tip_amount,
       l_extendedprice / 100 + l_tax * 10 AS total_amount
FROM lineitem
"""


# ------------------------------------------------------------- v_bike_raw
def bike_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old-format bike rows (column names with spaces) from orders x customer."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    start = (F.col("o_orderdate")
             + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"),
                                  (F.col("o_custkey") % 60).cast("int")))
    dur = F.floor(F.col("o_totalprice") / 100).cast("int")
    return j.select(
        dur.alias("tripduration"),
        start.alias("starttime"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), dur.cast("decimal(18,6)"))).alias("stoptime"),
        F.when(F.col("o_orderkey") % 19 == 0, F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")))
         .otherwise(F.col("c_name")).alias("start station name"),
        (_dbl(F.col("c_custkey") % 15 + 400) / 10).alias("start station latitude"),
        (_dbl(F.col("c_custkey") % 12 - 745) / 10).alias("start station longitude"),
        F.col("c_mktsegment").alias("end station name"),
        (_dbl(F.col("o_orderkey") % 15 + 400) / 10).alias("end station latitude"),
        (_dbl(F.col("o_orderkey") % 12 - 745) / 10).alias("end station longitude"),
        F.when(F.col("o_orderkey") % 29 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("o_orderkey")).alias("bikeid"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Subscriber")
         .otherwise("Customer").alias("usertype"),
    )


SQL_BIKE_RAW = """
SELECT tripduration, starttime, starttime + to_seconds(tripduration) AS stoptime,
       "start station name", "start station latitude", "start station longitude",
       "end station name", "end station latitude", "end station longitude", bikeid, usertype
FROM (
  SELECT CAST(floor(o_totalprice / 100) AS INTEGER) AS tripduration,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + to_minutes(CAST(o_custkey % 60 AS INTEGER)) AS starttime,
         CASE WHEN o_orderkey % 19 = 0 THEN '  ' || upper(c_name) || ' ' ELSE c_name END AS "start station name",
         CAST(c_custkey % 15 + 400 AS DOUBLE) / 10 AS "start station latitude",
         CAST(c_custkey % 12 - 745 AS DOUBLE) / 10 AS "start station longitude",
         c_mktsegment AS "end station name",
         CAST(o_orderkey % 15 + 400 AS DOUBLE) / 10 AS "end station latitude",
         CAST(o_orderkey % 12 - 745 AS DOUBLE) / 10 AS "end station longitude",
         CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderkey END AS bikeid,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Subscriber' ELSE 'Customer' END AS usertype
  FROM orders JOIN customer ON o_custkey = c_custkey) b
"""


# ----------------------------------------------------------- v_sensor_raw
def sensor_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Street-sensor temperature rows (dotted column names) from customer x nation."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
    day = F.date_add(F.lit("2019-01-01").cast("date"), (F.col("c_custkey") % 730).cast("int"))
    return j.select(
        F.col("c_name").alias("Sensor.ID"),
        F.col("c_mktsegment").alias("Install.Type"),
        F.when(F.col("c_custkey") % 31 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("c_acctbal") / 70).alias("AirTemp"),
        F.date_format(day, "MM/dd/yyyy").alias("Day"),
        (F.col("c_custkey") % 25).cast("int").alias("Hour"),
        (_dbl(F.col("c_custkey") % 15 + 400) / 10).alias("Latitude"),
        (_dbl(F.col("c_nationkey") - 745) / 10).alias("Longitude"),
        F.year(day).alias("Year"),
        F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")))
         .otherwise(F.col("n_name")).alias("Borough"),
        F.concat(F.lit("NTA"), (F.col("c_custkey") % 40).cast("string")).alias("ntacode"),
    )


SQL_SENSOR_RAW = """
SELECT c_name AS "Sensor.ID", c_mktsegment AS "Install.Type",
       CASE WHEN c_custkey % 31 = 0 THEN CAST(NULL AS DOUBLE) ELSE c_acctbal / 70 END AS AirTemp,
       strftime(DATE '2019-01-01' + CAST(c_custkey % 730 AS INTEGER), '%m/%d/%Y') AS "Day",
       CAST(c_custkey % 25 AS INTEGER) AS "Hour",
       CAST(c_custkey % 15 + 400 AS DOUBLE) / 10 AS Latitude,
       CAST(c_nationkey - 745 AS DOUBLE) / 10 AS Longitude,
       CAST(year(DATE '2019-01-01' + CAST(c_custkey % 730 AS INTEGER)) AS INTEGER) AS "Year",
       CASE WHEN c_custkey % 4 = 0 THEN '  ' || lower(n_name) || ' ' ELSE n_name END AS Borough,
       'NTA' || CAST(c_custkey % 40 AS VARCHAR) AS ntacode
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

# ------------------------------------------------------------ v_bike_new
def bike_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New-format bike rows (ride ids, underscore names) from orders."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("ride_id"),
        F.lit("classic_bike").alias("rideable_type"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderpriority")).alias("start_station_name"),
        F.when(F.col("o_orderkey") % 17 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderstatus")).alias("end_station_name"),
        (_dbl(F.col("o_orderkey") % 15 + 400) / 10).alias("start_lat"),
        (_dbl(F.col("o_orderkey") % 12 - 745) / 10).alias("start_lng"),
        (_dbl(F.col("o_custkey") % 15 + 400) / 10).alias("end_lat"),
        (_dbl(F.col("o_custkey") % 12 - 745) / 10).alias("end_lng"),
    )


SQL_BIKE_NEW = """
SELECT 'R' || CAST(o_orderkey AS VARCHAR) AS ride_id, 'classic_bike' AS rideable_type,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS start_station_name,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS end_station_name,
       CAST(o_orderkey % 15 + 400 AS DOUBLE) / 10 AS start_lat,
       CAST(o_orderkey % 12 - 745 AS DOUBLE) / 10 AS start_lng,
       CAST(o_custkey % 15 + 400 AS DOUBLE) / 10 AS end_lat,
       CAST(o_custkey % 12 - 745 AS DOUBLE) / 10 AS end_lng
FROM orders
"""

SQL = {
    "v_trips": SQL_TRIPS,
    "v_weather_raw": SQL_WEATHER_RAW,
    "v_zones": SQL_ZONES,
    "v_taxi_raw": SQL_TAXI_RAW,
    "v_bike_raw": SQL_BIKE_RAW,
    "v_sensor_raw": SQL_SENSOR_RAW,
    "v_bike_new": SQL_BIKE_NEW,
}
