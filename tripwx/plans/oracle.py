"""Independent DuckDB SQL for every registered query.

CTE bodies are kept here by name with their dependencies; ``sql()`` pulls
in everything a query needs, in dependency order.  Rounding of means uses
the same sign-aware 1e-9 nudge as ``functions.columns.round_stable``.
"""

from __future__ import annotations

from tripwx.plans import fixtures

DATA_YEAR = 2024  # the driver's event tables cover January 2024


def rs(expr: str, n: int) -> str:
    """SQL twin of ``round_stable``."""
    return f"(round(({expr}) + sign({expr}) * 1e-9, {n}) + 0.0)"


def season_sql(month: str) -> str:
    return (f"CASE WHEN {month} IN (12, 1, 2) THEN 'WINTER' WHEN {month} IN (3, 4, 5) THEN 'SPRING' "
            f"WHEN {month} IN (6, 7, 8) THEN 'SUMMER' ELSE 'FALL' END")


def beaufort_sql(w: str) -> str:
    return f"""CASE WHEN {w} < 1 THEN '0 - Calm'
         WHEN {w} >= 1 AND {w} <= 5 THEN '1 - Light Air' WHEN {w} >= 6 AND {w} <= 11 THEN '2 - Light Breeze'
         WHEN {w} >= 12 AND {w} <= 19 THEN '3 - Gentle Breeze' WHEN {w} >= 20 AND {w} <= 28 THEN '4 - Moderate Breeze'
         WHEN {w} >= 29 AND {w} <= 38 THEN '5 - Fresh Breeze' WHEN {w} >= 39 AND {w} <= 49 THEN '6 - Strong Breeze'
         WHEN {w} >= 50 AND {w} <= 61 THEN '7 - Near Gale' WHEN {w} >= 62 AND {w} <= 74 THEN '8 - Gale'
         WHEN {w} >= 75 AND {w} <= 88 THEN '9 - Strong Gale' WHEN {w} >= 89 AND {w} <= 102 THEN '10 - Storm'
         WHEN {w} >= 103 AND {w} <= 117 THEN '11 - Violent Storm' WHEN {w} >= 118 THEN '12 - Hurricane'
         ELSE 'Unknown' END"""


def haversine_sql(lat1, lon1, lat2, lon2, radius) -> str:
    a = (f"least(greatest(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
         f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2), 0.0), 1.0)")
    return f"({radius} * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


W_MEASURES = "precipitation_mm, rain_mm, cloudcover_pct, windspeed_kmh, wind_direction_deg"

CTES: dict[str, tuple[list[str], str]] = {
    "v_trips": ([], fixtures.SQL_TRIPS),
    "v_weather_raw": ([], fixtures.SQL_WEATHER_RAW),
    "v_zones": ([], fixtures.SQL_ZONES),
    "v_taxi_raw": ([], fixtures.SQL_TAXI_RAW),
    "v_bike_raw": ([], fixtures.SQL_BIKE_RAW),
    "v_sensor_raw": ([], fixtures.SQL_SENSOR_RAW),
    "v_bike_new": ([], fixtures.SQL_BIKE_NEW),
    "w_typed": (["v_weather_raw"], """
SELECT ts AS "timestamp", CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS VARCHAR) AS year,
       round("temperature_2m (°C)" * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE, 2) AS temp_f,
       round("precipitation (mm)", 2) AS precipitation_mm, round("rain (mm)", 2) AS rain_mm,
       round("cloudcover (%)", 2) AS cloudcover_pct, round("windspeed_10m (km/h)", 2) AS windspeed_kmh,
       round("winddirection_10m (°)", 2) AS wind_direction_deg
FROM (SELECT try_strptime("time", '%Y-%m-%dT%H:%M') AS ts, * FROM v_weather_raw) r"""),
    "w_clean": (["w_typed"], f"""
SELECT "timestamp", date, hour, month, year, temp_f, {W_MEASURES}
FROM w_typed
WHERE "timestamp" IS NOT NULL AND temp_f IS NOT NULL AND precipitation_mm IS NOT NULL
  AND rain_mm IS NOT NULL AND cloudcover_pct IS NOT NULL AND windspeed_kmh IS NOT NULL
  AND wind_direction_deg IS NOT NULL AND date IS NOT NULL AND hour IS NOT NULL
  AND month IS NOT NULL AND year IS NOT NULL
  AND temp_f BETWEEN -20.0 AND 115.0 AND precipitation_mm >= 0 AND rain_mm >= 0
  AND cloudcover_pct BETWEEN 0 AND 100 AND windspeed_kmh >= 0
  AND wind_direction_deg BETWEEN 0 AND 360 AND hour BETWEEN 0 AND 23"""),
    "w_enrich": (["w_clean"], f"""
SELECT *, strftime("timestamp", '%Y-%m-%dT%H:%M') AS date_iso,
       {season_sql('month')} AS season,
       {beaufort_sql('windspeed_kmh')} AS beaufort_scale,
       CASE WHEN temp_f >= 80.0 THEN 1 ELSE 0 END AS isHot,
       CASE WHEN windspeed_kmh >= 29 THEN 1 ELSE 0 END AS isWindy
FROM w_clean WHERE year = '{DATA_YEAR}'"""),
    "w_pub": (["w_enrich"], f"""
SELECT date, hour AS time_hours, temp_f, {W_MEASURES}, season, beaufort_scale, isHot, isWindy
FROM w_enrich"""),
    "trips_union": (["v_trips"], """
SELECT * FROM v_trips WHERE is_taxi = 1
UNION ALL
SELECT * FROM v_trips WHERE is_taxi = 0"""),
    "merged_left": (["trips_union", "w_pub"], f"""
SELECT t.date, t.time_hours, t.start_longitude, t.start_latitude, t.trip_duration, t.distance,
       t.is_taxi, w.temp_f, w.precipitation_mm, w.rain_mm, w.cloudcover_pct, w.windspeed_kmh,
       w.wind_direction_deg, w.season, w.beaufort_scale, w.isHot, w.isWindy
FROM trips_union t LEFT JOIN w_pub w ON t.date = w.date AND t.time_hours = w.time_hours"""),
    "zone_lookup": (["v_zones"], """
SELECT TRY_CAST(LocationID AS BIGINT) AS PULocationID, TRY_CAST(longitude AS DOUBLE) AS lookup_longitude,
       TRY_CAST(latitude AS DOUBLE) AS lookup_latitude
FROM v_zones"""),
    "taxi_trips": (["v_taxi_raw", "zone_lookup"], """
SELECT z.lookup_longitude AS start_longitude, z.lookup_latitude AS start_latitude,
       CAST(hour(t.tpep_pickup_datetime) AS INTEGER) AS time_hours,
       CAST(t.tpep_pickup_datetime AS DATE) AS date,
       CAST(epoch(t.tpep_dropoff_datetime) - epoch(t.tpep_pickup_datetime) AS DOUBLE) AS trip_duration,
       t.trip_distance AS distance, 1 AS is_taxi
FROM v_taxi_raw t LEFT JOIN zone_lookup z ON t.PULocationID = z.PULocationID"""),
    "bike_trips": (["v_bike_raw"], f"""
SELECT * FROM (
  SELECT "start station longitude" AS start_longitude, "start station latitude" AS start_latitude,
         CAST(hour(starttime) AS INTEGER) AS time_hours, CAST(starttime AS DATE) AS date,
         CAST(tripduration AS DOUBLE) AS trip_duration,
         {haversine_sql('"start station latitude"', '"start station longitude"', '"end station latitude"', '"end station longitude"', 6371.0)} AS distance,
         0 AS is_taxi
  FROM v_bike_raw
  WHERE tripduration IS NOT NULL AND starttime IS NOT NULL AND stoptime IS NOT NULL
    AND "start station name" IS NOT NULL AND "start station latitude" IS NOT NULL
    AND "start station longitude" IS NOT NULL AND "end station name" IS NOT NULL
    AND "end station latitude" IS NOT NULL AND "end station longitude" IS NOT NULL
    AND bikeid IS NOT NULL AND usertype IS NOT NULL) b
WHERE start_longitude IS NOT NULL AND start_latitude IS NOT NULL AND time_hours IS NOT NULL
  AND date IS NOT NULL AND trip_duration IS NOT NULL AND distance IS NOT NULL"""),
    "merged_inner": (["v_trips", "w_pub"], """
SELECT DISTINCT * FROM (
  SELECT t.date, t.time_hours, t.start_longitude, t.start_latitude, t.trip_duration, t.distance,
         t.is_taxi, w.temp_f, w.precipitation_mm, w.rain_mm, w.cloudcover_pct, w.windspeed_kmh,
         w.wind_direction_deg, w.season, w.beaufort_scale, w.isHot, w.isWindy
  FROM (SELECT * FROM v_trips WHERE is_taxi = 0 UNION ALL SELECT * FROM v_trips WHERE is_taxi = 1) t
  JOIN w_pub w ON t.date = w.date AND t.time_hours = w.time_hours) m
WHERE date IS NOT NULL AND time_hours IS NOT NULL AND start_longitude IS NOT NULL
  AND start_latitude IS NOT NULL AND trip_duration IS NOT NULL AND distance IS NOT NULL
  AND is_taxi IS NOT NULL AND temp_f IS NOT NULL AND precipitation_mm IS NOT NULL
  AND rain_mm IS NOT NULL AND cloudcover_pct IS NOT NULL AND windspeed_kmh IS NOT NULL
  AND wind_direction_deg IS NOT NULL AND season IS NOT NULL AND beaufort_scale IS NOT NULL
  AND isHot IS NOT NULL AND isWindy IS NOT NULL"""),
    "sensor_clean": (["v_sensor_raw"], f"""
SELECT * FROM (
  SELECT CAST(round(CAST(CAST(AirTemp AS VARCHAR) AS DECIMAL(38, 15)), 2) AS DOUBLE) AS airtemp, CAST(try_strptime("Day", '%m/%d/%Y') AS DATE) AS day,
         CAST("Hour" AS INTEGER) AS hour, Latitude AS latitude, Longitude AS longitude,
         CAST("Year" AS VARCHAR) AS year, Borough AS borough, ntacode
  FROM v_sensor_raw) s
WHERE airtemp IS NOT NULL AND day IS NOT NULL AND hour IS NOT NULL AND latitude IS NOT NULL
  AND longitude IS NOT NULL AND year IS NOT NULL AND borough IS NOT NULL AND ntacode IS NOT NULL
  AND airtemp BETWEEN -20.0 AND 130.0 AND hour BETWEEN 0 AND 23"""),
    "sensor_enrich": (["sensor_clean"], """
SELECT airtemp, day, hour, latitude, longitude, year, upper(trim(borough)) AS borough, ntacode,
       strftime(day, '%Y-%m-%d') AS day_iso, CASE WHEN airtemp >= 80.0 THEN 1 ELSE 0 END AS isHot
FROM sensor_clean WHERE year = '2019'"""),
}


def sql(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body
    withs = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH {withs}\n{body}"
