"""Registered queries: pipelines, column functions, filters, joins, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripwx.functions import columns as C
from tripwx.operators import clean, joins, schema
from tripwx.plans import analytics, fixtures, inputs, merge, sensor, trips, weather
from tripwx.plans.oracle import DATA_YEAR, beaufort_sql, haversine_sql, rs, season_sql, sql
from tripwx.plans.register import register
from tripwx.session import scratch_path

MERGED_COLS = ["date", "time_hours", "start_longitude", "start_latitude", "trip_duration", "distance",
               "is_taxi", "temp_f", "precipitation_mm", "rain_mm", "cloudcover_pct", "windspeed_kmh",
               "wind_direction_deg", "season", "beaufort_scale", "isHot", "isWindy"]


def _all_not_null(cols):
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


# ------------------------------------------------------ E15 published analytics
@register("weather_duration", sql(f"""
SELECT round(temp_f / 5, 0) * 5 + 0.0 AS temp_bucket, is_taxi,
       {rs('avg(trip_duration)', 2)} AS avg_duration,
       {rs('avg(precipitation_mm)', 2)} AS avg_precip,
       {rs('avg(windspeed_kmh)', 2)} AS avg_wind,
       count(*) AS trip_count
FROM merged_left GROUP BY 1, 2""", "merged_left"))
def q_weather_duration(spark, sf):
    return analytics.weather_duration(inputs.merged_left(spark, sf))


@register("temp_bucket_counts", sql("""
SELECT round(temp_f / 5, 0) * 5 + 0.0 AS temp_bucket, is_taxi, count(*) AS count
FROM merged_left GROUP BY 1, 2""", "merged_left"))
def q_temp_bucket_counts(spark, sf):
    return analytics.temp_bucket_counts(inputs.merged_left(spark, sf))


# ------------------------------------------------------------ E1-E3 weather
@register("weather_clean", sql("SELECT * FROM w_clean", "w_clean"))
def q_weather_clean(spark, sf):
    return weather.cleaned(fixtures.weather_raw(spark, sf))


@register("weather_enrich", sql("SELECT * FROM w_enrich", "w_enrich"))
def q_weather_enrich(spark, sf):
    return inputs.enriched_weather(spark, sf)


@register("weather_publish", sql("SELECT * FROM w_pub", "w_pub"))
def q_weather_publish(spark, sf):
    return inputs.published_weather(spark, sf)


@register("weather_funnel", sql("""
SELECT s.stage_no, s.stage, CAST(c.rows AS BIGINT) AS rows FROM (VALUES (0, 'input'), (1, 'not_null'), (2, 'temp_f_range'), (3, 'precipitation_non_negative'),
       (4, 'rain_non_negative'), (5, 'cloudcover_range'), (6, 'windspeed_non_negative'),
       (7, 'direction_range'), (8, 'hour_range')) s(stage_no, stage)
JOIN (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7, 8]) AS k, unnest([c0, c1, c2, c3, c4, c5, c6, c7, c8]) AS rows
      FROM (SELECT count(*) AS c0,
              count_if(n) AS c1, count_if(n AND t) AS c2, count_if(n AND t AND p) AS c3,
              count_if(n AND t AND p AND r) AS c4, count_if(n AND t AND p AND r AND cl) AS c5,
              count_if(n AND t AND p AND r AND cl AND ws) AS c6,
              count_if(n AND t AND p AND r AND cl AND ws AND wd) AS c7,
              count_if(n AND t AND p AND r AND cl AND ws AND wd AND hr) AS c8
            FROM (SELECT ("timestamp" IS NOT NULL AND temp_f IS NOT NULL AND precipitation_mm IS NOT NULL
                          AND rain_mm IS NOT NULL AND cloudcover_pct IS NOT NULL AND windspeed_kmh IS NOT NULL
                          AND wind_direction_deg IS NOT NULL AND date IS NOT NULL AND hour IS NOT NULL
                          AND month IS NOT NULL AND year IS NOT NULL) AS n,
                         temp_f BETWEEN -20.0 AND 115.0 AS t, precipitation_mm >= 0 AS p, rain_mm >= 0 AS r,
                         cloudcover_pct BETWEEN 0 AND 100 AS cl, windspeed_kmh >= 0 AS ws,
                         wind_direction_deg BETWEEN 0 AND 360 AS wd, hour BETWEEN 0 AND 23 AS hr
                  FROM w_typed) x) a) c ON c.k = s.stage_no""", "w_typed"))
def q_weather_funnel(spark, sf):
    return weather.funnel(fixtures.weather_raw(spark, sf))


# ------------------------------------------------------------- merges
@register("merge_left", sql("SELECT * FROM merged_left", "merged_left"))
def q_merge_left(spark, sf):
    return inputs.merged_left(spark, sf)


@register("merge_inner", sql("SELECT * FROM merged_inner", "merged_inner"))
def q_merge_inner(spark, sf):
    taxi, bike = inputs.taxi_and_bike(spark, sf)
    return merge.merge_inner(bike, taxi, inputs.published_weather(spark, sf))


@register("union_positional", sql("SELECT * FROM trips_union", "trips_union"))
def q_union_positional(spark, sf):
    taxi, bike = inputs.taxi_and_bike(spark, sf)
    return joins.union_positional(taxi, bike)


@register("union_by_name", sql("""
SELECT * FROM v_trips WHERE is_taxi = 0 UNION ALL SELECT * FROM v_trips WHERE is_taxi = 1""", "v_trips"))
def q_union_by_name(spark, sf):
    taxi, bike = inputs.taxi_and_bike(spark, sf)
    return joins.union_by_name(bike.select(*reversed(bike.columns)), taxi)


# ----------------------------------------------------------- E4/E7 trip ingest
@register("join_left_lookup", sql("""
SELECT t.PULocationID, t.tpep_pickup_datetime, t.tpep_dropoff_datetime, t.trip_distance,
       z.lookup_longitude, z.lookup_latitude
FROM v_taxi_raw t LEFT JOIN zone_lookup z ON t.PULocationID = z.PULocationID""", "v_taxi_raw", "zone_lookup"))
def q_join_left_lookup(spark, sf):
    src = schema.align(fixtures.taxi_raw(spark, sf), trips.TAXI_SOURCE)
    return joins.join_small(src, trips.zone_lookup(fixtures.zones(spark, sf)), ["PULocationID"], "left") \
        .withColumns({c: F.col(c).cast("timestamp_ntz") for c in ["tpep_pickup_datetime", "tpep_dropoff_datetime"]})


@register("trips_from_taxi", sql("SELECT * FROM taxi_trips", "taxi_trips"))
def q_trips_from_taxi(spark, sf):
    return inputs.taxi_trips(spark, sf)


@register("trips_from_bike", sql("""
SELECT start_longitude, start_latitude, time_hours, date, trip_duration, round(distance, 6) AS distance, is_taxi
FROM bike_trips""", "bike_trips"))
def q_trips_from_bike(spark, sf):
    return inputs.bike_trips(spark, sf).withColumn("distance", F.round("distance", 6))


@register("trip_duration", sql("""
SELECT CAST(starttime AS DATE) AS date, CAST(tripduration AS DOUBLE) / 60.0 AS trip_duration_min,
       CAST(epoch(stoptime) - epoch(starttime) AS BIGINT) AS elapsed_s
FROM v_bike_raw""", "v_bike_raw"))
def q_trip_duration(spark, sf):
    b = fixtures.bike_raw(spark, sf)
    return b.select(F.to_date("starttime").alias("date"),
                    C.duration_unit("tripduration", "min").alias("trip_duration_min"),
                    C.duration_seconds("starttime", "stoptime").alias("elapsed_s"))


@register("haversine", sql(f"""
SELECT "start station name" AS station,
       round({haversine_sql('"start station latitude"', '"start station longitude"', '"end station latitude"', '"end station longitude"', C.EARTH_RADIUS_KM)}, 6) AS distance_km,
       round({haversine_sql('"start station latitude"', '"start station longitude"', '"end station latitude"', '"end station longitude"', C.EARTH_RADIUS_MI)}, 6) AS distance_mi
FROM v_bike_raw""", "v_bike_raw"))
def q_haversine(spark, sf):
    b = fixtures.bike_raw(spark, sf)
    args = ("start station latitude", "start station longitude", "end station latitude", "end station longitude")
    return b.select(F.col("`start station name`").alias("station"),
                    F.round(C.haversine(*args, unit="km"), 6).alias("distance_km"),
                    F.round(C.haversine(*args, unit="mi"), 6).alias("distance_mi"))


@register("stats_input_bike", sql("""
SELECT lower(trim("start station name")) AS start_name, lower(trim("end station name")) AS end_name,
       starttime, CASE WHEN usertype = 'Subscriber' THEN 1 ELSE 0 END AS is_subscriber
FROM v_bike_raw""", "v_bike_raw"))
def q_stats_input_bike(spark, sf):
    b = trips.bike_profiled(fixtures.bike_raw(spark, sf))
    return b.select(F.col("`start station name`").alias("start_name"), F.col("`end station name`").alias("end_name"),
                    F.col("starttime").cast("timestamp_ntz").alias("starttime"), "is_subscriber")


@register("drop_columns", sql(f"""
SELECT ride_id, rideable_type, start_station_name, end_station_name, 2024 AS data_year
FROM v_bike_new WHERE {_all_not_null(['ride_id', 'start_station_name', 'end_station_name'])}""", "v_bike_new"))
def q_drop_columns(spark, sf):
    return trips.bike_new_format(fixtures.bike_new(spark, sf), 2024)


@register("const_column", sql("""
SELECT ride_id, 2024 AS data_year, 'Mean' AS stat_type, 0 AS is_taxi FROM v_bike_new""", "v_bike_new"))
def q_const_column(spark, sf):
    return fixtures.bike_new(spark, sf).select(
        "ride_id", F.lit(2024).alias("data_year"), F.lit("Mean").alias("stat_type"), F.lit(0).alias("is_taxi"))


# ------------------------------------------------------- projections
@register("schema_align", sql("""
SELECT tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance, PULocationID, DOLocationID,
       CAST(NULL AS DOUBLE) AS congestion_surcharge
FROM v_taxi_raw""", "v_taxi_raw"))
def q_schema_align(spark, sf):
    specs = trips.TAXI_KEPT + [schema.ColumnSpec("congestion_surcharge", "double")]
    ntz = [schema.ColumnSpec(s.name, "timestamp_ntz") if s.dtype == "timestamp" else s for s in specs]
    return schema.align(fixtures.taxi_raw(spark, sf), ntz)


@register("rename_cast", sql("""
SELECT "time" AS "timestamp", "temperature_2m (°C)" AS temp_c, "precipitation (mm)" AS precipitation_mm,
       "rain (mm)" AS rain_mm, "cloudcover (%)" AS cloudcover_pct,
       CAST("windspeed_10m (km/h)" AS VARCHAR) AS windspeed_kmh, CAST(floor("winddirection_10m (°)") AS BIGINT) AS wind_direction_deg
FROM v_weather_raw""", "v_weather_raw"))
def q_rename_cast(spark, sf):
    df = schema.drop_columns(fixtures.weather_raw(spark, sf), weather.RAW_DROPPED)
    df = schema.rename(df, weather.RAW_RENAMES)
    df = df.withColumn("wind_direction_deg", F.floor("wind_direction_deg"))
    return schema.cast_columns(df, {"windspeed_kmh": "string", "wind_direction_deg": "bigint"})


@register("calendar", sql("""
SELECT "timestamp", date, hour, month, year FROM w_typed""", "w_typed"))
def q_calendar(spark, sf):
    return weather.typed(fixtures.weather_raw(spark, sf)).select("timestamp", "date", "hour", "month", "year")


@register("c_to_f", sql("""
SELECT "time", "temperature_2m (°C)" AS temp_c, round("temperature_2m (°C)" * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE, 2) AS temp_f
FROM v_weather_raw""", "v_weather_raw"))
def q_c_to_f(spark, sf):
    r = fixtures.weather_raw(spark, sf)
    return r.select("time", F.col("`temperature_2m (°C)`").alias("temp_c"),
                    C.c_to_f(F.col("`temperature_2m (°C)`")).alias("temp_f"))


@register("season", sql(f"""
SELECT CAST(month(tpep_pickup_datetime) AS INTEGER) AS month, {season_sql('month(tpep_pickup_datetime)')} AS season,
       count(*) AS count
FROM v_taxi_raw GROUP BY 1, 2""", "v_taxi_raw"))
def q_season(spark, sf):
    t = fixtures.taxi_raw(spark, sf).select(F.month("tpep_pickup_datetime").alias("month"))
    return t.groupBy("month", C.season("month").alias("season")).agg(F.count(F.lit(1)).alias("count"))


@register("beaufort", sql(f"""
SELECT windspeed_kmh, {beaufort_sql('windspeed_kmh')} AS beaufort_scale,
       CASE WHEN windspeed_kmh < 1 THEN '0 - Calm' {' '.join(f"WHEN windspeed_kmh >= {lo} AND windspeed_kmh < {nxt} THEN '{lab}'" for (lab, lo, _), nxt in zip(C.BEAUFORT_BANDS, [b[1] for b in C.BEAUFORT_BANDS[1:]] + [C.BEAUFORT_HURRICANE[1]]))} WHEN windspeed_kmh >= 118 THEN '12 - Hurricane' ELSE 'Unknown' END AS beaufort_contiguous
FROM w_typed""", "w_typed"))
def q_beaufort(spark, sf):
    w = weather.typed(fixtures.weather_raw(spark, sf))
    return w.select("windspeed_kmh", C.beaufort("windspeed_kmh").alias("beaufort_scale"),
                    C.beaufort("windspeed_kmh", contiguous=True).alias("beaufort_contiguous"))


@register("binary_flags", sql("""
SELECT isHot, isWindy, count(*) AS count FROM w_enrich GROUP BY 1, 2""", "w_enrich"))
def q_binary_flags(spark, sf):
    return inputs.enriched_weather(spark, sf).groupBy("isHot", "isWindy").agg(F.count(F.lit(1)).alias("count"))


@register("date_formats", sql("""
SELECT * FROM (
  SELECT strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_pickup_datetime,
         strftime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_dropoff_datetime,
         fare_amount, tip_amount, total_amount, passenger_count, trip_distance,
         CAST(epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime) AS BIGINT) AS trip_time_length
  FROM v_taxi_raw) t""", "v_taxi_raw"))
def q_date_formats(spark, sf):
    return trips.taxi_with_lengths(fixtures.taxi_raw(spark, sf))


@register("date_iso_pairs", sql("""
SELECT "timestamp", date_iso FROM (SELECT DISTINCT "timestamp", date_iso FROM w_enrich)
ORDER BY "timestamp" LIMIT 10""", "w_enrich"))
def q_date_iso_pairs(spark, sf):
    return inputs.enriched_weather(spark, sf).select("timestamp", "date_iso").distinct() \
        .orderBy("timestamp").limit(10)


@register("text_normalize", sql("""
SELECT DISTINCT lower(trim("start station name")) AS start_station, upper(trim("start station name")) AS start_station_upper
FROM v_bike_raw""", "v_bike_raw"))
def q_text_normalize(spark, sf):
    b = fixtures.bike_raw(spark, sf)
    n = F.col("`start station name`")
    return b.select(C.normalize_lower(n).alias("start_station"), C.normalize_upper(n).alias("start_station_upper")).distinct()


# ------------------------------------------------------------ filters
@register("year_filter", sql(f"""
SELECT * FROM merged_left WHERE year(date) = {DATA_YEAR}""", "merged_left"))
def q_year_filter(spark, sf):
    return inputs.merged_left(spark, sf).filter(C.year_range("date", DATA_YEAR))


@register("bbox_filter", sql("""
SELECT * FROM merged_left
WHERE start_latitude BETWEEN 40.0 AND 41.5 AND start_longitude BETWEEN -74.5 AND -73.0""", "merged_left"))
def q_bbox_filter(spark, sf):
    return clean.apply_rules(inputs.merged_left(spark, sf), merge.bbox_rules())


@register("dropna_any", sql(f"SELECT * FROM merged_left WHERE {_all_not_null(MERGED_COLS)}", "merged_left"))
def q_dropna_any(spark, sf):
    return clean.drop_nulls(inputs.merged_left(spark, sf))


@register("dropna_subset", sql("""
SELECT * FROM merged_left WHERE temp_f IS NOT NULL AND distance IS NOT NULL""", "merged_left"))
def q_dropna_subset(spark, sf):
    return clean.drop_nulls(inputs.merged_left(spark, sf), ["temp_f", "distance"])


@register("clean_strict", sql(f"""
SELECT DISTINCT * FROM merged_left
WHERE {_all_not_null(merge.STRICT_REQUIRED)} AND trip_duration > 0 AND distance >= 0
  AND time_hours BETWEEN 0 AND 23 AND start_latitude BETWEEN 40.0 AND 41.5
  AND start_longitude BETWEEN -74.5 AND -73.0""", "merged_left"))
def q_clean_strict(spark, sf):
    return merge.clean_strict(inputs.merged_left(spark, sf))


_OUTLIER = [
    f"year(date) = {DATA_YEAR}",
    _all_not_null(merge.TRIP_REQUIRED),
    "trip_duration > 0", "trip_duration < 86400", "distance >= 0", "distance < 200",
    "time_hours BETWEEN 0 AND 23", "start_latitude BETWEEN 40.0 AND 41.5",
    "start_longitude BETWEEN -74.5 AND -73.0",
]
_STAGES = ["input", "year", "trip_not_null", "duration_positive", "duration_below_day",
           "distance_non_negative", "distance_below_max", "hour_range", "latitude_box", "longitude_box"]


def _funnel_sql():
    counts = ["count(*) AS c0"] + [
        f"count_if({' AND '.join('(' + c + ')' for c in _OUTLIER[:i])}) AS c{i}" for i in range(1, len(_OUTLIER) + 1)]
    arms = " UNION ALL ".join(f"SELECT {i} AS stage_no, '{s}' AS stage, CAST(c{i} AS BIGINT) AS rows FROM c"
                              for i, s in enumerate(_STAGES))
    return sql(f"SELECT * FROM (WITH c AS (SELECT {', '.join(counts)} FROM merged_left) {arms}) f",
               "merged_left")


@register("clean_funnel", _funnel_sql())
def q_clean_funnel(spark, sf):
    return merge.clean_impute_funnel(inputs.merged_left(spark, sf), DATA_YEAR)


_IMPUTED = ", ".join(f"coalesce(m.{c}, a.{c}) AS {c}" for c in merge.WEATHER_MEASURES)


@register("clean_impute", sql(f"""
SELECT * FROM (
  WITH v AS (SELECT * FROM merged_left WHERE {' AND '.join('(' + c + ')' for c in _OUTLIER)}),
       a AS (SELECT {', '.join(f'CAST(sum(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38, 15))) AS DOUBLE) / count({c}) AS {c}' for c in merge.WEATHER_MEASURES)} FROM v)
  SELECT m.date, m.time_hours, m.start_longitude, m.start_latitude, m.trip_duration, m.distance, m.is_taxi,
         {_IMPUTED}, m.season, m.beaufort_scale, m.isHot, m.isWindy,
         CAST(day(m.date) AS INTEGER) AS day_of_month, CAST(month(m.date) AS INTEGER) AS month,
         CASE WHEN day(m.date) <= 15 THEN 'early' ELSE 'late' END AS month_segment
  FROM v m, a) x""", "merged_left"))
def q_clean_impute(spark, sf):
    return merge.clean_impute(inputs.merged_left(spark, sf), DATA_YEAR)


@register("month_segment", sql(f"""
SELECT CAST(month(date) AS INTEGER) AS month, CASE WHEN day(date) <= 15 THEN 'early' ELSE 'late' END AS month_segment,
       count(*) AS count
FROM merged_left WHERE {' AND '.join('(' + c + ')' for c in _OUTLIER)} GROUP BY 1, 2""", "merged_left"))
def q_month_segment(spark, sf):
    df = merge.clean_impute(inputs.merged_left(spark, sf), DATA_YEAR)
    return df.groupBy("month", "month_segment").agg(F.count(F.lit(1)).alias("count")).orderBy("month", "month_segment")


@register("impute_mean", sql(f"""
SELECT m.date, m.time_hours, m.start_longitude, m.start_latitude, m.trip_duration, m.distance, m.is_taxi,
       {_IMPUTED}, m.season, m.beaufort_scale, m.isHot, m.isWindy
FROM merged_left m, (SELECT {', '.join(f'CAST(sum(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38, 15))) AS DOUBLE) / count({c}) AS {c}' for c in merge.WEATHER_MEASURES)} FROM merged_left) a""",
                            "merged_left"))
def q_impute_mean(spark, sf):
    return clean.impute_mean(inputs.merged_left(spark, sf), merge.WEATHER_MEASURES, exact_scale=merge.MEAN_SCALE)


@register("dedup_rows", sql("""
SELECT DISTINCT * FROM (SELECT * FROM v_trips UNION ALL SELECT * FROM v_trips WHERE time_hours % 7 = 0) d""",
                            "v_trips"))
def q_dedup_rows(spark, sf):
    t = fixtures.trips(spark, sf)
    return clean.dedup(t.unionByName(t.filter(F.col("time_hours") % 7 == 0)))


@register("dedup_stored", sql("""
SELECT DISTINCT * FROM (SELECT * FROM v_trips UNION ALL SELECT * FROM v_trips WHERE time_hours % 7 = 0) d""",
                              "v_trips"))
def q_dedup_stored(spark, sf):
    """The same by row hashes, over a stored table."""
    t = fixtures.trips(spark, sf)
    path = scratch_path(spark, "repeating_trips")
    t.unionByName(t.filter(F.col("time_hours") % 7 == 0)).write.parquet(path)
    return clean.dedup_stored(spark.read.parquet(path))


# ---------------------------------------------------------------- E18 sensor
@register("sensor_clean", sql("SELECT * FROM sensor_clean", "sensor_clean"))
def q_sensor_clean(spark, sf):
    return sensor.cleaned(fixtures.sensor_raw(spark, sf))


@register("sensor_enrich", sql("SELECT * FROM sensor_enrich", "sensor_enrich"))
def q_sensor_enrich(spark, sf):
    return sensor.enriched(sensor.cleaned(fixtures.sensor_raw(spark, sf)), 2019)
