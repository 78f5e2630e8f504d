"""Registered queries: profiling."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwx.functions.columns import round_stable
from tripwx.operators import profile as P
from tripwx.operators import schema, sketches, value_counts
from tripwx.plans import fixtures, inputs, sensor, trips, weather
from tripwx.plans.oracle import rs, sql
from tripwx.plans.q_ingest import MERGED_COLS
from tripwx.plans.register import register
from tripwx.session import scratch_path

WEATHER_STATS = ["temp_f", "hour", "precipitation_mm", "rain_mm", "cloudcover_pct", "windspeed_kmh",
                 "wind_direction_deg"]
MEDIAN_COLS = ["temp_f", "hour", "precipitation_mm", "windspeed_kmh"]
MERGED_NUMERIC = ["trip_duration", "distance", "start_latitude", "start_longitude", "time_hours", "temp_f",
                  "precipitation_mm", "rain_mm", "cloudcover_pct", "windspeed_kmh", "wind_direction_deg"]
BIKE_STATS = {"start station latitude": "Start_Lat", "start station longitude": "Start_Lng",
              "end station latitude": "End_Lat", "end station longitude": "End_Lng"}


def _mode_sql(table, cols, cast="DOUBLE"):
    arms = [f"""SELECT * FROM (SELECT '{c}' AS column_name, CAST({c} AS {cast}) AS mode, count(*) AS mode_count
        FROM {table} WHERE {c} IS NOT NULL GROUP BY 2 ORDER BY 3 DESC, 2 ASC LIMIT 1)""" for c in cols]
    return " UNION ALL ".join(arms)


# ------------------------------------------------------------------- counts
@register("row_count", sql("SELECT count(*) AS rows FROM merged_left", "merged_left"))
def q_row_count(spark, sf):
    return P.row_count(inputs.merged_left(spark, sf))


@register("row_count_by_file", sql("SELECT count(*) AS rows FROM lineitem"))
def q_row_count_by_file(spark, sf):
    per_file = P.row_count_by_file(fixtures.table(spark, sf, "lineitem"))
    return per_file.agg(F.sum("rows").cast("bigint").alias("rows"))


@register("count_by_key", sql("SELECT beaufort_scale, count(*) AS count FROM w_enrich GROUP BY 1", "w_enrich"))
def q_count_by_key(spark, sf):
    return P.count_by(inputs.enriched_weather(spark, sf), "beaufort_scale")


@register("count_by_hour", sql("SELECT time_hours, count(*) AS count FROM merged_left GROUP BY 1", "merged_left"))
def q_count_by_hour(spark, sf):
    return P.count_by(inputs.merged_left(spark, sf), "time_hours")


@register("count_by_mode", sql("SELECT is_taxi, count(*) AS count FROM merged_left GROUP BY 1", "merged_left"))
def q_count_by_mode(spark, sf):
    return P.count_by(inputs.merged_left(spark, sf), "is_taxi")


@register("sensor_counts", sql("""
SELECT borough, year, count(*) AS count FROM sensor_clean GROUP BY 1, 2""", "sensor_clean"))
def q_sensor_counts(spark, sf):
    return P.count_by(sensor.cleaned(fixtures.sensor_raw(spark, sf)), "borough", "year")


# ---------------------------------------------------------------- grouped
@register("grouped_mean", sql(f"""
SELECT beaufort_scale, {rs('avg(temp_f)', 2)} AS avg_temp_f, count(*) AS count
FROM w_enrich GROUP BY 1""", "w_enrich"))
def q_grouped_mean(spark, sf):
    return P.grouped_mean(inputs.enriched_weather(spark, sf), "beaufort_scale", "temp_f",
                          alias="avg_temp_f", order_by_mean=False, with_count=True)


@register("grouped_mean_hour", sql(f"""
SELECT hour, {rs('avg(temp_f)', 2)} AS avg_temp_f FROM w_enrich GROUP BY 1""", "w_enrich"))
def q_grouped_mean_hour(spark, sf):
    return P.grouped_mean(inputs.enriched_weather(spark, sf), "hour", "temp_f", alias="avg_temp_f")


@register("sensor_grouped_mean", sql(f"""
SELECT borough, {rs('avg(airtemp)', 2)} AS avg_airtemp FROM sensor_enrich GROUP BY 1""", "sensor_enrich"))
def q_sensor_grouped_mean(spark, sf):
    e = sensor.enriched(sensor.cleaned(fixtures.sensor_raw(spark, sf)), 2019)
    return P.grouped_mean(e, "borough", "airtemp", alias="avg_airtemp")


# ------------------------------------------------------------- global stats
@register("profile_min_max_avg", sql(f"""
SELECT min(trip_duration) AS trip_duration_min, max(trip_duration) AS trip_duration_max,
       {rs('avg(trip_duration)', 2)} AS trip_duration_avg,
       min(distance) AS distance_min, max(distance) AS distance_max, {rs('avg(distance)', 2)} AS distance_avg,
       min(temp_f) AS temp_f_min, max(temp_f) AS temp_f_max, {rs('avg(temp_f)', 2)} AS temp_f_avg
FROM merged_left""", "merged_left"))
def q_profile_min_max_avg(spark, sf):
    return P.min_max_avg(inputs.merged_left(spark, sf), ["trip_duration", "distance", "temp_f", "not_there"])


_MINMAX = ["temp_f", "hour", "month", "precipitation_mm", "rain_mm", "cloudcover_pct", "windspeed_kmh",
           "wind_direction_deg", "date"]


@register("min_max", sql(f"""
SELECT {', '.join(f'min({c}) AS min_{c}, max({c}) AS max_{c}' for c in _MINMAX)} FROM w_clean""", "w_clean"))
def q_min_max(spark, sf):
    return P.min_max(weather.cleaned(fixtures.weather_raw(spark, sf)), _MINMAX)


@register("global_means", sql(f"""
SELECT {', '.join(f"{rs(f'avg({c})', 4)} AS mean_{c}" for c in WEATHER_STATS)},
       {rs('stddev_samp(temp_f)', 4)} AS stddev_temp_f
FROM w_enrich""", "w_enrich"))
def q_global_means(spark, sf):
    return P.global_means(inputs.enriched_weather(spark, sf), WEATHER_STATS, 4, stddev_of=["temp_f"])


@register("sensor_means", sql(f"""
SELECT {rs('avg(airtemp)', 4)} AS mean_airtemp, {rs('stddev_samp(airtemp)', 4)} AS stddev_airtemp,
       {rs('avg(hour)', 4)} AS mean_hour, {rs('avg(latitude)', 6)} AS mean_latitude,
       {rs('avg(longitude)', 6)} AS mean_longitude
FROM sensor_enrich""", "sensor_enrich"))
def q_sensor_means(spark, sf):
    return sensor.summary_means(sensor.enriched(sensor.cleaned(fixtures.sensor_raw(spark, sf)), 2019))


@register("median_exact", sql(f"""
SELECT {', '.join(f'CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median_{c}' for c in MEDIAN_COLS)}
FROM w_enrich""", "w_enrich"))
def q_median_exact(spark, sf):
    return P.medians_exact(inputs.enriched_weather(spark, sf), MEDIAN_COLS)


@register("median_approx", None)
def q_median_approx(spark, sf):
    return P.medians_approx(inputs.enriched_weather(spark, sf), MEDIAN_COLS, 10000)


@register("mode_exact", sql(_mode_sql("w_enrich", ["temp_f", "hour", "month", "windspeed_kmh"]), "w_enrich"))
def q_mode_exact(spark, sf):
    return P.modes(inputs.enriched_weather(spark, sf), ["temp_f", "hour", "month", "windspeed_kmh"])


@register("mode_text", sql(_mode_sql("w_enrich", ["season", "beaufort_scale"], "VARCHAR"), "w_enrich"))
def q_mode_text(spark, sf):
    return P.modes(inputs.enriched_weather(spark, sf), ["season", "beaufort_scale"], dtype="string")


_HH = ["fare_amount", "tip_amount", "total_amount", "passenger_count", "trip_distance"]


@register("mode_heavy_hitters", sql(_mode_sql("v_taxi_raw", _HH), "v_taxi_raw"))
def q_mode_heavy_hitters(spark, sf):
    aligned = schema.align(fixtures.taxi_raw(spark, sf), trips.TAXI_SUMMARY)
    return P.modes_heavy_hitters(aligned, _HH, 1e-3)


def _summary_sql():
    cols = trips.TAXI_NUMERIC
    arms = " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, (SELECT count(*) FROM v_taxi_raw) AS record_count,
       (SELECT {rs('stddev_samp(total_amount)', 6)} FROM v_taxi_raw) AS total_amount_stddev,
       (SELECT {rs(f'avg({c})', 6)} FROM v_taxi_raw) AS mean,
       (SELECT CAST(quantile_disc({c}, 0.5) AS DOUBLE) FROM v_taxi_raw) AS median,
       (SELECT mode FROM ({_mode_sql('v_taxi_raw', [c])}) m) AS mode""" for c in cols)
    return sql(arms, "v_taxi_raw")


@register("dataset_summary", _summary_sql())
def q_dataset_summary(spark, sf):
    return P.dataset_summary(schema.align(fixtures.taxi_raw(spark, sf), trips.TAXI_SUMMARY),
                             trips.TAXI_NUMERIC, stddev_of="total_amount", digits=6)


def _stats_sql():
    b = "v_bike_raw"
    names = list(BIKE_STATS.items())
    mean = ", ".join(f'{rs(f"avg(\"{c}\")", 6)} AS {a}' for c, a in names)
    med = ", ".join(f'CAST(quantile_disc("{c}", 0.5) AS DOUBLE) AS {a}' for c, a in names)
    mode = ", ".join(f'(SELECT v FROM (SELECT "{c}" AS v, count(*) AS n FROM {b} WHERE "{c}" IS NOT NULL '
                     f'GROUP BY 1 ORDER BY 2 DESC, 1 ASC LIMIT 1) q) AS {a}' for c, a in names)
    return sql(f"SELECT 'Mean' AS Stat_Type, {mean} FROM {b} UNION ALL SELECT 'Median', {med} FROM {b} "
               f"UNION ALL SELECT 'Mode', {mode}", b)


@register("stats_table", _stats_sql())
def q_stats_table(spark, sf):
    return P.stats_table(trips.bike_profiled(fixtures.bike_raw(spark, sf)), BIKE_STATS, digits=6)


# ------------------------------------------------------------------ distinct
_DISTINCT = ["temp_f", "date", "hour", "month", "year", "precipitation_mm", "rain_mm", "cloudcover_pct",
             "windspeed_kmh", "wind_direction_deg"]


@register("distinct_counts", sql(f"""
SELECT {', '.join(f'count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_{c}' for c in _DISTINCT)}
FROM w_clean""", "w_clean"))
def q_distinct_counts(spark, sf):
    return P.distinct_counts(weather.cleaned(fixtures.weather_raw(spark, sf)), _DISTINCT)


@register("sensor_distinct_counts", sql(f"""
SELECT {', '.join(f'count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_{c}' for c in sensor.REQUIRED)}
FROM sensor_clean""", "sensor_clean"))
def q_sensor_distinct_counts(spark, sf):
    return sensor.profile_counts(sensor.cleaned(fixtures.sensor_raw(spark, sf)))


@register("distinct_values", sql("SELECT DISTINCT hour FROM w_clean", "w_clean"))
def q_distinct_values(spark, sf):
    return P.distinct_values(weather.cleaned(fixtures.weather_raw(spark, sf)), "hour")


@register("distinct_bounded", sql("""
SELECT trip_distance, (SELECT count(*) FROM (SELECT DISTINCT trip_distance FROM v_taxi_raw
                       WHERE trip_distance IS NOT NULL ORDER BY 1 LIMIT 11) x) > 10 AS has_more
FROM (SELECT DISTINCT trip_distance FROM v_taxi_raw WHERE trip_distance IS NOT NULL ORDER BY 1 LIMIT 10) d""",
                                  "v_taxi_raw"))
def q_distinct_bounded(spark, sf):
    return P.distinct_bounded(trips.taxi_kept(fixtures.taxi_raw(spark, sf)), "trip_distance", 10)


@register("distinct_categorical", sql("""
SELECT DISTINCT PULocationID, false AS has_more FROM v_taxi_raw WHERE PULocationID IS NOT NULL""", "v_taxi_raw"))
def q_distinct_categorical(spark, sf):
    return P.distinct_bounded(trips.taxi_kept(fixtures.taxi_raw(spark, sf)), "PULocationID", categorical=True)


# fixed values: the published columns, and which are categorical
_TAXI_DISTINCT = {"tpep_pickup_datetime": False, "tpep_dropoff_datetime": False, "trip_distance": False,
                  "PULocationID": True, "DOLocationID": True}


def _distinct_sql(c, categorical, limit=10):
    values = f"SELECT DISTINCT {c} AS v FROM v_taxi_raw WHERE {c} IS NOT NULL"
    if categorical:
        return f"SELECT '{c}' AS column_name, CAST(v AS VARCHAR) AS value, false AS has_more FROM ({values}) d"
    return f"""SELECT '{c}' AS column_name, CAST(v AS VARCHAR) AS value, (SELECT count(*) FROM ({values}) n) > {limit} AS has_more
        FROM ({values} ORDER BY 1 LIMIT {limit}) d"""


@register("distinct_report", sql(" UNION ALL ".join(_distinct_sql(c, k) for c, k in _TAXI_DISTINCT.items()), "v_taxi_raw"))
def q_distinct_report(spark, sf):
    return P.distinct_report(trips.taxi_kept(fixtures.taxi_raw(spark, sf)), _TAXI_DISTINCT, 10)


_PREVIEW = ["ride_id", "rideable_type", "start_station_name", "end_station_name", "start_lat", "start_lng",
            "end_lat", "end_lng"]


@register("distinct_preview", sql(" UNION ALL ".join(
    f"SELECT * FROM (SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM v_bike_new "
    f"WHERE {c} IS NOT NULL ORDER BY 2 LIMIT 3)" for c in _PREVIEW), "v_bike_new"))
def q_distinct_preview(spark, sf):
    return P.distinct_preview(fixtures.bike_new(spark, sf), _PREVIEW, 3)


# ------------------------------------------------------------ null / describe
@register("profile_null_counts", sql(f"""
SELECT {', '.join(f'CAST(count_if({c} IS NULL) AS BIGINT) AS {c}' for c in MERGED_COLS)} FROM merged_left""", "merged_left"))
def q_profile_null_counts(spark, sf):
    return P.null_counts(inputs.merged_left(spark, sf))


@register("describe_typed", sql(" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS count, {rs(f'avg({c})', 6)} AS mean,
       {rs(f'stddev_samp({c})', 6)} AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max
FROM merged_left""" for c in MERGED_NUMERIC), "merged_left"))
def q_describe_typed(spark, sf):
    return P.describe_typed(inputs.merged_left(spark, sf), MERGED_NUMERIC, digits=6)


@register("describe", None)
def q_describe(spark, sf):
    return P.describe(inputs.merged_left(spark, sf), MERGED_NUMERIC)


# -------------------------------------------------------------- sort / top-k
@register("top_dates", sql("""
SELECT date, count(*) AS count FROM merged_left GROUP BY 1 ORDER BY 2 DESC, 1 ASC LIMIT 10""", "merged_left"))
def q_top_dates(spark, sf):
    return P.top_k(inputs.merged_left(spark, sf), "date", 10)


@register("preview", sql(f"""
SELECT * FROM merged_left ORDER BY {', '.join(f'{c} NULLS FIRST' for c in MERGED_COLS)} LIMIT 20""",
                         "merged_left"))
def q_preview(spark, sf):
    return P.preview(inputs.merged_left(spark, sf), 20)


_MERGED_TYPES = {"date": "date", "time_hours": "int", "is_taxi": "int", "season": "string", "beaufort_scale": "string",
                 "isHot": "int", "isWindy": "int"}


@register("schema_report", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {i} AS position, '{_MERGED_TYPES.get(c, 'double')}' AS data_type, {c != 'is_taxi'} AS nullable, "
    f"count(*) AS rows, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls FROM merged_left" for i, c in enumerate(MERGED_COLS)), "merged_left"))
def q_schema_report(spark, sf):
    return P.schema_profile(inputs.merged_left(spark, sf))


_BIKE_RAW_COLS = ["tripduration", "starttime", "stoptime", "start station name", "start station latitude",
                  "start station longitude", "end station name", "end station latitude", "end station longitude",
                  "bikeid", "usertype"]


@register("null_counts_sql", sql(
    "SELECT " + ", ".join(f'CAST(count_if("{c}" IS NULL) AS BIGINT) AS "{c}"' for c in _BIKE_RAW_COLS)
    + " FROM v_bike_raw",
    "v_bike_raw"))
def q_null_counts_sql(spark, sf):
    return P.null_counts_sql(fixtures.bike_raw(spark, sf))


@register("median_approx_gk", None)
def q_median_approx_gk(spark, sf):
    return P.approx_medians_table(fixtures.bike_raw(spark, sf), list(BIKE_STATS), 0.001)


@register("table_profile", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {i} AS position, count(*) AS rows, {len(MERGED_COLS)} AS columns, "
    f"CAST(count_if({c} IS NULL) AS BIGINT) AS nulls FROM merged_left" for i, c in enumerate(MERGED_COLS, 1)), "merged_left"))
def q_table_profile(spark, sf):
    return P.table_profile(inputs.merged_left(spark, sf)).drop("dtype", "distinct_approx")


@register("sample_rows", sql("SELECT count(*) AS sampled, 0::BIGINT AS strangers FROM (SELECT * FROM v_bike_new LIMIT 15) s",
                             "v_bike_new"))
def q_sample_rows(spark, sf):
    """Which rows come is open: how many, and that all are the table's, is not."""
    df = fixtures.bike_new(spark, sf)
    some = P.sample_rows(df, 15)
    known = df.select("ride_id").withColumn("known", F.lit(1)).distinct()
    return some.join(known, "ride_id", "left").agg(
        F.count(F.lit(1)).alias("sampled"), F.count_if(F.col("known").isNull()).alias("strangers"))


_TRIP_NUMBERS = ["trip_duration", "distance", "start_latitude", "start_longitude"]


@register("median_trips", sql("SELECT " + ", ".join(
    f"CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median_{c}" for c in _TRIP_NUMBERS) + " FROM v_trips", "v_trips"))
def q_median_trips(spark, sf):
    return P.medians_exact(fixtures.trips(spark, sf), _TRIP_NUMBERS)


@register("mode_trips", sql(_mode_sql("v_trips", _TRIP_NUMBERS), "v_trips"))
def q_mode_trips(spark, sf):
    return P.modes(fixtures.trips(spark, sf), _TRIP_NUMBERS)


@register("distinct_trips", sql("SELECT " + ", ".join(
    f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_{c}" for c in _TRIP_NUMBERS) + " FROM v_trips", "v_trips"))
def q_distinct_trips(spark, sf):
    return P.distinct_counts(fixtures.trips(spark, sf), _TRIP_NUMBERS)


_CHECKED = ["trip_duration", "distance", "start_latitude"]


def _rank_sql():
    arms = [f"SELECT '{m}' AS method, '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS rows, true AS within FROM v_trips"
            for m in ("percentile_approx", "approx_quantile", "stored_sketch") for c in _CHECKED]
    return sql(" UNION ALL ".join(arms), "v_trips")


@register("median_rank_check", _rank_sql())
def q_median_rank_check(spark, sf):
    """The three approximate medians, each with the rank that it truly has
    against the rank error that it promises.  The stored one comes from sketches per day, merged."""
    df = fixtures.trips(spark, sf)
    path = scratch_path(spark, "quantile_sketches")
    sketches.quantile_sketches(df, _CHECKED, by=["date"]).write.partitionBy("date").parquet(path)
    wide = P.medians_approx(df, _CHECKED, 10_000)
    gk = P.approx_medians_table(df, _CHECKED, 0.001)
    pairs = ", ".join(f"'{c}', CAST(median_{c} AS DOUBLE)" for c in _CHECKED)
    answers = {
        "percentile_approx": (wide.selectExpr(f"stack({len(_CHECKED)}, {pairs}) AS (column_name, quantile)"), 1e-4),
        "approx_quantile": (gk.selectExpr(f"stack({len(_CHECKED)}, {pairs}) AS (column_name, quantile)"), 0.001),
        "stored_sketch": (sketches.sketched_quantiles(spark.read.parquet(path), 0.5), 3 * sketches.quantile_error())}
    return functools.reduce(DataFrame.unionByName, [
        sketches.rank_check(df, a.select("column_name", "quantile"), 0.5, error).select(
            F.lit(name).alias("method"), "column_name", "rows", "within") for name, (a, error) in answers.items()])


@register("distinct_sketch_check", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct, true AS within FROM v_trips" for c in _TRIP_NUMBERS), "v_trips"))
def q_distinct_sketch_check(spark, sf):
    """Exact distinct counts, one narrow scan per column, and whether the
    estimates from stored sketches per day, merged, keep their error."""
    df = fixtures.trips(spark, sf)
    path = scratch_path(spark, "distinct_sketches")
    sketches.distinct_sketches(df, _TRIP_NUMBERS, by=["date"]).write.partitionBy("date").parquet(path)
    approx = sketches.sketched_distinct(spark.read.parquet(path))
    return sketches.error_check(approx, sketches.distinct_by_column(df, _TRIP_NUMBERS), 4 * sketches.distinct_error())


def _merged_sql():
    arms = [f"""
SELECT '{c}' AS column_name, CAST(count(*) AS BIGINT) AS rows, CAST(count({c}) AS BIGINT) AS "values",
       {rs(f'avg({c})', 6)} AS mean, {rs(f'stddev_samp({c})', 6)} AS stddev,
       CAST(quantile_disc({c}, 0.9) AS DOUBLE) AS p90, (SELECT mode FROM ({_mode_sql('v_trips', [c])}) m) AS mode
FROM v_trips""" for c in _CHECKED]
    return sql(" UNION ALL ".join(arms), "v_trips")


@register("value_counts_merged", _merged_sql())
def q_value_counts_merged(spark, sf):
    """Moments, an exact quantile and the mode from two stored states, one
    per kind of trip, merged: the trips themselves are read once."""
    df = fixtures.trips(spark, sf)
    path = scratch_path(spark, "value_counts")
    for kind in (0, 1):
        value_counts.count_values(df.filter(F.col("is_taxi") == kind), _CHECKED).write.parquet(f"{path}/{kind}")
    state = value_counts.merge_counts([spark.read.parquet(f"{path}/{kind}") for kind in (0, 1)])
    p90 = spark.createDataFrame(list(value_counts.quantiles_of(state, 0.9).items()), "column_name string, p90 double")
    mode = value_counts.modes_of(state).select("column_name", F.coalesce(F.col("whole").cast("double"), "real").alias("mode"))
    out = value_counts.moments_of(state).join(p90, "column_name", "left").join(mode, "column_name", "left")
    return out.withColumns({c: round_stable(c, 6) for c in ("mean", "stddev")})
