"""Path-to-path jobs, one per published pipeline.

Every path, year and threshold is a parameter.  Large outputs are written
in parallel (optionally partitioned by date); a single file is written
only for outputs whose size is bounded by construction (hourly weather, the
bucket aggregates, the zone lookup).  Jobs return small reports
(DataFrames or row counts), never the data itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwx.operators import ml, profile, schema
from tripwx.plans import analytics, merge, sensor, trips, weather
from tripwx.sources import csv as csv_src
from tripwx.sources import parquet as pq
from tripwx.sources import sinks

WEATHER_TABLE_DDL = ("`timestamp` timestamp_ntz, date date, hour int, month int, year string, temp_f double, "
                     "precipitation_mm double, rain_mm double, cloudcover_pct double, windspeed_kmh double, "
                     "wind_direction_deg double")


# ------------------------------------------------------------------ weather
def weather_clean_job(spark: SparkSession, csv_path: str, out_path: str,
                      table: str | None = None, schema_ddl: str | None = None) -> int:
    """Raw hourly CSV -> cleaned Parquet (+ optional external table).
    ``schema_ddl`` (here and below) saves the pass that infers the types."""
    cleaned = weather.cleaned(csv_src.scan_csv(spark, csv_path, infer=True, schema=schema_ddl))
    sinks.write_single_file(cleaned, out_path)        # hourly rows: bounded by the time span
    if table:
        sinks.external_parquet_table(spark, table, WEATHER_TABLE_DDL, out_path)
    return spark.read.parquet(out_path).count()


def weather_enrich_job(spark: SparkSession, cleaned_path: str, out_path: str, year: int,
                       table: str | None = None) -> dict[str, DataFrame]:
    """Year filter, season/Beaufort/flags; writes the table and returns
    the published profile sections."""
    enriched = weather.enriched(spark.read.parquet(cleaned_path), year)
    sinks.write_single_file(enriched, out_path)
    if table:
        sinks.save_table(spark.read.parquet(out_path), table)
    e = spark.read.parquet(out_path)
    return {
        "by_hot": profile.count_by(e, "isHot"),
        "by_windy": profile.count_by(e, "isWindy"),
        "by_beaufort": profile.count_by(e, "beaufort_scale"),
        "medians": profile.medians_approx(e, ["temp_f", "hour", "precipitation_mm", "windspeed_kmh"]),
        "means": profile.global_means(e, ["temp_f", "hour", "precipitation_mm", "rain_mm", "cloudcover_pct",
                                          "windspeed_kmh", "wind_direction_deg"], 4, stddev_of=["temp_f"]),
        "modes": profile.modes(e, ["temp_f", "hour", "month"]),
        "text_modes": profile.modes(e, ["season", "beaufort_scale"], dtype="string"),
        "by_month": profile.grouped_mean(e, "month", "temp_f", alias="avg_temp_f", order_by_mean=False),
        "by_season": profile.grouped_mean(e, "season", "temp_f", alias="avg_temp_f"),
        "by_beaufort_mean": profile.grouped_mean(e, "beaufort_scale", "temp_f", alias="avg_temp_f",
                                                 order_by_mean=False, with_count=True),
    }


def weather_publish_job(spark: SparkSession, enriched_path: str, out_paths: list[str]) -> int:
    """Join-ready hourly weather written to every target."""
    ready = weather.join_ready(spark.read.parquet(enriched_path))
    sinks.write_many(ready.repartition(1), [("parquet", p) for p in out_paths])
    return spark.read.parquet(out_paths[0]).count()


# -------------------------------------------------------------------- taxi
def taxi_ingest_job(spark: SparkSession, input_path: str, lookup_csv: str, out_path: str) -> int:
    """Raw taxi Parquet + zone CSV -> canonical trips."""
    raw = pq.scan_aligned(spark, pq.discover(spark, input_path), trips.TAXI_SOURCE)
    zones = csv_src.scan_lookup_csv(spark, lookup_csv)
    sinks.write_parquet(trips.taxi_trips(raw, zones), out_path)
    return spark.read.parquet(out_path).count()


def taxi_clean_job(spark: SparkSession, input_path: str, out_path: str) -> int:
    """E5: drifting monthly files -> one aligned table of the kept columns."""
    df = pq.scan_aligned(spark, pq.discover(spark, input_path), trips.TAXI_KEPT)
    sinks.write_parquet(df, out_path)
    return spark.read.parquet(out_path).count()


def taxi_summary_job(spark: SparkSession, input_path: str, out_path: str) -> DataFrame:
    """One-pass summary (count, stddev, means, medians, modes) and the
    trip-length table."""
    df = pq.scan_aligned(spark, pq.discover(spark, input_path), trips.TAXI_SUMMARY)
    sinks.write_parquet(trips.taxi_with_lengths(df), out_path)
    return profile.dataset_summary(df, trips.TAXI_NUMERIC, stddev_of="total_amount")


# -------------------------------------------------------------------- bike
def bike_ingest_job(spark: SparkSession, csv_glob: str, out_path: str, distance_unit: str = "mi",
                    duration_unit: str = "s", dropna_scope: str = "all", schema_ddl: str | None = None) -> int:
    """Monthly CSVs -> canonical trips (haversine distance, in miles as
    the taxi trips have theirs; ``distance_unit="km"`` is the published form)."""
    raw = csv_src.scan_csv(spark, csv_glob, infer=True, schema=schema_ddl)
    sinks.write_parquet(trips.bike_trips(raw, dropna_scope, distance_unit, duration_unit), out_path)
    return spark.read.parquet(out_path).count()


def bike_stats_job(spark: SparkSession, csv_glob: str, out_path: str, schema_ddl: str | None = None) -> dict[str, DataFrame]:
    """Normalised names and flags written; returns the Mean/Median/Mode
    table and the sample standard deviation of the start latitude."""
    cleaned = trips.bike_profiled(csv_src.scan_csv(spark, csv_glob, infer=True, schema=schema_ddl))
    sinks.write_parquet(cleaned, out_path)
    written = spark.read.parquet(out_path)
    stats = profile.stats_table(written, {"start station latitude": "Start_Lat",
                                          "start station longitude": "Start_Lng",
                                          "end station latitude": "End_Lat",
                                          "end station longitude": "End_Lng"})
    stddev = written.agg(F.stddev_samp(F.col("`start station latitude`")).alias("stddev_start_lat"))
    return {"stats": stats, "stddev": stddev}


def bike_new_format_job(spark: SparkSession, csv_path: str, out_path: str, data_year: int, schema_ddl: str | None = None) -> int:
    """New-format bike CSV -> cleaned CSV."""
    df = trips.bike_new_format(csv_src.scan_csv(spark, csv_path, infer=True, schema=schema_ddl), data_year)
    sinks.write_csv(df, out_path)
    return spark.read.option("header", "true").csv(out_path).count()


# ------------------------------------------------------------------- merges
def merge_left_job(spark: SparkSession, taxi_path: str, bike_path: str, weather_path: str,
                   out_path: str, table: str | None = None, files_per_date: int | None = None) -> int:
    """Trips (positional union) LEFT JOIN hourly weather, written
    partitioned by date so later date filters prune files."""
    merged = merge.merge_left(spark.read.parquet(taxi_path), spark.read.parquet(bike_path),
                              spark.read.parquet(weather_path))
    sinks.write_parquet(merged, out_path, partition_by=["date"], files_per_value=files_per_date)
    if table:
        sinks.save_table(spark.read.parquet(out_path), table)
    return spark.read.parquet(out_path).count()


def merge_inner_job(spark: SparkSession, bike_path: str, taxi_path: str, weather_path: str,
                    out_path: str, files_per_date: int | None = None) -> int:
    """By-name union, INNER join, NULL drop, dedup."""
    merged = merge.merge_inner(spark.read.parquet(bike_path), spark.read.parquet(taxi_path),
                               spark.read.parquet(weather_path))
    sinks.write_parquet(merged, out_path, partition_by=["date"], files_per_value=files_per_date)
    return spark.read.parquet(out_path).count()


def clean_strict_job(spark: SparkSession, in_path: str, out_path: str | None = None) -> DataFrame:
    """Strict clean; ``out_path`` may equal ``in_path`` (safe swap).
    Returns (rows_before, rows_after)."""
    raw = spark.read.parquet(in_path)
    before = raw.count()
    after = sinks.safe_overwrite(merge.clean_strict(raw), out_path or in_path)
    return spark.createDataFrame([(before, after)], "rows_before long, rows_after long")


def clean_impute_job(spark: SparkSession, in_path: str, out_path: str, year: int,
                     table: str | None = None, files_per_date: int | None = None) -> dict[str, DataFrame]:
    """Outlier filter, mean imputation, month segments; returns the
    stage funnel, the segment counts and the post-clean NULL counts."""
    merged = spark.read.parquet(in_path)
    out, funnel = merge.clean_impute_counted(merged, year)
    sinks.write_parquet(out, out_path, partition_by=["date"], files_per_value=files_per_date)
    if table:
        sinks.save_table(spark.read.parquet(out_path), table)
    written = spark.read.parquet(out_path)
    return {
        "funnel": funnel,
        "segments": profile.count_by(written, "month", "month_segment"),
        "nulls": profile.null_counts(written, merge.WEATHER_MEASURES[:5] + ["trip_duration", "distance"]),
    }


def profile_job(spark: SparkSession, in_path: str) -> dict[str, DataFrame]:
    """The table profile."""
    df = spark.read.parquet(in_path)
    numeric = ["trip_duration", "distance", "start_latitude", "start_longitude", "time_hours", "temp_f",
               "precipitation_mm", "rain_mm", "cloudcover_pct", "windspeed_kmh", "wind_direction_deg"]
    out = profile.profile(df, numeric, ["trip_duration", "distance", "temp_f"])
    out["schema"] = schema.schema_report(spark, df)
    return out


def analytics_job(spark: SparkSession, merged_path: str, out_dir: str) -> dict[str, str]:
    """The two published aggregates as single CSV files (each has at
    most (#temperature buckets x 2) rows)."""
    merged = spark.read.parquet(merged_path)
    paths = {"taxi_bike_temp": f"{out_dir}/taxi_bike_temp", "weather_duration": f"{out_dir}/weather_duration"}
    sinks.write_single_file(analytics.temp_bucket_counts(merged), paths["taxi_bike_temp"], fmt="csv")
    sinks.write_single_file(analytics.weather_duration(merged), paths["weather_duration"], fmt="csv")
    return paths


# ----------------------------------------------------------------------- ML
def train_job(spark: SparkSession, merged_path: str, model_path: str,
              key_cols: list[str] | None = None) -> dict[str, DataFrame]:
    """Balanced random forest; saves the pipeline model."""
    merged = spark.read.parquet(merged_path)
    model, pred = ml.train(merged, key_cols or ["date", "time_hours", "start_longitude", "start_latitude",
                                                "trip_duration", "distance"])
    ml.save(model, model_path)
    return {"metrics": ml.metrics(pred), "confusion": ml.confusion_matrix(pred)}


def score_job(spark: SparkSession, model_path: str, trips_path: str, out_path: str,
              keep_unscored: bool = False) -> int:
    """Batch scoring of a trips table with a saved model."""
    scored = ml.score(ml.load(model_path), spark.read.parquet(trips_path), keep_unscored)
    sinks.write_parquet(scored, out_path)
    return spark.read.parquet(out_path).count()


# ------------------------------------------------------------------- sensor
def sensor_job(spark: SparkSession, csv_path: str, cleaned_path: str, enriched_path: str,
               year: int, schema_ddl: str | None = None) -> dict[str, DataFrame]:
    """Sensor clean -> profile -> enrich."""
    cleaned = sensor.cleaned(csv_src.scan_csv(spark, csv_path, infer=True, schema=schema_ddl))
    sinks.write_parquet(cleaned, cleaned_path)
    c = spark.read.parquet(cleaned_path)
    enriched = sensor.enriched(c, year)
    sinks.write_parquet(enriched, enriched_path)
    e = spark.read.parquet(enriched_path)
    return {
        "by_borough": profile.count_by(c, "borough"),
        "by_year": profile.count_by(c, "year"),
        "distinct": sensor.profile_counts(c),
        "min_max": profile.min_max(c, ["airtemp", "hour", "latitude", "longitude", "day"]),
        "medians": profile.medians_approx(e, ["airtemp", "hour", "latitude", "longitude"]),
        "means": sensor.summary_means(e),
        "modes": profile.modes(e, ["airtemp", "hour"]),
        "text_modes": profile.modes(e, ["borough", "ntacode"], dtype="string"),
        "by_borough_mean": profile.grouped_mean(e, "borough", "airtemp", alias="avg_airtemp"),
    }

