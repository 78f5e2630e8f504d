"""Registered queries: sources and sinks.

Each query writes data that Spark derives from the driver's tables to a
fresh folder under the shared checkpoint folder (``spark.checkpoint.dir``)
and reads it back through the source under test.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tripwx.plans import analytics, fixtures, inputs, jobs, merge, trips, weather
from tripwx.plans.oracle import DATA_YEAR, rs, sql
from tripwx.plans.register import register
from tripwx.session import scratch_path
from tripwx.sources import catalogue, sinks, versions
from tripwx.sources import csv as csv_src
from tripwx.sources import parquet as pq

DB = "tripwx_db"
#: rows a file, at most, where a query writes the several files that a source is to find
FILE_ROWS = 1 << 17


def _ntz(df, cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _database(spark):
    sinks.ensure_database(spark, DB, scratch_path(spark, "warehouse"))
    return DB


# ------------------------------------------------------------------ sources
@register("scan_parquet", sql("""
SELECT event_id, event_type, value FROM events"""))
def q_scan_parquet(spark, sf):
    # header / inferSchema are CSV options: the Parquet reader ignores them
    return pq.scan(spark, f"{sf}/events.parquet", columns=["event_id", "event_type", "value"],
                   header="true", inferSchema="true")


@register("scan_multi_path", sql("SELECT * FROM v_trips", "v_trips"))
def q_scan_multi_path(spark, sf):
    t = fixtures.trips(spark, sf)
    base = scratch_path(spark, "multi")
    paths = []
    for i in range(3):
        p = f"{base}/part{i}"
        sinks.write_parquet(t.filter(F.col("time_hours") % 3 == i), p)
        paths.append(p)
    return pq.scan(spark, *paths)


@register("scan_glob", sql("""
SELECT CAST(tpep_pickup_datetime AS TIMESTAMP) AS tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance,
       PULocationID, DOLocationID FROM v_taxi_raw""", "v_taxi_raw"))
def q_scan_glob(spark, sf):
    kept = trips.taxi_kept(fixtures.taxi_raw(spark, sf))
    folder = scratch_path(spark, "glob")
    sinks.write_parquet(kept, folder, max_records_per_file=FILE_ROWS)
    # a nested folder and a non-Parquet file that discovery must skip
    sinks.write_parquet(kept, f"{folder}/nested")
    spark.createDataFrame([("not data",)], "t string").write.mode("overwrite").text(f"{folder}/notes")
    return _ntz(pq.scan_dataset(spark, folder), ["tpep_pickup_datetime", "tpep_dropoff_datetime"])


_DRIFT = """
SELECT tpep_pickup_datetime, tpep_dropoff_datetime, fare_amount, tip_amount, total_amount,
       CASE WHEN PULocationID % 5 = 4 THEN NULL ELSE passenger_count END AS passenger_count, trip_distance
FROM v_taxi_raw"""


def _write_drifting(spark, sf, label):
    """Raw taxi rows in files whose passenger count is of four types or absent."""
    raw = fixtures.taxi_raw(spark, sf).withColumns(
        {c: F.col(c).cast("timestamp") for c in ["tpep_pickup_datetime", "tpep_dropoff_datetime"]})
    base = scratch_path(spark, label)
    k, n = F.col("PULocationID") % 5, F.col("passenger_count")
    kinds = {"int": n.cast("int"), "bigint": n.cast("bigint"), "double": n.cast("double"), "string": n.cast("string"), "none": None}
    for i, (kind, column) in enumerate(kinds.items()):
        part = raw.filter(k == i)
        part = part.drop("passenger_count") if column is None else part.withColumn("passenger_count", column)
        sinks.write_parquet(part, f"{base}/{kind}")
    return base, [f for kind in kinds for f in pq.discover(spark, f"{base}/{kind}")]


@register("scan_schema_drift", sql(_DRIFT, "v_taxi_raw"))
def q_scan_schema_drift(spark, sf):
    _, files = _write_drifting(spark, sf, "drift")
    df = pq.scan_aligned(spark, files, trips.TAXI_SUMMARY)
    return _ntz(df, ["tpep_pickup_datetime", "tpep_dropoff_datetime"])


@register("scan_schema_drift_spark", sql(_DRIFT, "v_taxi_raw"))
def q_scan_schema_drift_spark(spark, sf):
    """The same by Spark's reader alone, for stores that only it reaches."""
    _, files = _write_drifting(spark, sf, "drift_spark")
    df = pq.scan_aligned(spark, files, trips.TAXI_SUMMARY, strategy="spark")
    return _ntz(df, ["tpep_pickup_datetime", "tpep_dropoff_datetime"])


@register("file_catalogue", sql("""
SELECT CASE PULocationID % 5 WHEN 0 THEN 'integer' WHEN 1 THEN 'long' WHEN 2 THEN 'double' WHEN 3 THEN 'string' ELSE 'none' END
         AS passenger_type, CAST(count(*) AS BIGINT) AS rows, true AS planned
FROM v_taxi_raw GROUP BY 1""", "v_taxi_raw"))
def q_file_catalogue(spark, sf):
    """A stored catalogue of the drifting files, made, then brought up to
    date after nothing changed: rows per type, from the footers alone, and
    whether the catalogue plans a scan of the files."""
    base, files = _write_drifting(spark, sf, "catalogue")
    location = scratch_path(spark, "catalogue_table")
    catalogue.update(spark, location, base)
    stored = catalogue.update(spark, location, base)
    planned = sorted(p for _, paths in catalogue.schema_groups(stored) for p in paths) == sorted(files)
    found = F.regexp_extract("schema", r'"passenger_count", "(\w+)"', 1)
    return (stored.groupBy(F.when(found == "", "none").otherwise(found).alias("passenger_type"))
            .agg(F.sum("rows").alias("rows"), F.lit(planned).alias("planned")).filter("rows > 0"))


@register("scan_csv_infer", sql("SELECT * FROM w_clean", "w_clean"))
def q_scan_csv_infer(spark, sf):
    path = scratch_path(spark, "weather_csv")
    sinks.write_csv(fixtures.weather_raw(spark, sf), path)
    return weather.cleaned(csv_src.scan_csv(spark, path, infer=True))


@register("scan_csv_glob", sql("""
SELECT start_longitude, start_latitude, time_hours, date, trip_duration, round(distance, 6) AS distance, is_taxi
FROM bike_trips""", "bike_trips"))
def q_scan_csv_glob(spark, sf):
    folder = scratch_path(spark, "bike_csv")
    sinks.write_csv(fixtures.bike_raw(spark, sf), folder, max_records_per_file=FILE_ROWS)
    raw = csv_src.scan_csv(spark, f"{folder}/*.csv", infer=True)
    return trips.bike_trips(raw).withColumn("distance", F.round("distance", 6))


def write_zone_csv(spark, sf, path, short_every=41, header="locationID,Borough,Zone,service_zone,x,y"):
    """Zone lookup as CSV text: quoted names with commas and doubled quotes,
    and every ``short_every``-th row cut short (to be dropped as malformed)."""
    z = fixtures.zones(spark, sf)

    def quoted(c):
        return F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))
    full = F.concat_ws(",", "LocationID", "Borough", quoted("Zone"), "service_zone",
                       F.coalesce("longitude", F.lit("")), F.coalesce("latitude", F.lit("")))
    short = F.concat_ws(",", "LocationID", "Borough", quoted("Zone"))
    lines = z.select(F.when(F.col("LocationID").cast("bigint") % short_every == 0, short)
                     .otherwise(full).alias("value"))
    head = spark.createDataFrame([(header,)], "value string")
    # the lookup is small (one row per zone), so one file with the header first
    head.union(lines).coalesce(1).write.mode("overwrite").text(path)
    return path


@register("lookup_csv", sql("""
SELECT TRY_CAST(LocationID AS BIGINT) AS PULocationID, Zone, TRY_CAST(longitude AS DOUBLE) AS lookup_longitude,
       TRY_CAST(latitude AS DOUBLE) AS lookup_latitude
FROM v_zones WHERE CAST(LocationID AS BIGINT) % 41 <> 0""", "v_zones"))
def q_lookup_csv(spark, sf):
    path = write_zone_csv(spark, sf, scratch_path(spark, "zones_csv"))
    raw = csv_src.scan_lookup_csv(spark, path, ["locationID", "Borough", "Zone", "service_zone", "x", "y"])
    lk = trips.zone_lookup(raw)
    return lk.join(raw.select(F.col("locationID").try_cast("bigint").alias("PULocationID"), "Zone"),
                   "PULocationID")


@register("lookup_csv_rejects", sql("""
SELECT CASE WHEN CAST(LocationID AS BIGINT) % 41 = 0 THEN 'too few fields' ELSE 'kept' END AS outcome, count(*) AS lines
FROM v_zones GROUP BY 1""", "v_zones"))
def q_lookup_csv_rejects(spark, sf):
    """How many lines of the lookup are kept, and how many rejected, by reason."""
    path = write_zone_csv(spark, sf, scratch_path(spark, "zones_csv_checked"))
    rows, rejects = csv_src.scan_lookup_csv_checked(spark, path)
    both = rows.select(F.lit("kept").alias("outcome")).unionByName(rejects.select(F.col("reason").alias("outcome")))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("lines"))


# -------------------------------------------------------------------- sinks
@register("sink_parquet", sql("SELECT * FROM merged_left", "merged_left"))
def q_sink_parquet(spark, sf):
    path = scratch_path(spark, "merged")
    sinks.write_parquet(inputs.merged_left(spark, sf), path, partition_by=["date"], files_per_value=4)
    return spark.read.parquet(path)


@register("sink_csv", sql(f"""
SELECT round(temp_f / 5, 0) * 5 + 0.0 AS temp_bucket, is_taxi,
       {rs('avg(trip_duration)', 2)} AS avg_duration,
       {rs('avg(precipitation_mm)', 2)} AS avg_precip,
       {rs('avg(windspeed_kmh)', 2)} AS avg_wind,
       count(*) AS trip_count
FROM merged_left GROUP BY 1, 2""", "merged_left"))
def q_sink_csv(spark, sf):
    path = scratch_path(spark, "weather_duration_csv")
    sinks.write_single_file(analytics.weather_duration(inputs.merged_left(spark, sf)), path, fmt="csv")
    return csv_src.scan_csv(spark, path, schema="temp_bucket double, is_taxi int, avg_duration double, "
                                                "avg_precip double, avg_wind double, trip_count bigint")


@register("sink_table", sql("SELECT * FROM w_pub", "w_pub"))
def q_sink_table(spark, sf):
    table = f"{_database(spark)}.weather_{uuid.uuid4().hex[:8]}"
    sinks.save_table(inputs.published_weather(spark, sf), table)
    return spark.table(table)


@register("sink_many", sql("SELECT * FROM w_pub UNION ALL SELECT * FROM w_pub", "w_pub"))
def q_sink_many(spark, sf):
    base = scratch_path(spark, "many")
    sinks.write_many(inputs.published_weather(spark, sf), [("parquet", f"{base}/a"), ("parquet", f"{base}/b")])
    return spark.read.parquet(f"{base}/a").unionByName(spark.read.parquet(f"{base}/b"))


@register("external_table", sql("SELECT * FROM w_clean", "w_clean"))
def q_external_table(spark, sf):
    path = scratch_path(spark, "weather_cleaned")
    sinks.write_single_file(weather.cleaned(fixtures.weather_raw(spark, sf)), path)
    table = f"{_database(spark)}.weather_cleaned_{uuid.uuid4().hex[:8]}"
    ddl = ("`timestamp` timestamp_ntz, date date, hour int, month int, year string, temp_f double, "
           "precipitation_mm double, rain_mm double, cloudcover_pct double, windspeed_kmh double, "
           "wind_direction_deg double")
    sinks.external_parquet_table(spark, table, ddl, path).collect()
    return spark.table(table)


@register("describe_table", """
SELECT * FROM (VALUES ('timestamp', 'timestamp_ntz'), ('date', 'date'), ('hour', 'int'), ('month', 'int'), ('year', 'string'),
  ('temp_f', 'double'), ('precipitation_mm', 'double'), ('rain_mm', 'double'), ('cloudcover_pct', 'double'),
  ('windspeed_kmh', 'double'), ('wind_direction_deg', 'double')) AS t(col_name, data_type)""")
def q_describe_table(spark, sf):
    path = scratch_path(spark, "weather_described")
    sinks.write_parquet(weather.cleaned(fixtures.weather_raw(spark, sf)), path)
    table = f"{_database(spark)}.weather_described_{uuid.uuid4().hex[:8]}"
    return sinks.external_parquet_table(spark, table, jobs.WEATHER_TABLE_DDL, path).select("col_name", "data_type")


@register("safe_overwrite", sql("""
SELECT DISTINCT * FROM merged_left
WHERE date IS NOT NULL AND time_hours IS NOT NULL AND start_longitude IS NOT NULL AND start_latitude IS NOT NULL
  AND trip_duration IS NOT NULL AND distance IS NOT NULL AND is_taxi IS NOT NULL AND temp_f IS NOT NULL
  AND precipitation_mm IS NOT NULL AND rain_mm IS NOT NULL AND cloudcover_pct IS NOT NULL
  AND windspeed_kmh IS NOT NULL AND wind_direction_deg IS NOT NULL
  AND trip_duration > 0 AND distance >= 0 AND time_hours BETWEEN 0 AND 23
  AND start_latitude BETWEEN 40.0 AND 41.5 AND start_longitude BETWEEN -74.5 AND -73.0""", "merged_left"))
def q_safe_overwrite(spark, sf):
    path = scratch_path(spark, "merged_in_place")
    sinks.write_parquet(inputs.merged_left(spark, sf), path)
    # input path == output path: the cleaned frame reads the folder it replaces
    sinks.safe_overwrite(merge.clean_strict(spark.read.parquet(path)), path)
    return spark.read.parquet(path)


@register("versioned_overwrite", sql("""
SELECT DISTINCT * FROM merged_left
WHERE date IS NOT NULL AND time_hours IS NOT NULL AND start_longitude IS NOT NULL AND start_latitude IS NOT NULL
  AND trip_duration IS NOT NULL AND distance IS NOT NULL AND is_taxi IS NOT NULL AND temp_f IS NOT NULL
  AND precipitation_mm IS NOT NULL AND rain_mm IS NOT NULL AND cloudcover_pct IS NOT NULL
  AND windspeed_kmh IS NOT NULL AND wind_direction_deg IS NOT NULL
  AND trip_duration > 0 AND distance >= 0 AND time_hours BETWEEN 0 AND 23
  AND start_latitude BETWEEN 40.0 AND 41.5 AND start_longitude BETWEEN -74.5 AND -73.0""", "merged_left"))
def q_versioned_overwrite(spark, sf):
    """The strict clean as a new version of the dataset that it reads."""
    location = scratch_path(spark, "merged_versions")
    versions.publish(inputs.merged_left(spark, sf), location)
    versions.publish(merge.clean_strict(versions.read(spark, location)), location)
    return versions.read(spark, location)


@register("merge_stored", sql("SELECT * FROM merged_left", "merged_left"))
def q_merge_stored(spark, sf):
    """The left merge of tables stored in like buckets."""
    _database(spark)
    base, tag = scratch_path(spark, "buckets"), uuid.uuid4().hex[:8]
    tables = f"{DB}.trips_{tag}", f"{DB}.weather_{tag}"
    merge.store_for_merges(fixtures.trips(spark, sf), inputs.published_weather(spark, sf), base, *tables, buckets=8)
    return merge.merge_stored(spark, *tables)


# ------------------------------------------------------ end-to-end job chains
@register("pipeline_weather_merge", sql(f"""
SELECT round(temp_f / 5, 0) * 5 + 0.0 AS temp_bucket, is_taxi,
       {rs('avg(trip_duration)', 2)} AS avg_duration,
       {rs('avg(precipitation_mm)', 2)} AS avg_precip,
       {rs('avg(windspeed_kmh)', 2)} AS avg_wind,
       count(*) AS trip_count
FROM merged_left GROUP BY 1, 2""", "merged_left"))
def q_pipeline_weather_merge(spark, sf):
    """Files in, files out: weather CSV -> E1 -> E2 -> E3; trip tables ->
    E10 LEFT merge -> E15 CSV aggregates, read back."""
    base = scratch_path(spark, "e2e")
    sinks.write_csv(fixtures.weather_raw(spark, sf), f"{base}/weather_raw")
    jobs.weather_clean_job(spark, f"{base}/weather_raw", f"{base}/weather_cleaned")
    jobs.weather_enrich_job(spark, f"{base}/weather_cleaned", f"{base}/weather_enriched", DATA_YEAR)
    jobs.weather_publish_job(spark, f"{base}/weather_enriched", [f"{base}/weather_a", f"{base}/weather_b"])
    taxi, bike = inputs.taxi_and_bike(spark, sf)
    sinks.write_parquet(taxi, f"{base}/taxi")
    sinks.write_parquet(bike, f"{base}/bike")
    jobs.merge_left_job(spark, f"{base}/taxi", f"{base}/bike", f"{base}/weather_a", f"{base}/merged")
    out = jobs.analytics_job(spark, f"{base}/merged", f"{base}/analytics")
    return csv_src.scan_csv(spark, out["weather_duration"],
                            schema="temp_bucket double, is_taxi int, avg_duration double, avg_precip double, "
                                   "avg_wind double, trip_count bigint")


@register("pipeline_ingest", sql("""
SELECT start_longitude, start_latitude, time_hours, date, trip_duration, distance, is_taxi FROM taxi_trips
UNION ALL
SELECT start_longitude, start_latitude, time_hours, date, trip_duration, round(distance, 6), is_taxi FROM bike_trips
""", "taxi_trips", "bike_trips"))
def q_pipeline_ingest(spark, sf):
    """E4 (raw taxi Parquet files + zone CSV) and E7 (bike CSV files), read back."""
    base = scratch_path(spark, "ingest")
    sinks.write_parquet(fixtures.taxi_raw(spark, sf), f"{base}/taxi_raw", max_records_per_file=FILE_ROWS)
    write_zone_csv(spark, sf, f"{base}/zones.csv", short_every=10 ** 9,
                   header="LocationID,Borough,Zone,service_zone,longitude,latitude")
    jobs.taxi_ingest_job(spark, f"{base}/taxi_raw", f"{base}/zones.csv", f"{base}/taxi")
    sinks.write_csv(fixtures.bike_raw(spark, sf), f"{base}/bike_raw", max_records_per_file=FILE_ROWS)
    jobs.bike_ingest_job(spark, f"{base}/bike_raw/*.csv", f"{base}/bike", distance_unit="km")
    taxi = spark.read.parquet(f"{base}/taxi")
    bike = spark.read.parquet(f"{base}/bike").withColumn("distance", F.round("distance", 6))
    return taxi.unionByName(bike)
