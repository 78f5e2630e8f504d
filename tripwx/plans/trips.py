"""Trip ingest pipelines: raw taxi / bike rows -> canonical trip schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwx.functions import columns as C
from tripwx.operators import clean, joins, schema
from tripwx.operators.schema import ColumnSpec

# --- fixed values: declared schemas ------------------------------------------
TAXI_SOURCE = [
    ColumnSpec("tpep_pickup_datetime", "timestamp"),
    ColumnSpec("tpep_dropoff_datetime", "timestamp"),
    ColumnSpec("trip_distance", "double"),
    ColumnSpec("PULocationID", "bigint"),
]
TAXI_KEPT = TAXI_SOURCE + [ColumnSpec("DOLocationID", "bigint")]
TAXI_SUMMARY = [
    ColumnSpec("tpep_pickup_datetime", "timestamp"),
    ColumnSpec("tpep_dropoff_datetime", "timestamp"),
    ColumnSpec("fare_amount", "double"),
    ColumnSpec("tip_amount", "double"),
    ColumnSpec("total_amount", "double"),
    ColumnSpec("passenger_count", "double"),
    ColumnSpec("trip_distance", "double"),
]
TAXI_NUMERIC = ["fare_amount", "tip_amount", "total_amount", "passenger_count", "trip_distance"]
TRIP = [
    ColumnSpec("start_longitude", "double"),
    ColumnSpec("start_latitude", "double"),
    ColumnSpec("time_hours", "int"),
    ColumnSpec("date", "date"),
    ColumnSpec("trip_duration", "double"),
    ColumnSpec("distance", "double"),
    ColumnSpec("is_taxi", "int"),
]
BIKE_RENAMES = {"start station longitude": "start_longitude", "start station latitude": "start_latitude"}
BIKE_STATION_COLUMNS = ["start station name", "end station name"]
BIKE_COORDS = ["start station latitude", "start station longitude",
               "end station latitude", "end station longitude"]
BIKE_NEW_DROPPED = ["start_lat", "start_lng", "end_lat", "end_lng"]
BIKE_NEW_REQUIRED = ["ride_id", "start_station_name", "end_station_name"]
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
# -----------------------------------------------------------------------------


def zone_lookup(raw_zones: DataFrame) -> DataFrame:
    """(PULocationID, lookup_longitude, lookup_latitude) from a string zone
    table whose headers may be LocationID/locationID, longitude/x, latitude/y."""
    return raw_zones.select(
        schema.first_present(raw_zones, "LocationID", "locationID").try_cast("bigint").alias("PULocationID"),
        schema.first_present(raw_zones, "longitude", "x").try_cast("double").alias("lookup_longitude"),
        schema.first_present(raw_zones, "latitude", "y").try_cast("double").alias("lookup_latitude"),
    )


def taxi_trips(raw_taxi: DataFrame, raw_zones: DataFrame,
               max_broadcast_bytes: int = joins.DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Align the raw columns, LEFT join the zone centroids (zones
    without coordinates and unknown ids keep NULLs), derive trip columns."""
    src = schema.align(raw_taxi, TAXI_SOURCE)
    joined = joins.join_small(src, zone_lookup(raw_zones), ["PULocationID"], "left", max_broadcast_bytes)
    pickup = F.col("tpep_pickup_datetime")
    derived = joined.select(
        F.col("lookup_longitude").alias("start_longitude"),
        F.col("lookup_latitude").alias("start_latitude"),
        F.hour(pickup).alias("time_hours"),
        F.to_date(pickup).alias("date"),
        C.duration_seconds(pickup, "tpep_dropoff_datetime").alias("trip_duration"),
        F.col("trip_distance").alias("distance"),
        F.lit(1).alias("is_taxi"),
    )
    return schema.align(derived, TRIP)


def bike_time(name: str):
    """A trip time: a timestamp, or text in the default or the second
    format; text that is neither is NULL, never an error."""
    return F.coalesce(F.col(name).try_cast("timestamp"),
                      F.try_to_timestamp(F.col(name).cast("string"), F.lit(SECOND_FORMAT)))


def bike_trips(raw_bike: DataFrame, dropna_scope: str = "all", distance_unit: str = "km",
               duration_unit: str = "s") -> DataFrame:
    """Drop incomplete rows (all raw columns by default, as published,
    or only the used ones), rename, derive, haversine distance."""
    used = ["tripduration", "starttime"] + BIKE_COORDS
    df = clean.drop_nulls(raw_bike, None if dropna_scope == "all" else used)
    df = schema.rename(df, BIKE_RENAMES)
    start = bike_time("starttime")
    df = df.select(
        F.col("start_longitude"), F.col("start_latitude"),
        F.hour(start).alias("time_hours"),
        F.to_date(start).alias("date"),
        C.duration_unit(F.col("tripduration").try_cast("double"), duration_unit).alias("trip_duration"),
        C.haversine("start_latitude", "start_longitude", "end station latitude",
                    "end station longitude", distance_unit).alias("distance"),
        F.lit(0).alias("is_taxi"),
    )
    return clean.drop_nulls(schema.align(df, TRIP))


def bike_profiled(raw_bike: DataFrame) -> DataFrame:
    """E8 cleaning half: normalised station names, parsed times, subscriber flag."""
    df = raw_bike.withColumns({n: C.normalize_lower(F.col(schema.quote(n))) for n in BIKE_STATION_COLUMNS})
    df = df.withColumns({t: bike_time(t) for t in ["starttime", "stoptime"]})
    return df.withColumn("is_subscriber", C.flag(F.col("usertype") == "Subscriber"))


def bike_new_format(raw_new: DataFrame, data_year: int = 2024) -> DataFrame:
    """Drop coordinates, require id and station names, tag the data year."""
    df = schema.drop_columns(raw_new, BIKE_NEW_DROPPED)
    df = clean.drop_nulls(df, BIKE_NEW_REQUIRED)
    return df.withColumn("data_year", F.lit(data_year))


def taxi_kept(raw_taxi: DataFrame) -> DataFrame:
    """E5 projection: the five kept columns, cast or NULL."""
    return schema.align(raw_taxi, TAXI_KEPT)


def taxi_with_lengths(raw_taxi: DataFrame) -> DataFrame:
    """E6 output: NULL pickup/dropoff dropped, trip_time_length in seconds,
    times rendered as 'yyyy-MM-dd HH:mm:ss' text."""
    df = clean.drop_nulls(schema.align(raw_taxi, TAXI_SUMMARY),
                          ["tpep_pickup_datetime", "tpep_dropoff_datetime"])
    df = df.withColumn("trip_time_length",
                       C.duration_seconds("tpep_pickup_datetime", "tpep_dropoff_datetime"))
    return df.withColumns({c: C.iso_second(c) for c in ["tpep_pickup_datetime", "tpep_dropoff_datetime"]})
