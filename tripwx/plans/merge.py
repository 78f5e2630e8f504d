"""Trip x weather merges and the cleaning passes that follow them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwx.functions import columns as C
from tripwx.operators import clean, joins
from tripwx.sources import sinks

# --- fixed values ------------------------------------------------------------
JOIN_KEYS = ["date", "time_hours"]
TRIP_COLUMNS = ["start_longitude", "start_latitude", "time_hours", "date", "trip_duration",
                "distance", "is_taxi"]
WEATHER_MEASURES = ["temp_f", "precipitation_mm", "rain_mm", "cloudcover_pct", "windspeed_kmh",
                    "wind_direction_deg"]
TRIP_REQUIRED = ["date", "time_hours", "start_longitude", "start_latitude", "trip_duration",
                 "distance", "is_taxi"]
STRICT_REQUIRED = TRIP_REQUIRED + WEATHER_MEASURES
LAT_RANGE = (40.0, 41.5)
LON_RANGE = (-74.5, -73.0)
MAX_DURATION_S = 86400
MAX_DISTANCE = 200
HOURS = (0, 23)
# -----------------------------------------------------------------------------


def merge_left(taxi: DataFrame, bike: DataFrame, weather: DataFrame,
               max_broadcast_bytes: int = joins.DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Positional union of the trip sources, LEFT join to hourly
    weather on (date, time_hours); trips without weather keep NULLs."""
    trips = joins.union_positional(taxi, bike)
    return joins.join_small(trips, weather, JOIN_KEYS, "left", max_broadcast_bytes)


def merge_inner(bike: DataFrame, taxi: DataFrame, weather: DataFrame,
                max_broadcast_bytes: int = joins.DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """By-name union, INNER join, drop any-NULL rows, deduplicate."""
    trips = joins.union_by_name(bike, taxi)
    merged = joins.join_small(trips, weather, JOIN_KEYS, "inner", max_broadcast_bytes)
    return clean.dedup(clean.drop_nulls(merged))


def store_for_merges(trips: DataFrame, weather: DataFrame, path: str, trips_table: str, weather_table: str,
                     buckets: int) -> None:
    """Trips and weather dealt alike by (date, time_hours), for
    ``merge_stored``: one shuffle each, here, instead of one per merge."""
    sinks.bucketed_table(trips, trips_table, JOIN_KEYS, buckets, f"{path}/trips")
    sinks.bucketed_table(weather, weather_table, JOIN_KEYS, buckets, f"{path}/weather")


def merge_stored(spark: SparkSession, trips_table: str, weather_table: str, how: str = "left") -> DataFrame:
    """E10/E11's join of stored tables: a merge join bucket by bucket.  No
    side is broadcast, whatever its size, and no row of either is shuffled."""
    return spark.table(trips_table).join(spark.table(weather_table).hint("merge"), JOIN_KEYS, how)


def bbox_rules() -> list[clean.Rule]:
    return [
        clean.Rule("latitude_box", F.col("start_latitude").between(*LAT_RANGE)),
        clean.Rule("longitude_box", F.col("start_longitude").between(*LON_RANGE)),
    ]


def strict_rules(df: DataFrame) -> list[clean.Rule]:
    return [
        clean.null_rule(df, STRICT_REQUIRED, "required_not_null"),
        clean.Rule("duration_positive", F.col("trip_duration") > 0),
        clean.Rule("distance_non_negative", F.col("distance") >= 0),
        clean.Rule("hour_range", F.col("time_hours").between(*HOURS)),
    ] + bbox_rules()


#: Decimals kept by the exact sums behind the imputed means: more than a
#: measurement's double holds.
MEAN_SCALE = 15


def clean_strict(merged: DataFrame) -> DataFrame:
    """Required columns (those present) non-NULL, trip sanity, NYC box,
    whole-row dedup."""
    return clean.dedup(clean.apply_rules(merged, strict_rules(merged)))


def outlier_rules(df: DataFrame) -> list[clean.Rule]:
    return [
        clean.null_rule(df, TRIP_REQUIRED, "trip_not_null"),
        clean.Rule("duration_positive", F.col("trip_duration") > 0),
        clean.Rule("duration_below_day", F.col("trip_duration") < MAX_DURATION_S),
        clean.Rule("distance_non_negative", F.col("distance") >= 0),
        clean.Rule("distance_below_max", F.col("distance") < MAX_DISTANCE),
        clean.Rule("hour_range", F.col("time_hours").between(*HOURS)),
    ] + bbox_rules()


def year_rule(year: int) -> clean.Rule:
    return clean.Rule("year", C.year_range("date", year))


def clean_impute(merged: DataFrame, year: int) -> DataFrame:
    """Year filter, trip NULL drop, outlier filter, mean imputation of
    the weather measures, day/month/segment columns."""
    rules = [year_rule(year)] + outlier_rules(merged)
    valid = clean.apply_rules(merged, rules)
    return _segmented(clean.impute_mean(valid, WEATHER_MEASURES, exact_scale=MEAN_SCALE))


def _segmented(filled: DataFrame) -> DataFrame:
    return filled.withColumns({
        "day_of_month": F.dayofmonth("date"),
        "month": F.month("date"),
    }).withColumn("month_segment", C.month_segment("day_of_month"))


def clean_impute_counted(merged: DataFrame, year: int) -> tuple[DataFrame, DataFrame]:
    """E13 and its stage funnel: one scan gives the means and the counts."""
    filled, funnel = clean.impute_with_funnel(merged, [year_rule(year)] + outlier_rules(merged), WEATHER_MEASURES, MEAN_SCALE)
    return _segmented(filled), funnel


def clean_impute_funnel(merged: DataFrame, year: int) -> DataFrame:
    return clean.funnel(merged, [year_rule(year)] + outlier_rules(merged))
