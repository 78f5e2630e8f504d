"""The two published analytics over the merged trips.

Both are one hash aggregate on (temp_bucket, is_taxi): partial aggregation
runs map-side, so the shuffle carries at most (#buckets x 2) rows per map
task however skewed the temperatures are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwx.functions import columns as C


def temp_bucket_counts(merged: DataFrame) -> DataFrame:
    return (merged.withColumn("temp_bucket", C.temp_bucket("temp_f"))
            .groupBy("temp_bucket", "is_taxi")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy("temp_bucket", "is_taxi"))


def weather_duration(merged: DataFrame) -> DataFrame:
    return (merged.withColumn("temp_bucket", C.temp_bucket("temp_f"))
            .groupBy("temp_bucket", "is_taxi")
            .agg(C.round_stable(F.avg("trip_duration"), 2).alias("avg_duration"),
                 C.round_stable(F.avg("precipitation_mm"), 2).alias("avg_precip"),
                 C.round_stable(F.avg("windspeed_kmh"), 2).alias("avg_wind"),
                 F.count(F.lit(1)).alias("trip_count"))
            .orderBy("temp_bucket", "is_taxi"))
