"""Street-level temperature sensors - clean, profile, enrich."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwx.functions import columns as C
from tripwx.operators import clean, profile, schema

# --- fixed values --------------------------------------------------------------
DROPPED = ["Sensor.ID", "Install.Type"]
RENAMES = {"AirTemp": "airtemp", "Day": "day", "Hour": "hour", "Latitude": "latitude",
           "Longitude": "longitude", "Year": "year", "Borough": "borough"}
DAY_FORMAT = "MM/dd/yyyy"
REQUIRED = ["airtemp", "day", "hour", "latitude", "longitude", "year", "borough", "ntacode"]
AIRTEMP_RANGE = (-20.0, 130.0)
# -------------------------------------------------------------------------------


def cleaned(raw: DataFrame) -> DataFrame:
    df = schema.rename(schema.drop_columns(raw, DROPPED), RENAMES)
    df = df.withColumns({
        "airtemp": F.round(F.col("airtemp").try_cast("double"), 2),
        "day": F.try_to_date(F.col("day").cast("string"), DAY_FORMAT),
        "hour": F.col("hour").try_cast("int"),
        "latitude": F.col("latitude").try_cast("double"),
        "longitude": F.col("longitude").try_cast("double"),
        "year": F.col("year").cast("string"),
    })
    df = clean.drop_nulls(df, REQUIRED)
    return clean.apply_rules(df, [
        clean.Rule("airtemp_range", F.col("airtemp").between(*AIRTEMP_RANGE)),
        clean.Rule("hour_range", F.col("hour").between(0, 23)),
    ])


def enriched(cleaned_df: DataFrame, year: int) -> DataFrame:
    df = cleaned_df.filter(F.col("year") == str(year))
    return df.withColumns({
        "day_iso": C.iso_date("day"),
        "borough": C.normalize_upper("borough"),
        "isHot": C.is_hot("airtemp"),
    })


def profile_counts(cleaned_df: DataFrame) -> DataFrame:
    """Distinct counts of every analysed column, one pass."""
    return profile.distinct_counts(cleaned_df, ["airtemp", "day", "hour", "latitude", "longitude",
                                                "year", "borough", "ntacode"])


def summary_means(enriched_df: DataFrame) -> DataFrame:
    return profile.global_means(enriched_df, ["airtemp", "hour", "latitude", "longitude"],
                                {"airtemp": 4, "hour": 4, "latitude": 6, "longitude": 6},
                                stddev_of=["airtemp"])
