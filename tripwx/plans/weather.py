"""Weather pipelines: raw hourly CSV-shaped rows -> cleaned -> enriched ->
join-ready hourly table.  Every step is a projection or filter, so the
whole chain is one narrow stage that Catalyst fuses with the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwx.functions import columns as C
from tripwx.operators import clean, schema

# --- fixed values: raw column names and their cleaned names -----------------
RAW_DROPPED = ["cloudcover_low (%)", "cloudcover_mid (%)", "cloudcover_high (%)"]
RAW_RENAMES = {
    "time": "timestamp",
    "temperature_2m (°C)": "temp_c",
    "precipitation (mm)": "precipitation_mm",
    "rain (mm)": "rain_mm",
    "cloudcover (%)": "cloudcover_pct",
    "windspeed_10m (km/h)": "windspeed_kmh",
    "winddirection_10m (°)": "wind_direction_deg",
}
RAW_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
MEASURES = ["precipitation_mm", "rain_mm", "cloudcover_pct", "windspeed_kmh", "wind_direction_deg"]
CLEANED_COLUMNS = ["timestamp", "date", "hour", "month", "year", "temp_f"] + MEASURES
JOIN_READY_COLUMNS = ["date", "time_hours", "temp_f"] + MEASURES + ["season", "beaufort_scale", "isHot", "isWindy"]
TEMP_F_RANGE = (-20.0, 115.0)
CLOUD_RANGE = (0.0, 100.0)
DIRECTION_RANGE = (0.0, 360.0)
HOUR_RANGE = (0, 23)
# -----------------------------------------------------------------------------


def validation_rules() -> list[clean.Rule]:
    col = F.col
    return [
        clean.Rule("temp_f_range", col("temp_f").between(*TEMP_F_RANGE)),
        clean.Rule("precipitation_non_negative", col("precipitation_mm") >= 0.0),
        clean.Rule("rain_non_negative", col("rain_mm") >= 0.0),
        clean.Rule("cloudcover_range", col("cloudcover_pct").between(*CLOUD_RANGE)),
        clean.Rule("windspeed_non_negative", col("windspeed_kmh") >= 0.0),
        clean.Rule("direction_range", col("wind_direction_deg").between(*DIRECTION_RANGE)),
        clean.Rule("hour_range", col("hour").between(*HOUR_RANGE)),
    ]


def typed(raw: DataFrame) -> DataFrame:
    """drop -> rename -> parse/cast -> calendar -> convert and round, as one
    projection."""
    df = schema.rename(schema.drop_columns(raw, RAW_DROPPED), RAW_RENAMES)
    if dict(df.dtypes).get("timestamp", "").startswith("timestamp"):
        # a CSV reader with inferSchema already parsed it; the pattern would not apply
        ts = F.col("timestamp").cast("timestamp_ntz")
    else:
        ts = F.try_to_timestamp(F.col("timestamp").cast("string"), F.lit(RAW_TIME_FORMAT)).cast("timestamp_ntz")
    temp_c = F.col("temp_c").try_cast("double")
    out = {"timestamp": ts}
    out.update({k: v for k, v in C.calendar_columns(ts).items()})
    out["temp_f"] = C.c_to_f(temp_c)
    out.update({c: F.round(F.col(c).try_cast("double"), 2) for c in MEASURES})
    return df.withColumns(out)


def cleaned(raw: DataFrame) -> DataFrame:
    """Hourly weather, NULL-free and within physical ranges."""
    df = typed(raw)
    df = clean.drop_nulls(df, ["timestamp", "temp_f"] + MEASURES + ["date", "hour", "month", "year"])
    df = clean.apply_rules(df, validation_rules())
    return df.select(*CLEANED_COLUMNS)


def funnel(raw: DataFrame) -> DataFrame:
    """Row counts after each cleaning stage, one pass."""
    df = typed(raw)
    rules = [clean.null_rule(df, ["timestamp", "temp_f"] + MEASURES + ["date", "hour", "month", "year"],
                             "not_null")] + validation_rules()
    return clean.funnel(df, rules)


def enriched(cleaned_df: DataFrame, year: int | None = None) -> DataFrame:
    """Optional year filter, ISO text, season, Beaufort, hot/windy flags."""
    df = cleaned_df
    if year is not None:
        df = df.filter(F.col("year") == str(year))
    return df.withColumns({
        "date_iso": C.iso_minute("timestamp"),
        "season": C.season("month"),
        "beaufort_scale": C.beaufort("windspeed_kmh"),
        "isHot": C.is_hot("temp_f"),
        "isWindy": C.is_windy("windspeed_kmh"),
    })


def join_ready(enriched_df: DataFrame) -> DataFrame:
    """Hour -> time_hours, keep the join-ready columns."""
    return enriched_df.withColumn("time_hours", F.col("hour")).select(*JOIN_READY_COLUMNS)


def published(raw: DataFrame, year: int | None = None) -> DataFrame:
    """Raw rows all the way to the join-ready table."""
    return join_ready(enriched(cleaned(raw), year))
