"""Pure ``Column -> Column`` builders (no DataFrame, no action).

Everything here compiles to built-in Catalyst expressions, so it stays
inside whole-stage codegen and can be pushed into scans where Spark
allows it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's for the same results) --------
# Seasons by month number; every other month, and NULL, is FALL.
SEASON_MONTHS = [
    ("WINTER", (12, 1, 2)),
    ("SPRING", (3, 4, 5)),
    ("SUMMER", (6, 7, 8)),
]
SEASON_OTHERWISE = "FALL"

# Beaufort bands on wind speed in km/h, closed integer ranges as published;
# below 1 is calm, 118 and above is hurricane, anything else is "Unknown".
BEAUFORT_CALM = "0 - Calm"
BEAUFORT_BANDS = [
    ("1 - Light Air", 1, 5),
    ("2 - Light Breeze", 6, 11),
    ("3 - Gentle Breeze", 12, 19),
    ("4 - Moderate Breeze", 20, 28),
    ("5 - Fresh Breeze", 29, 38),
    ("6 - Strong Breeze", 39, 49),
    ("7 - Near Gale", 50, 61),
    ("8 - Gale", 62, 74),
    ("9 - Strong Gale", 75, 88),
    ("10 - Storm", 89, 102),
    ("11 - Violent Storm", 103, 117),
]
BEAUFORT_HURRICANE = ("12 - Hurricane", 118)
BEAUFORT_UNKNOWN = "Unknown"

HOT_F = 80.0
WINDY_KMH = 29
EARTH_RADIUS_KM = 6371.0
EARTH_RADIUS_MI = 3958.8
EARLY_MONTH_LAST_DAY = 15
# -----------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_stable(c: Column | str, scale: int) -> Column:
    """HALF_UP rounding that ignores last-ulp noise.

    A distributed ``avg`` sums in partition order, so the same mean can
    differ by one ulp between runs; a value sitting on a rounding boundary
    would then flip.  A sign-aware 1e-9 nudge makes the rounded result
    independent of summation order (and of the engine).
    """
    c = _c(c)
    return F.round(c + F.signum(c) * F.lit(1e-9), scale)


def season(month: Column | str) -> Column:
    month = _c(month)
    expr = None
    for label, months in SEASON_MONTHS:
        cond = month.isin(*months)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(SEASON_OTHERWISE)


def beaufort(wind_kmh: Column | str, contiguous: bool = False) -> Column:
    """Beaufort label.

    ``contiguous=False`` keeps the published closed integer bands, so a
    speed such as 5.5 falls between bands and is "Unknown".  With
    ``contiguous=True`` each band extends up to the next band's start.
    """
    w = _c(wind_kmh)
    expr = F.when(w < 1, BEAUFORT_CALM)
    for i, (label, lo, hi) in enumerate(BEAUFORT_BANDS):
        if contiguous:
            nxt = BEAUFORT_BANDS[i + 1][1] if i + 1 < len(BEAUFORT_BANDS) else BEAUFORT_HURRICANE[1]
            cond = (w >= lo) & (w < nxt)
        else:
            cond = w.between(lo, hi)
        expr = expr.when(cond, label)
    label, lo = BEAUFORT_HURRICANE
    return expr.when(w >= lo, label).otherwise(BEAUFORT_UNKNOWN)


def flag(cond: Column) -> Column:
    """Condition -> 1/0 with NULL -> 0."""
    return F.when(cond, 1).otherwise(0)


def is_hot(temp_f: Column | str, threshold: float = HOT_F) -> Column:
    return flag(_c(temp_f) >= threshold)


def is_windy(wind_kmh: Column | str, threshold: float = WINDY_KMH) -> Column:
    return flag(_c(wind_kmh) >= threshold)


def month_segment(day_of_month: Column | str, last_early_day: int = EARLY_MONTH_LAST_DAY) -> Column:
    return F.when(_c(day_of_month) <= last_early_day, "early").otherwise("late")


def temp_bucket(temp_f: Column | str, width: float = 5.0) -> Column:
    """Nearest multiple of ``width``, halves away from zero."""
    return F.round(_c(temp_f) / width, 0) * width


def c_to_f(temp_c: Column | str, scale: int = 2) -> Column:
    return F.round(_c(temp_c) * 9.0 / 5.0 + 32.0, scale)


def haversine(lat1, lon1, lat2, lon2, unit: str = "km") -> Column:
    """Great-circle distance; ``a`` is clamped to [0, 1] so antipodal
    points and rounding noise cannot yield NaN."""
    radius = {"km": EARTH_RADIUS_KM, "mi": EARTH_RADIUS_MI}[unit]
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.sin(dlat / 2) ** 2 + F.cos(p1) * F.cos(p2) * F.sin(dlon / 2) ** 2
    a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    return F.lit(radius) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole epoch seconds of a TIMESTAMP or TIMESTAMP_NTZ value
    (an NTZ value is read in the session time zone)."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def duration_seconds(start: Column | str, end: Column | str) -> Column:
    return epoch_seconds(end) - epoch_seconds(start)


def duration_unit(seconds: Column | str, unit: str = "s") -> Column:
    return {"s": _c(seconds).cast("double"), "min": _c(seconds) / 60.0}[unit]


def iso_minute(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm")


def iso_date(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd")


def iso_second(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def normalize_lower(c: Column | str) -> Column:
    return F.lower(F.trim(_c(c)))


def normalize_upper(c: Column | str) -> Column:
    return F.upper(F.trim(_c(c)))


def calendar_columns(ts: Column | str) -> dict[str, Column]:
    """date, hour, month (int) and year (string) of a timestamp."""
    ts = _c(ts)
    return {
        "date": F.to_date(ts),
        "hour": F.hour(ts).cast("int"),
        "month": F.month(ts).cast("int"),
        "year": F.year(ts).cast("string"),
    }


def year_range(date_col: Column | str, year: int) -> Column:
    """``year(date) == year`` written as a range so it reaches the scan."""
    d = _c(date_col)
    return (d >= F.lit(f"{year}-01-01").cast("date")) & (d < F.lit(f"{year + 1}-01-01").cast("date"))
