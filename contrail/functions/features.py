"""Row-level feature expressions (inventory F1-F14).

Each function returns a ``Column`` built from built-in functions only, so
every feature stays inside whole-stage codegen.  Thresholds are arguments;
the defaults are the reference's values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's for equal results.
DELAY_THRESHOLD = 15.0          # minutes; "delayed" is strictly greater
WEEKEND_DAYS = (6, 7)           # Monday = 1 ... Sunday = 7
DISTANCE_BINS = ((0.0, 500.0, "short"), (500.0, 1000.0, "medium"),
                 (1000.0, 2000.0, "long"), (2000.0, 5000.0, "ultra"))
EXTREME_COLD_BELOW = -10.0      # TMIN
EXTREME_HOT_ABOVE = 95.0        # TMAX
HEAVY_RAIN_ABOVE = 50.0         # PRCP
HIGH_WIND_ABOVE = 15.0          # AWND


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hour_of_hhmm(hhmm) -> Column:
    """HHMM integer -> hour, floor division (not truncation)."""
    return F.floor(_c(hhmm) / 100).cast("int")


def is_weekend(day_of_week, days: Sequence[int] = WEEKEND_DAYS) -> Column:
    """membership as 0/1; null day -> 0 (pandas isin gives False)."""
    return F.when(_c(day_of_week).isin(*days), 1).otherwise(0)


def iso_day_of_week(date) -> Column:
    """Monday = 1 ... Sunday = 7 from a date (Spark's dayofweek has Sunday = 1)."""
    return (F.weekday(_c(date)) + 1).cast("int")


def quarter_of_month(month) -> Column:
    """(MONTH - 1) // 3 + 1."""
    return (F.floor((_c(month) - 1) / 3) + 1).cast("int")


def delay_flag(delay, threshold: float = DELAY_THRESHOLD) -> Column:
    """1 when strictly above the threshold; null and NaN -> 0."""
    c = _c(delay)
    return F.when(~F.isnan(c) & (c > threshold), 1).otherwise(0)


def duration_ratio(elapsed, scheduled) -> Column:
    """elapsed / scheduled when scheduled > 0, else 1.0.

    A null scheduled time falls to 1.0; a null elapsed time stays null."""
    s = _c(scheduled)
    return F.when(s > 0, _c(elapsed).cast("double") / s).otherwise(F.lit(1.0))


def distance_bin(distance, bins=DISTANCE_BINS) -> Column:
    """right-closed bins (lo, hi]; outside every bin -> null.

    Not ``Bucketizer``: that one is left-closed."""
    d = _c(distance)
    expr = None
    for lo, hi, label in bins:
        cond = (d > lo) & (d <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def route_key(origin, dest, sep: str = "_") -> Column:
    """F8: origin + sep + dest; a null side gives null (``concat``)."""
    return F.concat(_c(origin).cast("string"), F.lit(sep), _c(dest).cast("string"))


def temp_range(tmax, tmin) -> Column:
    """F9."""
    return _c(tmax) - _c(tmin)


def above(x, threshold: float) -> Column:
    """F10 helper: 1 when strictly above, null and NaN -> 0."""
    return F.when((_c(x) > threshold) & ~F.isnan(_c(x).cast("double")), 1).otherwise(0)


def below(x, threshold: float) -> Column:
    """F10 helper: 1 when strictly below, null and NaN -> 0 (NaN is the largest value)."""
    return F.when(_c(x) < threshold, 1).otherwise(0)


def date_from_parts(year, month, day, strict: bool = False) -> Column:
    """build a date.  ``strict`` raises on impossible dates (ANSI
    ``make_date``); the default returns null so those rows can be
    quarantined instead."""
    if strict:
        return F.make_date(_c(year), _c(month), _c(day))
    return F.to_date(F.try_make_timestamp(_c(year), _c(month), _c(day),
                                          F.lit(0), F.lit(0), F.lit(0)))


MAP_SS = T.MapType(T.StringType(), T.StringType())


def decode_json_map(text) -> Column:
    """F12 decode: JSON object text -> MAP<STRING,STRING>; bad or null -> {}."""
    parsed = F.from_json(_c(text), MAP_SS, {"mode": "PERMISSIVE"})
    return F.coalesce(parsed, F.create_map().cast(MAP_SS))


def encode_json_map(m) -> Column:
    """F12 encode."""
    return F.to_json(_c(m))


def round_display(x, digits: int = 1) -> Column:
    """F13 display rounding (half-up, like the template)."""
    return F.round(_c(x), digits)
