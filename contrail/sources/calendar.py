"""Holiday calendar generation (inventory A10).

A date spine (``sequence`` + ``explode``) over whole years is labelled by
rule expressions: fixed dates, n-th weekday of a month, last weekday of a
month, and the observed shift of fixed holidays (Saturday -> Friday before,
Sunday -> Monday after).  Output: (date, holiday_name, is_holiday = 1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# United States federal holidays (name, month, day, first year).
FIXED_HOLIDAYS = (
    ("New Year's Day", 1, 1, None),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, None),
    ("Veterans Day", 11, 11, None),
    ("Christmas Day", 12, 25, None),
)
# Fixed values: (name, month, ISO weekday 1=Mon, n-th occurrence or -1 = last, first year).
FLOATING_HOLIDAYS = (
    ("Martin Luther King Jr. Day", 1, 1, 3, 1986),
    ("Washington's Birthday", 2, 1, 3, None),
    ("Memorial Day", 5, 1, -1, None),
    ("Labor Day", 9, 1, 1, None),
    ("Columbus Day", 10, 1, 2, None),
    ("Thanksgiving Day", 11, 4, 4, None),
)
OBSERVED_SUFFIX = " (observed)"


def _fixed_name(d: Column) -> Column:
    expr = None
    for name, m, dd, since in FIXED_HOLIDAYS:
        cond = (F.month(d) == m) & (F.dayofmonth(d) == dd)
        if since:
            cond = cond & (F.year(d) >= since)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def _floating_name(d: Column) -> Column:
    iso_dow = F.weekday(d) + 1
    nth = F.floor((F.dayofmonth(d) - 1) / 7) + 1
    is_last = F.dayofmonth(d) + 7 > F.dayofmonth(F.last_day(d))
    expr = None
    for name, m, dow, n, since in FLOATING_HOLIDAYS:
        cond = (F.month(d) == m) & (iso_dow == dow) & (is_last if n == -1 else nth == n)
        if since:
            cond = cond & (F.year(d) >= since)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def holiday_name(d: Column) -> Column:
    """Holiday name of date ``d`` or null."""
    iso_dow = F.weekday(d) + 1
    observed = (F.when(iso_dow == 5, F.concat(_fixed_name(F.date_add(d, 1)), F.lit(OBSERVED_SUFFIX)))
                .when(iso_dow == 1, F.concat(_fixed_name(F.date_sub(d, 1)), F.lit(OBSERVED_SUFFIX))))
    return F.coalesce(_fixed_name(d), _floating_name(d), observed)


def holiday_calendar(years: DataFrame, year_col: str = "year") -> DataFrame:
    """Holidays of every distinct year in ``years[year_col]``.

    The spine is one row per day of those years (365 x years), built from
    the distinct years, so its size is bounded by the calendar span.
    """
    spine = (years.select(F.col(year_col).cast("int").alias("_y")).where(F.col("_y").isNotNull()).distinct()
             .select(F.explode(F.sequence(F.make_date("_y", F.lit(1), F.lit(1)),
                                          F.make_date("_y", F.lit(12), F.lit(31)))).alias("date")))
    return (spine.select("date", holiday_name(F.col("date")).alias("holiday_name"))
            .where(F.col("holiday_name").isNotNull())
            .withColumn("is_holiday", F.lit(1)))


def holiday_calendar_range(spark, first_year: int, last_year: int) -> DataFrame:
    """Holidays for an explicit year range (the reference's ``years`` list)."""
    years = spark.range(first_year, last_year + 1).withColumnRenamed("id", "year")
    return holiday_calendar(years)
