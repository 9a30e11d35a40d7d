"""Queries: row-level features (F1-F15) and the validation status."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail.functions import features as fx
from contrail.operators import contracts, explore, joins, quality
from contrail.operators.feature_set import Roles, Thresholds, engineer
from contrail.plans.catalog import query
from contrail.plans.profile import (CRITICAL, DAILY_WIDE_SQL, HOLIDAYS_SQL, PRESENCE_SQL, RANGE_BOUNDS,
                                    TABLE_CONTRACTS, _FK_SQL, daily_feed_stored, shipments_weather)
from contrail.plans.shipments import SHIPMENTS_SQL, calendar_years, shipments, shipments_materialized, with_ctes
from contrail.session import stored
from contrail.sources.calendar import holiday_calendar

# Cuts and thresholds rescaled to the driver's measures (price, not miles /
# degrees); the reference's values are the defaults of ``Thresholds``.
SHIP_THRESHOLDS = Thresholds(
    delay=15.0,
    distance_bins=((0.0, 10000.0, "short"), (10000.0, 20000.0, "medium"),
                   (20000.0, 40000.0, "long"), (40000.0, 100000.0, "ultra")),
    cold_below=100000.0, hot_above=300000.0, rain_above=250000.0, wind_above=200000.0)
SHIP_ROLES = Roles(day_of_week="day_of_week", month="month", is_holiday="is_holiday", delay="delay",
                   elapsed="elapsed_time", scheduled="sched_time", distance="distance",
                   origin="origin", dest="dest", tmax="p_1_urgent", tmin="p_5_low",
                   prcp="p_3_medium", wind="p_2_high")
FEATURE_OUT = ["order_key", "line_number", "IS_WEEKEND", "QUARTER", "IS_HOLIDAY", "DELAYED",
               "DURATION_RATIO", "DISTANCE_BIN", "ROUTE", "TEMP_RANGE", "EXTREME_COLD",
               "EXTREME_HOT", "HEAVY_RAIN", "HIGH_WIND"]


def _bins_sql(d):
    parts = " ".join(f"WHEN {d} > {lo} AND {d} <= {hi} THEN '{lab}'" for lo, hi, lab in SHIP_THRESHOLDS.distance_bins)
    return f"CASE {parts} END"


ENGINEERED_SQL = with_ctes(f"""
SELECT s.order_key, s.line_number,
       CASE WHEN s.day_of_week IN (6, 7) THEN 1 ELSE 0 END AS IS_WEEKEND,
       CAST(floor((s.month - 1) / 3) + 1 AS INT) AS QUARTER,
       CAST(COALESCE(h.is_holiday, 0) AS INT) AS IS_HOLIDAY,
       CASE WHEN s.delay > 15 THEN 1 ELSE 0 END AS DELAYED,
       ROUND(CASE WHEN s.sched_time > 0 THEN s.elapsed_time / s.sched_time ELSE 1.0 END, 6) AS DURATION_RATIO,
       {_bins_sql('s.distance')} AS DISTANCE_BIN,
       CAST(s.origin AS VARCHAR) || '_' || CAST(s.dest AS VARCHAR) AS ROUTE,
       ROUND(w.p_1_urgent - w.p_5_low, 6) AS TEMP_RANGE,
       CASE WHEN w.p_5_low < 100000.0 THEN 1 ELSE 0 END AS EXTREME_COLD,
       CASE WHEN w.p_1_urgent > 300000.0 THEN 1 ELSE 0 END AS EXTREME_HOT,
       CASE WHEN w.p_3_medium > 250000.0 THEN 1 ELSE 0 END AS HEAVY_RAIN,
       CASE WHEN w.p_2_high > 200000.0 THEN 1 ELSE 0 END AS HIGH_WIND
FROM shipments s
LEFT JOIN ({HOLIDAYS_SQL}) h ON s.ship_date = h.date
LEFT JOIN daily w ON s.ship_date = w.date""", shipments=SHIPMENTS_SQL, daily=DAILY_WIDE_SQL)


@query("engineered_features", ENGINEERED_SQL)
def engineered_features(t):
    """Every feature whose inputs exist, on the fact joined
    to the holiday calendar and the daily feed (weather role)."""
    s = shipments(t)
    s = joins.join_holidays(s, stored(holiday_calendar(calendar_years(t))), date_col="ship_date")
    w = daily_feed_stored(t).withColumnRenamed("date", "_d")
    s = s.join(w, s.ship_date == w._d, "left")
    return engineer(s, SHIP_ROLES, SHIP_THRESHOLDS).select(*FEATURE_OUT)


@query("extreme_weather_shares", f"""
SELECT count(DISTINCT ROUTE) AS unique_routes, ROUND(avg(EXTREME_COLD) * 100.0, 4) AS extreme_cold_pct, ROUND(avg(EXTREME_HOT) * 100.0, 4) AS extreme_hot_pct,
  ROUND(avg(HEAVY_RAIN) * 100.0, 4) AS heavy_rain_pct, ROUND(avg(HIGH_WIND) * 100.0, 4) AS high_wind_pct,
  ROUND(avg(CASE WHEN EXTREME_COLD + EXTREME_HOT + HEAVY_RAIN + HIGH_WIND > 0 THEN 1 ELSE 0 END) * 100.0, 4) AS any_extreme_pct
FROM ({ENGINEERED_SQL})""")
def extreme_weather_shares(t):
    """Shares of the extreme-weather flags, of rows with any of them, and the number of routes."""
    flags = {"extreme_cold_pct": "EXTREME_COLD", "extreme_hot_pct": "EXTREME_HOT", "heavy_rain_pct": "HEAVY_RAIN", "high_wind_pct": "HIGH_WIND"}
    any_of = F.when(sum((F.col(c) for c in flags.values()), F.lit(0)) > 0, 1).otherwise(0)
    return explore.flag_shares(engineered_features(t), flags | {"any_extreme_pct": any_of}, {"unique_routes": "ROUTE"})


@query("event_time_features", """
SELECT event_id,
       CAST(hour(ts) * 100 + minute(ts) AS INT) AS hhmm,
       CAST(floor((hour(ts) * 100 + minute(ts)) / 100) AS INT) AS HOUR,
       CASE WHEN isodow(ts) IN (6, 7) THEN 1 ELSE 0 END AS IS_WEEKEND,
       CAST(floor((month(ts) - 1) / 3) + 1 AS INT) AS QUARTER,
       CASE WHEN value > 15 THEN 1 ELSE 0 END AS DELAYED,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS props_k
FROM events""")
def event_time_features(t):
    """F1 (HHMM -> hour, floor division), F2, F3, F5, F12 on the events."""
    e = t["events"].withColumn("hhmm", (F.hour("ts") * 100 + F.minute("ts")).cast("int")) \
                   .withColumn("dow", fx.iso_day_of_week(F.col("ts")))
    e = engineer(e, Roles(hhmm="hhmm", day_of_week="dow", delay="value"))
    return e.select("event_id", "hhmm", "HOUR", "IS_WEEKEND",
                    fx.quarter_of_month(F.month("ts")).alias("QUARTER"), "DELAYED",
                    fx.decode_json_map("props")["k"].try_cast("double").alias("props_k"))


# --- C6 -----------------------------------------------------------------------

@query("validation_status", with_ctes("""
SELECT check_name, passed FROM (
  SELECT 'required_columns:' || dataset AS check_name, all_required_present AS passed FROM presence
  UNION ALL SELECT 'critical_nulls:' || c.col_name, COALESCE(n.missing_count, 0) = 0
    FROM (SELECT unnest(['delay', 'p_1_urgent']) AS col_name) c LEFT JOIN nulls n ON c.col_name = n.col_name
  UNION ALL SELECT 'fk:' || fk_column, invalid_count = 0 FROM fk
  UNION ALL SELECT 'date_range:year', valid_year_range FROM dr
  UNION ALL SELECT 'date_range:month', valid_month_range FROM dr
  UNION ALL SELECT 'date_range:day', valid_day_range FROM dr
  UNION ALL SELECT 'range:' || col_name, invalid_count = 0 FROM rv)
UNION ALL
SELECT 'overall', bool_and(passed) FROM (
  SELECT all_required_present AS passed FROM presence
  UNION ALL SELECT COALESCE(n.missing_count, 0) = 0
    FROM (SELECT unnest(['delay', 'p_1_urgent']) AS col_name) c LEFT JOIN nulls n ON c.col_name = n.col_name
  UNION ALL SELECT invalid_count = 0 FROM fk
  UNION ALL SELECT valid_year_range AND valid_month_range AND valid_day_range FROM dr
  UNION ALL SELECT invalid_count = 0 FROM rv)""",
    shipments=SHIPMENTS_SQL, daily=DAILY_WIDE_SQL,
    sw="SELECT s.delay, w.p_1_urgent FROM shipments s LEFT JOIN daily w ON s.ship_date = w.date",
    presence=PRESENCE_SQL,
    nulls=f"SELECT col_name, count(*) FILTER (WHERE v IS NULL) AS missing_count FROM ("
          + " UNION ALL ".join(f"SELECT '{c}' AS col_name, CAST({c} AS VARCHAR) AS v FROM sw" for c in CRITICAL)
          + ") GROUP BY col_name",
    fk=_FK_SQL.replace("WITH shipments AS", "WITH shipments2 AS").replace("FROM shipments", "FROM shipments2"),
    dr="""SELECT min(year) >= 2000 AND max(year) <= 2030 AS valid_year_range,
             min(month) >= 1 AND max(month) <= 12 AS valid_month_range,
             min(day) >= 1 AND max(day) <= 31 AS valid_day_range FROM shipments""",
    rv=" UNION ALL ".join(f"SELECT '{c}' AS col_name, count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS invalid_count "
                          f"FROM customer" for c, (lo, hi) in RANGE_BOUNDS.items())))
def validation_status(t):
    """One pass/fail row per check and the overall status (no error)."""
    s = shipments_materialized(t)
    checks = quality.validation_status(
        presence=contracts.column_presence(t.spark, {n: t[n] for n in TABLE_CONTRACTS}, TABLE_CONTRACTS),
        nulls=quality.null_counts(shipments_weather(t, s), columns=list(CRITICAL), only_missing=False),
        fk=quality.referential_check(s, ["origin", "dest"], t["nation"], "n_nationkey"),
        dates=quality.date_part_ranges(s),
        ranges=quality.range_violations(t["customer"], RANGE_BOUNDS))
    return checks


HEAD_ORDER = ["order_key", "line_number", "carrier", "distance", "discount", "tax", "sched_time"]


@query("shipments_head_sample", with_ctes(f"""
SELECT order_key, line_number, carrier, ship_date, ROUND(delay, 6) AS delay, ROUND(distance, 6) AS distance
FROM shipments ORDER BY {", ".join(HEAD_ORDER)} LIMIT 100""", shipments=SHIPMENTS_SQL))
def shipments_head_sample(t):
    """The first 100 rows by an explicit order key (the sample is
    the feature; TakeOrderedAndProject keeps only 100 rows per task)."""
    from contrail.sources.tables import head_sample
    return head_sample(shipments(t), 100, HEAD_ORDER).select(
        "order_key", "line_number", "carrier", "ship_date", "delay", "distance")


@query("freq_day_of_month", with_ctes(
    "SELECT day, count(*) AS n FROM shipments GROUP BY day", shipments=SHIPMENTS_SQL))
def freq_day_of_month(t):
    """One-way frequency table of the day of month."""
    from contrail.operators.explore import frequency
    return frequency(shipments(t), ["day"])


@query("distance_bin_counts", with_ctes(f"""
SELECT {_bins_sql('distance')} AS DISTANCE_BIN, count(*) AS n FROM shipments GROUP BY 1""",
    shipments=SHIPMENTS_SQL))
def distance_bin_counts(t):
    """Rows per right-closed distance bin (null = outside every bin)."""
    from contrail.operators.explore import frequency
    s = shipments(t).withColumn("DISTANCE_BIN", fx.distance_bin("distance", SHIP_THRESHOLDS.distance_bins))
    return frequency(s, ["DISTANCE_BIN"])


@query("service_date_range", with_ctes("""
SELECT min(ship_date) AS first_date, max(ship_date) AS last_date, count(DISTINCT ship_date) AS service_days
FROM shipments""", shipments=SHIPMENTS_SQL))
def service_date_range(t):
    """First / last service date and the number of service days."""
    return shipments(t).agg(F.min("ship_date").alias("first_date"), F.max("ship_date").alias("last_date"),
                            F.count_distinct("ship_date").alias("service_days"))
