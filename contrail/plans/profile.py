"""Queries: contracts, data-quality profile, calendar, weather-style joins
and exploratory summaries (B5, C1-C10, A10, D4-D6, E5-E12, E15, E16)."""

from __future__ import annotations

from contrail.functions.features import delay_flag, is_weekend
from contrail.operators import contracts, explore, grouping, joins, quality
from contrail.operators.ordered import split_by_position
from contrail.plans.catalog import query
from contrail.plans.shipments import (SHIPMENTS_SQL, calendar_years, daily_feed_long, locations,
                                      LOCATIONS_SQL, shipments, with_ctes)
from contrail.session import stored
from contrail.sources.calendar import holiday_calendar


def r6(cols):
    return ", ".join(f"ROUND({c}, 6) AS {c}" for c in cols)


# --- B5 -----------------------------------------------------------------------
# Contracts for the driver tables (parameters of the report, not data).
TABLE_CONTRACTS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_shipdate", "l_receiptdate"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "supplier": ["s_suppkey", "s_name"],
    "events": ["event_id", "ts", "user_id", "value", "latency_ms"],
}
_REQ_VALUES = ", ".join(f"('{t}', '{c}')" for t, cols in TABLE_CONTRACTS.items() for c in cols)
_TABLE_LIST = ", ".join(f"'{t}'" for t in TABLE_CONTRACTS)

PRESENCE_SQL = f"""
WITH req(dataset, col) AS (VALUES {_REQ_VALUES}),
have AS (SELECT table_name AS dataset, column_name AS col FROM information_schema.columns
         WHERE table_name IN ({_TABLE_LIST})),
ds AS (SELECT DISTINCT dataset FROM req)
SELECT ds.dataset,
  CAST((SELECT count(*) FROM req r WHERE r.dataset = ds.dataset) AS BIGINT) AS required_columns_count,
  CAST((SELECT count(*) FROM have h WHERE h.dataset = ds.dataset) AS BIGINT) AS existing_columns_count,
  COALESCE((SELECT string_agg(r.col, ',' ORDER BY r.col) FROM req r WHERE r.dataset = ds.dataset
            AND r.col NOT IN (SELECT h.col FROM have h WHERE h.dataset = ds.dataset)), '') AS missing_columns,
  CAST((SELECT count(*) FROM req r WHERE r.dataset = ds.dataset
        AND r.col NOT IN (SELECT h.col FROM have h WHERE h.dataset = ds.dataset)) AS BIGINT) AS missing_columns_count,
  COALESCE((SELECT string_agg(h.col, ',' ORDER BY h.col) FROM have h WHERE h.dataset = ds.dataset
            AND h.col NOT IN (SELECT r.col FROM req r WHERE r.dataset = ds.dataset)), '') AS extra_columns,
  (SELECT count(*) FROM req r WHERE r.dataset = ds.dataset
        AND r.col NOT IN (SELECT h.col FROM have h WHERE h.dataset = ds.dataset)) = 0 AS all_required_present
FROM ds
"""


@query("column_presence_report", PRESENCE_SQL)
def column_presence_report(t):
    """Required / existing / missing / extra columns per driver table."""
    return contracts.column_presence(t.spark, {n: t[n] for n in TABLE_CONTRACTS}, TABLE_CONTRACTS)


# --- the daily feed (weather role) and its joins ------------------------------
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
FEED_COLS = [explore.safe_name(p, "p_") for p in PRIORITIES]
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
EVENT_COLS = [explore.safe_name(e, "ev_") for e in EVENT_TYPES]


def daily_feed_wide(t):
    return explore.pivot_daily(daily_feed_long(t), "obs_ts", "datatype", "value", prefix="p_")


def daily_feed_stored(t):
    """The wide feed, one row per date, stored for joins to the fact: its size is known when they are planned."""
    return t.derived("daily_feed_stored", lambda tt: stored(daily_feed_wide(tt)))


DAILY_WIDE_SQL = "SELECT CAST(o_orderdate AS DATE) AS date, " + ", ".join(
    f"avg(o_totalprice) FILTER (WHERE o_orderpriority = '{p}') AS {c}" for p, c in zip(PRIORITIES, FEED_COLS)) + \
    " FROM orders GROUP BY 1"

EVENT_WIDE_SQL = "SELECT CAST(ts AS DATE) AS date, " + ", ".join(
    f"avg(value) FILTER (WHERE event_type = '{e}') AS {c}" for e, c in zip(EVENT_TYPES, EVENT_COLS)) + \
    " FROM events GROUP BY 1"


@query("daily_feed_wide", f"SELECT date, {r6(FEED_COLS)} FROM ({DAILY_WIDE_SQL})")
def q_daily_feed_wide(t):
    """E5: long daily readings (orders: date, priority, price) -> wide by date."""
    return daily_feed_wide(t)


@query("event_daily_wide", f"SELECT date, {r6(EVENT_COLS)} FROM ({EVENT_WIDE_SQL})")
def q_event_daily_wide(t):
    """E5 on the events feed: (date(ts), event_type, value) -> wide by date."""
    return explore.pivot_daily(t["events"], "ts", "event_type", "value", prefix="ev_")


def shipments_weather(t, fact=None):
    s = (fact if fact is not None else shipments(t)).select("order_key", "line_number", "ship_date", "carrier", "origin", "dest", "delay")
    w = daily_feed_stored(t).withColumnRenamed("date", "_d")
    return s.join(w, s.ship_date == w._d, "left").drop("_d")


SHIP_WEATHER_SQL = with_ctes(
    "SELECT s.order_key, s.line_number, s.ship_date, s.carrier, s.origin, s.dest, s.delay, "
    + ", ".join(f"w.{c}" for c in FEED_COLS)
    + " FROM shipments s LEFT JOIN daily w ON s.ship_date = w.date",
    shipments=SHIPMENTS_SQL, daily=DAILY_WIDE_SQL)

_SW_COLS = ["order_key", "line_number", "ship_date", "carrier", "origin", "dest", "delay"] + FEED_COLS


def _null_sql(src: str, cols, only_missing: bool, critical=()) -> str:
    one = ", ".join(f"count(*) - count({c}) AS {c}" for c in cols)
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, CAST({c} AS BIGINT) AS missing_count, N FROM one" for c in cols)
    crit = ", ".join(f"'{c}'" for c in critical) or "NULL"
    where = "WHERE missing_count > 0" if only_missing else ""
    return f"""
WITH src AS ({src}), one AS (SELECT count(*) AS N, {one} FROM src),
long AS ({union})
SELECT col_name, missing_count,
       CASE WHEN N > 0 THEN ROUND(missing_count * 100.0 / N, 2) ELSE 0.0 END AS missing_pct,
       CAST(N AS BIGINT) AS total_rows, COALESCE(col_name IN ({crit}), false) AS critical
FROM long {where}"""


CRITICAL = ("delay", "p_1_urgent")


@query("null_profile", _null_sql(SHIP_WEATHER_SQL, _SW_COLS, True, CRITICAL))
def null_profile(t):
    """Columns with nulls after the daily-feed join, critical ones flagged."""
    return quality.null_counts(shipments_weather(t), critical=CRITICAL)


@query("null_counts_all", _null_sql(DAILY_WIDE_SQL, ["date"] + FEED_COLS, False))
def null_counts_all(t):
    """Null count of every column of the wide daily feed."""
    return quality.null_counts(daily_feed_wide(t), only_missing=False)


@query("duplicate_profile", """
SELECT CAST(count(*) AS BIGINT) AS total_rows,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) AS BIGINT)
         AS duplicate_count,
       CASE WHEN count(*) > 0 THEN ROUND((count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders))) * 100.0 / count(*), 2) ELSE 0.0 END AS duplicate_percentage
FROM orders""")
def duplicate_profile(t):
    """Rows of orders that repeat an earlier one in all columns."""
    return quality.duplicate_profile(t["orders"])


_FK_SQL = with_ctes("""
SELECT fk_column, CAST(count(*) AS BIGINT) AS unique_codes,
       CAST(count(*) FILTER (WHERE NOT valid) AS BIGINT) AS invalid_count,
       CAST((SELECT count(DISTINCT n_nationkey) FROM nation) AS BIGINT) AS valid_codes_count
FROM (SELECT c.fk_column, c.code, c.code IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation) AS valid
      FROM (SELECT DISTINCT 'origin' AS fk_column, CAST(origin AS VARCHAR) AS code FROM shipments
            UNION SELECT DISTINCT 'dest', CAST(dest AS VARCHAR) FROM shipments) c)
GROUP BY fk_column""", shipments=SHIPMENTS_SQL)


@query("referential_summary", _FK_SQL)
def referential_summary(t):
    """Origin / destination codes of the fact checked against the location dim."""
    return quality.referential_check(shipments(t), ["origin", "dest"], t["nation"], "n_nationkey")


@query("invalid_codes", """
SELECT fk_column, code FROM (
  SELECT DISTINCT 'user_id' AS fk_column, CAST(user_id AS VARCHAR) AS code FROM events)
WHERE code IS NULL OR code NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)""")
def q_invalid_codes(t):
    """C3 detail: event users with no matching supplier account, one row per code."""
    return quality.invalid_codes(t["events"], ["user_id"], t["supplier"], "s_suppkey")


@query("date_part_ranges", with_ctes("""
SELECT CAST(min(year) AS VARCHAR) || '-' || CAST(max(year) AS VARCHAR) AS year_range,
       CAST(min(month) AS VARCHAR) || '-' || CAST(max(month) AS VARCHAR) AS month_range,
       CAST(min(day) AS VARCHAR) || '-' || CAST(max(day) AS VARCHAR) AS day_range,
       min(year) >= 2000 AND max(year) <= 2030 AS valid_year_range,
       min(month) >= 1 AND max(month) <= 12 AS valid_month_range,
       min(day) >= 1 AND max(day) <= 31 AS valid_day_range
FROM shipments""", shipments=SHIPMENTS_SQL))
def date_part_ranges(t):
    """C4: year / month / day ranges of the fact and their validity."""
    return quality.date_part_ranges(shipments(t))


RANGE_BOUNDS = {"c_acctbal": (0.0, 9999.99), "c_nationkey": (0, 24)}


@query("range_violations", " UNION ALL ".join(
    f"""SELECT '{c}' AS col_name, CAST(count(*) AS BIGINT) AS total_rows,
       CAST(count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS BIGINT) AS invalid_count,
       printf('%.2f', CAST(min({c}) AS DOUBLE)) || ' to ' || printf('%.2f', CAST(max({c}) AS DOUBLE)) AS value_range
FROM customer""" for c, (lo, hi) in RANGE_BOUNDS.items()))
def range_violations(t):
    """Values outside plausible bounds (balance, nation key) with min-to-max text."""
    return quality.range_violations(t["customer"], RANGE_BOUNDS)


def _event_halves(t):
    return split_by_position(t["events"], "event_id")


EVENT_HALVES_SQL = """
WITH ranked AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS pos,
                       count(*) OVER () AS n FROM events),
ref AS (SELECT * EXCLUDE (pos, n) FROM ranked WHERE pos < n // 2),
cur AS (SELECT * EXCLUDE (pos, n) FROM ranked WHERE pos >= n // 2)
"""

QS_FEATURES = ("value", "user_id")


@query("quality_score", EVENT_HALVES_SQL + f""",
b AS (SELECT avg(value) AS m_v, stddev_pop(value) AS s_v, avg(user_id) AS m_u, stddev_pop(user_id) AS s_u FROM ref),
c AS (SELECT count(*) AS N,
             (count(event_id) + count(ts) + count(user_id) + count(event_type) + count(value) + count(props))
               / (count(*) * 6.0) AS complete,
             avg(CASE WHEN value IS NOT NULL THEN CAST(value BETWEEN (SELECT m_v - 3 * s_v FROM b)
                   AND (SELECT m_v + 3 * s_v FROM b) AS DOUBLE) END) AS in_v,
             avg(CASE WHEN user_id IS NOT NULL THEN CAST(user_id BETWEEN (SELECT m_u - 3 * s_u FROM b)
                   AND (SELECT m_u + 3 * s_u FROM b) AS DOUBLE) END) AS in_u
      FROM cur)
SELECT ROUND(CASE WHEN N = 0 THEN 0.0 ELSE complete END, 6) AS completeness,
       ROUND(CASE WHEN N = 0 THEN NULL ELSE (in_v + in_u) / 2 END, 6) AS range_validity,
       ROUND(CASE WHEN N = 0 THEN 0.0 ELSE 0.5 * complete + 0.5 * (in_v + in_u) / 2 END, 6) AS quality_score
FROM c""")
def quality_score(t):
    """Completeness and baseline-range validity of the second half of
    events against the first half (split by event position)."""
    ref, cur = _event_halves(t)
    return quality.quality_score(cur, ref, QS_FEATURES)


R_CLASS_SQL = """CASE WHEN data_type IN ('INTEGER','BIGINT','SMALLINT') THEN 'integer'
 WHEN data_type IN ('DOUBLE','FLOAT','REAL') OR data_type LIKE 'DECIMAL%' THEN 'numeric'
 WHEN data_type = 'VARCHAR' THEN 'character' WHEN data_type = 'BOOLEAN' THEN 'logical'
 WHEN data_type = 'DATE' THEN 'Date' WHEN data_type LIKE 'TIMESTAMP%' THEN 'POSIXct' ELSE 'other' END"""

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("column_profile", f"""
WITH long AS ({" UNION ALL ".join(f"SELECT '{c}' AS col_name, CAST({c} AS VARCHAR) AS value FROM orders" for c in _ORDER_COLS)}),
prof AS (SELECT col_name, CAST(count(DISTINCT value) + max(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unique_values,
                CAST(count(*) - count(value) AS BIGINT) AS missing_count, count(*) AS N FROM long GROUP BY col_name),
cls AS (SELECT column_name AS col_name, {R_CLASS_SQL} AS col_class FROM information_schema.columns WHERE table_name = 'orders')
SELECT p.col_name, c.col_class, p.unique_values, p.missing_count, ROUND(p.missing_count * 100.0 / p.N, 2) AS missing_pct
FROM prof p JOIN cls c ON p.col_name = c.col_name""")
def column_profile(t):
    """Class, distinct values (NA counted), missing count and pct per orders column."""
    return quality.column_profile(t["orders"])


@query("key_set_mismatch", """
SELECT COALESCE(a.key, b.key) AS key, a.key IS NOT NULL AS in_dim, b.key IS NOT NULL AS in_fact
FROM (SELECT DISTINCT c_custkey AS key FROM customer) a
FULL OUTER JOIN (SELECT DISTINCT o_custkey AS key FROM orders) b ON a.key = b.key
WHERE a.key IS NULL OR b.key IS NULL""")
def key_set_mismatch(t):
    """Customers never ordering / orders of unknown customers."""
    return quality.key_set_mismatch(t["customer"], "c_custkey", t["orders"], "o_custkey")


@query("distinct_counts", with_ctes("""
SELECT 'carrier' AS col_name, CAST(count(DISTINCT carrier) AS BIGINT) AS distinct_count FROM shipments
UNION ALL SELECT 'origin', CAST(count(DISTINCT origin) AS BIGINT) FROM shipments
UNION ALL SELECT 'dest', CAST(count(DISTINCT dest) AS BIGINT) FROM shipments""", shipments=SHIPMENTS_SQL))
def distinct_counts(t):
    """C10 companion: distinct codes per role column of the fact."""
    return quality.distinct_counts(shipments(t), ["carrier", "origin", "dest"])


# --- A10, D4-D6 ---------------------------------------------------------------

def _holiday_rules_sql(d: str) -> str:
    from contrail.sources.calendar import FIXED_HOLIDAYS, FLOATING_HOLIDAYS, OBSERVED_SUFFIX

    def fixed(x):
        parts = []
        for name, m, dd, since in FIXED_HOLIDAYS:
            cond = f"month({x}) = {m} AND day({x}) = {dd}" + (f" AND year({x}) >= {since}" if since else "")
            parts.append(f"WHEN {cond} THEN '{name.replace(chr(39), chr(39) * 2)}'")
        return "CASE " + " ".join(parts) + " END"

    flo = []
    for name, m, dow, n, since in FLOATING_HOLIDAYS:
        occ = (f"day({d}) + 7 > day(last_day({d}))" if n == -1 else f"(day({d}) - 1) // 7 + 1 = {n}")
        cond = f"month({d}) = {m} AND isodow({d}) = {dow} AND {occ}" + (f" AND year({d}) >= {since}" if since else "")
        flo.append(f"WHEN {cond} THEN '{name.replace(chr(39), chr(39) * 2)}'")
    floating = "CASE " + " ".join(flo) + " END"
    nxt, prv = f"CAST({d} + INTERVAL 1 DAY AS DATE)", f"CAST({d} - INTERVAL 1 DAY AS DATE)"
    observed = (f"CASE WHEN isodow({d}) = 5 THEN {fixed(nxt)} || '{OBSERVED_SUFFIX}' "
                f"WHEN isodow({d}) = 1 THEN {fixed(prv)} || '{OBSERVED_SUFFIX}' END")
    return f"COALESCE({fixed(d)}, {floating}, {observed})"


HOLIDAYS_SQL = with_ctes(f"""
SELECT date, holiday_name, 1 AS is_holiday FROM (
  SELECT CAST(g AS DATE) AS date, {_holiday_rules_sql('CAST(g AS DATE)')} AS holiday_name
  FROM (SELECT DISTINCT year FROM shipments) y,
       generate_series(make_date(CAST(y.year AS INT), 1, 1), make_date(CAST(y.year AS INT), 12, 31), INTERVAL 1 DAY) s(g))
WHERE holiday_name IS NOT NULL""", shipments=SHIPMENTS_SQL)


@query("holiday_calendar", HOLIDAYS_SQL.replace("1 AS is_holiday", "CAST(1 AS INT) AS is_holiday"))
def q_holiday_calendar(t):
    """A10: federal holiday calendar for every year present in the fact."""
    return holiday_calendar(calendar_years(t))


@query("shipments_holidays", with_ctes(f"""
SELECT s.order_key, s.line_number, s.ship_date, COALESCE(h.holiday_name, 'None') AS holiday_name,
       CAST(COALESCE(h.is_holiday, 0) AS INT) AS is_holiday
FROM shipments s LEFT JOIN ({HOLIDAYS_SQL}) h ON s.ship_date = h.date""", shipments=SHIPMENTS_SQL))
def shipments_holidays(t):
    """Fact LEFT JOIN the holiday calendar on the service date."""
    s = shipments(t)
    cal = stored(holiday_calendar(calendar_years(t)))
    return joins.join_holidays(s, cal, date_col="ship_date") \
        .select("order_key", "line_number", "ship_date", "holiday_name", "is_holiday")


FILL_MED = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in FEED_COLS)


@query("weather_fill", f"""
WITH j AS ({SHIP_WEATHER_SQL}), m AS (SELECT {FILL_MED} FROM j)
SELECT j.* REPLACE ({", ".join(f"ROUND(COALESCE(j.{c}, m.m_{c}), 6) AS {c}" for c in FEED_COLS)},
                    ROUND(j.delay, 6) AS delay)
FROM j, m""")
def weather_fill(t):
    """Fact LEFT JOIN daily feed, nulls filled with the median over the
    joined rows (before any target drop)."""
    s = stored(shipments(t).select("order_key", "line_number", "ship_date", "carrier", "origin", "dest", "delay"))
    return joins.join_daily_and_fill(s, daily_feed_stored(t), "ship_date", "date", FEED_COLS)


@query("cleaned_shipments", f"""
SELECT DISTINCT carrier, origin, dest, ship_date, {r6(FEED_COLS)}
FROM ({SHIP_WEATHER_SQL}) WHERE p_1_urgent IS NOT NULL""")
def cleaned_shipments(t):
    """Drop rows with a null target (the urgent-price reading), drop
    spare columns, drop duplicate rows."""
    sw = shipments_weather(t)
    return joins.clean_joined(sw, "p_1_urgent", drop_cols=["order_key", "line_number", "delay"])


# --- E6-E12, E15, E16 ---------------------------------------------------------

@query("class_balance", with_ctes("""
SELECT CASE WHEN delay > 15 THEN 1 ELSE 0 END AS delayed, count(*) AS n FROM shipments GROUP BY 1""",
       shipments=SHIPMENTS_SQL))
def class_balance(t):
    """Delayed (> 15) vs on-time rows."""
    return explore.class_balance(shipments(t), "delay")


@query("carrier_mean_delay_named", with_ctes("""
SELECT s.s_name AS name, m.carrier, ROUND(m.mean_value, 6) AS mean_value
FROM (SELECT carrier, avg(delay) AS mean_value FROM shipments GROUP BY carrier) m
LEFT JOIN supplier s ON m.carrier = s.s_suppkey""", shipments=SHIPMENTS_SQL))
def carrier_mean_delay_named(t):
    """E7 + D8: mean delay per carrier with the carrier name, ascending."""
    return explore.named_group_means(shipments(t), "carrier", "delay", t["supplier"], "s_suppkey", "s_name")


@query("freq_year_month", with_ctes(
    "SELECT year, month, count(*) AS n FROM shipments GROUP BY year, month", shipments=SHIPMENTS_SQL))
def freq_year_month(t):
    """Two-way frequency table year x month."""
    return explore.frequency(shipments(t), ["year", "month"])


@query("freq_day_of_week", with_ctes(
    "SELECT day_of_week, count(*) AS n FROM shipments GROUP BY day_of_week", shipments=SHIPMENTS_SQL))
def freq_day_of_week(t):
    """One-way frequency table of the weekday."""
    return explore.frequency(shipments(t), ["day_of_week"])


@query("crosstab_flag_priority", with_ctes("""
SELECT return_flag, """ + ", ".join(
    f"count(*) FILTER (WHERE priority = '{p}') AS \"{p}\"" for p in PRIORITIES)
    + " FROM shipments GROUP BY return_flag", shipments=SHIPMENTS_SQL))
def crosstab_flag_priority(t):
    """E8 wide: return flag x priority with zero cells filled."""
    return explore.crosstab_wide(shipments(t), "return_flag", "priority")


@query("freq_region", with_ctes("""
SELECT l.loc_region, count(*) AS n FROM shipments s LEFT JOIN locations l ON s.origin = l.loc_key
GROUP BY l.loc_region""", shipments=SHIPMENTS_SQL, locations=LOCATIONS_SQL))
def freq_region(t):
    """Frequency of the origin region (location attribute via the dim)."""
    s = joins.enrich(shipments(t), locations(t), "origin", "loc_key")
    return explore.frequency(s, ["loc_region"])


@query("top_nations_by_customers", """
SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey ORDER BY n DESC, c_nationkey LIMIT 10""")
def top_nations_by_customers(t):
    """Top-10 nations by customer count, ties by key."""
    return explore.top_k(t["customer"], "c_nationkey", 10)


SUMMARY_COLS = ["delay", "distance", "sched_time", "elapsed_time", "discount"]


def _long_sql(src: str, cols) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS col_name, CAST({c} AS DOUBLE) AS v FROM {src}" for c in cols)


@query("numeric_summary", with_ctes(f"""
SELECT col_name, {r6(['min', 'q1', 'median', 'mean', 'q3', 'max'])}, na_count FROM (
  SELECT col_name, min(v) AS min, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
         avg(v) AS mean, quantile_cont(v, 0.75) AS q3, max(v) AS max,
         CAST(count(*) - count(v) AS BIGINT) AS na_count
  FROM ({_long_sql('shipments', SUMMARY_COLS)}) GROUP BY col_name)""", shipments=SHIPMENTS_SQL))
def numeric_summary(t):
    """Min, quartiles, mean, max and NA count of the fact's measures."""
    return explore.numeric_summary(shipments(t), SUMMARY_COLS)


POS_COLS = ["delay", "discount", "tax"]
POS_PROBS = explore.BODY_PROBS + explore.TAIL_PROBS[1:]


@query("positive_quantiles", with_ctes(f"""
SELECT col_name, CAST(p AS DOUBLE) AS p, ROUND(q, 6) AS q FROM (
  SELECT col_name, unnest(ps) AS p, unnest(qs) AS q FROM (
    SELECT col_name, {list(POS_PROBS)} AS ps, quantile_cont(v, {list(POS_PROBS)}) AS qs
    FROM ({_long_sql('shipments', POS_COLS)}) WHERE v > 0 GROUP BY col_name))""", shipments=SHIPMENTS_SQL))
def positive_quantiles(t):
    """Body and tail quantiles of the positive values of delay, discount and tax."""
    return explore.positive_quantiles(shipments(t), POS_COLS, POS_PROBS)


BOX_COLS = ["delay", "distance", "elapsed_time"]


@query("boxplot_stats", with_ctes(f"""
SELECT f.col_name, {r6(['q1', 'median', 'q3', 'iqr'])},
       ROUND(min(CASE WHEN v BETWEEN lo AND hi THEN v END), 6) AS lower_whisker,
       ROUND(max(CASE WHEN v BETWEEN lo AND hi THEN v END), 6) AS upper_whisker,
       CAST(count(*) FILTER (WHERE NOT (v BETWEEN lo AND hi)) AS BIGINT) AS outliers
FROM l JOIN f ON l.col_name = f.col_name WHERE v IS NOT NULL
GROUP BY f.col_name, q1, median, q3, iqr""",
    shipments=SHIPMENTS_SQL, l=_long_sql('shipments', BOX_COLS),
    qq="""SELECT col_name, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
              quantile_cont(v, 0.75) AS q3 FROM l WHERE v IS NOT NULL GROUP BY col_name""",
    f="SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM qq"))
def boxplot_stats(t):
    """Quartiles, 1.5 IQR whiskers and outlier counts."""
    return explore.boxplot_stats(shipments(t), BOX_COLS)


@query("feature_shares", with_ctes(f"""
SELECT ROUND(avg(CASE WHEN day_of_week IN (6, 7) THEN 1 ELSE 0 END) * 100.0, 4) AS weekend_pct,
       ROUND(avg(CASE WHEN delay > 15 THEN 1 ELSE 0 END) * 100.0, 4) AS delayed_pct,
       ROUND(avg(CASE WHEN h.date IS NOT NULL THEN 1 ELSE 0 END) * 100.0, 4) AS holiday_pct
FROM shipments s LEFT JOIN ({HOLIDAYS_SQL}) h ON s.ship_date = h.date""", shipments=SHIPMENTS_SQL))
def feature_shares(t):
    """Weekend, delayed and holiday shares of the fact in one aggregate."""
    s = shipments(t)
    j = joins.join_holidays(s, stored(holiday_calendar(calendar_years(t))), date_col="ship_date")
    return explore.flag_shares(j, {"weekend_pct": is_weekend("day_of_week"),
                                   "delayed_pct": delay_flag("delay"),
                                   "holiday_pct": "is_holiday"})


@query("category_shares", """
SELECT event_type, count(*) AS n, ROUND(count(*) * 1.0 / sum(count(*)) OVER (), 6) AS share
FROM events WHERE event_type IS NOT NULL GROUP BY event_type""")
def category_shares(t):
    """Relative frequency of each event type."""
    return grouping.relative_frequency(t["events"], "event_type")


@query("target_summary", with_ctes("""
SELECT ROUND(avg(delay), 6) AS target_mean, ROUND(quantile_cont(delay, 0.5), 6) AS target_median,
       ROUND(stddev_samp(delay), 6) AS target_std FROM shipments""", shipments=SHIPMENTS_SQL))
def target_summary(t):
    """Mean, median and std of the target."""
    return contracts.target_summary(shipments(t), "delay")
