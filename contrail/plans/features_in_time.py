"""Queries: point-in-time and rolling features (E4 carrier and route, H21, W1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail.functions.features import route_key
from contrail.operators import grouping, ml
from contrail.operators import pointintime as P
from contrail.plans.catalog import query
from contrail.plans.learning import BUCKET_SQL, SPLIT_KEYS
from contrail.plans.shipments import SHIPMENTS_SQL, shipments, with_ctes
from contrail.session import stored

BUCKET_DAYS = 90


def _r6(cols):
    return ", ".join(f"ROUND({c}, 6) AS {c}" for c in cols)


def _daily_sql(key: str, src: str) -> str:
    return f"""SELECT {key}, ship_date, count(delay) AS n, sum(delay) AS s, sum(delay * delay) AS ss,
    sum(CASE WHEN delay > 15 THEN 1 ELSE 0 END) AS late, count(*) AS rws FROM {src} GROUP BY ALL"""


def _stats_sql(key: str, name: str, src: str, upto: str) -> str:
    """Statistics of the rows before (or up to) each date of a key."""
    return f"""SELECT {key}, ship_date, CAST(COALESCE(sum(n) OVER w, 0) AS BIGINT) AS {name}_prior_n,
  CASE WHEN sum(n) OVER w > 0 THEN sum(s) OVER w / sum(n) OVER w END AS {name}_prior_avg,
  CASE WHEN sum(n) OVER w > 1 THEN sqrt(greatest((sum(ss) OVER w - sum(s) OVER w * sum(s) OVER w / sum(n) OVER w) / (sum(n) OVER w - 1), 0.0)) END AS {name}_prior_std,
  CASE WHEN sum(rws) OVER w > 0 THEN sum(late) OVER w / sum(rws) OVER w END AS {name}_prior_rate
FROM ({_daily_sql(key, src)}) d WINDOW w AS (PARTITION BY {key} ORDER BY ship_date ROWS BETWEEN UNBOUNDED PRECEDING AND {upto})"""


_ROUTED = "SELECT *, CAST(origin AS VARCHAR) || '_' || CAST(dest AS VARCHAR) AS route FROM shipments"


def _prior_query(key: str, name: str) -> str:
    cols = P.prior_columns(name)
    return with_ctes(f"SELECT {key}, ship_date, {cols[0]}, {_r6(cols[1:])} FROM ({_stats_sql(key, name, 'routed', '1 PRECEDING')})", shipments=SHIPMENTS_SQL, routed=_ROUTED)


def routed(t):
    return shipments(t).withColumn("route", route_key("origin", "dest"))


@query("carrier_prior_stats", _prior_query("carrier", "carrier"))
def carrier_prior_stats(t):
    """Leakage-safe carrier statistics from strictly earlier dates."""
    return grouping.leakage_safe_stats(shipments(t), "carrier", "ship_date", "delay", "carrier")


@query("route_prior_stats", _prior_query("route", "route"))
def route_prior_stats(t):
    """Leakage-safe route statistics from strictly earlier dates."""
    return grouping.leakage_safe_stats(routed(t), "route", "ship_date", "delay", "route")


def attach_prior(rows, stats: dict, bucket: int = BUCKET_DAYS):
    """Rows with the statistics of each key as of the day before (H21); ``stats`` maps a key
    column to its ``cumulative_stats`` table.

    An as-of join reads both its sides twice, so what one join made is stored for
    the next: chained plans would compute the rows again 2, 4, 8 times."""
    for i, (key, table) in enumerate(stats.items()):
        rows = P.as_of_join(stored(rows) if i else rows, stored(table), [key], "ship_date", "ship_date", P.prior_columns(key), bucket)
    return rows


@query("point_in_time_features", with_ctes(f"""
SELECT t.order_key, t.line_number, o.origin_prior_n, c.carrier_prior_n, r.route_prior_n,
  {', '.join(f'ROUND({a}.{n}_prior_{x}, 6) AS {n}_prior_{x}' for a, n in (('o', 'origin'), ('c', 'carrier'), ('r', 'route')) for x in ('avg', 'std', 'rate'))}
FROM (SELECT * FROM routed WHERE {BUCKET_SQL} >= 8000) t
ASOF LEFT JOIN so o ON t.origin = o.origin AND t.ship_date > o.ship_date
ASOF LEFT JOIN sc c ON t.carrier = c.carrier AND t.ship_date > c.ship_date
ASOF LEFT JOIN sr r ON t.route = r.route AND t.ship_date > r.ship_date""", shipments=SHIPMENTS_SQL, routed=_ROUTED,
    train=f"SELECT * FROM routed WHERE {BUCKET_SQL} < 8000", so=_stats_sql("origin", "origin", "train", "CURRENT ROW"),
    sc=_stats_sql("carrier", "carrier", "train", "CURRENT ROW"), sr=_stats_sql("route", "route", "train", "CURRENT ROW")))
def point_in_time_features(t):
    """Test rows with the latest statistics of the training rows strictly before their date."""
    fact = stored(routed(t).select(*SPLIT_KEYS, "ship_date", "origin", "carrier", "route", "delay"))
    tr, te = ml.hash_split(fact, SPLIT_KEYS)
    stats = {k: P.cumulative_stats(tr, [k], "ship_date", "delay", k) for k in ("origin", "carrier", "route")}
    cols = [c for k in stats for c in P.prior_columns(k)]
    return attach_prior(te.select(*SPLIT_KEYS, "ship_date", "origin", "carrier", "route"), stats).select(*SPLIT_KEYS, *cols)


@query("rolling_origin_features", with_ctes(f"""
SELECT origin, ship_date, ROUND(CASE WHEN sum(n) OVER p > 0 THEN sum(s) OVER p / sum(n) OVER p END, 6) AS rolling_avg, CAST(COALESCE(sum(n) OVER p, 0) AS BIGINT) AS rolling_n,
  ROUND(CASE WHEN sum(n) OVER y > 0 THEN sum(s) OVER y / sum(n) OVER y END, 6) AS lag_avg, CAST(rws AS BIGINT) AS congestion, ROUND(rws * 7.0 / sum(rws) OVER p, 6) AS congestion_ratio
FROM ({_daily_sql('origin', 'shipments')}) d WHERE ship_date IS NOT NULL
WINDOW p AS (PARTITION BY origin ORDER BY ship_date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING),
  y AS (PARTITION BY origin ORDER BY ship_date RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)""", shipments=SHIPMENTS_SQL))
def rolling_origin_features(t):
    """Per origin and day the 7-day mean delay, the day before's, and the congestion."""
    return P.rolling_stats(shipments(t), ["origin"], "ship_date", "delay")
