"""Queries: star-schema joins and group statistics."""

from __future__ import annotations


from contrail.operators import grouping, joins
from contrail.plans.catalog import query
from contrail.plans.shipments import (CARRIERS_SQL, LOCATIONS_SQL, SHIPMENTS_SQL,
                                      carriers, locations, shipments, shipments_materialized, with_ctes)


def r6(cols):
    return ", ".join(f"ROUND({c}, 6) AS {c}" for c in cols)


STAR_SQL = with_ctes("""
SELECT f.*, c.carrier_name,
       o.loc_name AS origin_loc_name, o.loc_region AS origin_loc_region,
       d.loc_name AS dest_loc_name, d.loc_region AS dest_loc_region
FROM shipments f
LEFT JOIN carriers c ON f.carrier = c.carrier_key
LEFT JOIN locations o ON f.origin = o.loc_key
LEFT JOIN locations d ON f.dest = d.loc_key
""", shipments=SHIPMENTS_SQL, carriers=CARRIERS_SQL, locations=LOCATIONS_SQL)

_FACT_DOUBLES = ["delay", "distance", "sched_time", "elapsed_time", "discount", "tax", "net_amount"]


@query("star_enriched_shipments", f"""
SELECT * REPLACE ({r6(_FACT_DOUBLES)}) FROM ({STAR_SQL})""")
def star_enriched_shipments(t):
    """Fact LEFT JOIN carrier dim LEFT JOIN location dim twice (roles)."""
    return joins.enrich_star(shipments(t), carriers(t), locations(t))


@query("origin_delay_stats", with_ctes(f"""
SELECT origin, {r6(['origin_avg_delay', 'origin_std_delay', 'origin_delay_rate'])} FROM (
  SELECT origin, avg(delay) AS origin_avg_delay, stddev_samp(delay) AS origin_std_delay,
         avg(CASE WHEN delay > 15 THEN 1 ELSE 0 END) AS origin_delay_rate
  FROM shipments GROUP BY origin)""", shipments=SHIPMENTS_SQL))
def origin_delay_stats(t):
    """Mean, sample std and delay rate per origin."""
    return grouping.group_delay_stats(shipments(t), ["origin"], "delay", "origin")


@query("carrier_delay_stats", with_ctes(f"""
SELECT carrier, {r6(['carrier_avg_delay', 'carrier_delay_rate'])} FROM (
  SELECT carrier, avg(delay) AS carrier_avg_delay,
         avg(CASE WHEN delay > 15 THEN 1 ELSE 0 END) AS carrier_delay_rate
  FROM shipments GROUP BY carrier)""", shipments=SHIPMENTS_SQL))
def carrier_delay_stats(t):
    """Mean and delay rate per carrier."""
    return grouping.group_delay_stats(shipments(t), ["carrier"], "delay", "carrier", with_std=False)


@query("route_delay_stats", with_ctes(f"""
SELECT route, ROUND(route_avg_delay, 6) AS route_avg_delay, route_flights FROM (
  SELECT CAST(origin AS VARCHAR) || '_' || CAST(dest AS VARCHAR) AS route,
         avg(delay) AS route_avg_delay, count(*) AS route_flights
  FROM shipments GROUP BY 1)""", shipments=SHIPMENTS_SQL))
def route_delay_stats(t):
    """Route key origin_dest, mean delay and flights per route."""
    return grouping.route_stats(shipments(t), "origin", "dest", "delay")


@query("shipments_with_group_stats", with_ctes(f"""
SELECT * REPLACE ({r6(['origin_avg_delay', 'origin_std_delay', 'origin_delay_rate', 'carrier_avg_delay', 'carrier_delay_rate', 'route_avg_delay'])})
FROM (
  SELECT f.* REPLACE ({r6(_FACT_DOUBLES)}),
         CAST(f.origin AS VARCHAR) || '_' || CAST(f.dest AS VARCHAR) AS route,
         o.origin_avg_delay, o.origin_std_delay, o.origin_delay_rate,
         a.carrier_avg_delay, a.carrier_delay_rate, r.route_avg_delay
  FROM shipments f
  LEFT JOIN (SELECT origin, avg(delay) AS origin_avg_delay, stddev_samp(delay) AS origin_std_delay,
                    avg(CASE WHEN delay > 15 THEN 1 ELSE 0 END) AS origin_delay_rate
             FROM shipments GROUP BY origin) o ON f.origin = o.origin
  LEFT JOIN (SELECT carrier, avg(delay) AS carrier_avg_delay,
                    avg(CASE WHEN delay > 15 THEN 1 ELSE 0 END) AS carrier_delay_rate
             FROM shipments GROUP BY carrier) a ON f.carrier = a.carrier
  LEFT JOIN (SELECT CAST(origin AS VARCHAR) || '_' || CAST(dest AS VARCHAR) AS route,
                    avg(delay) AS route_avg_delay FROM shipments GROUP BY 1) r
         ON CAST(f.origin AS VARCHAR) || '_' || CAST(f.dest AS VARCHAR) = r.route
)""", shipments=SHIPMENTS_SQL))
def shipments_with_group_stats(t):
    """D7 + E1-E3: the three group statistics joined back to every row."""
    return grouping.with_group_stats(shipments_materialized(t), "origin", "carrier", "dest", "delay")


@query("origin_prior_stats", with_ctes(f"""
SELECT origin, ship_date, origin_prior_n,
       {r6(['origin_prior_avg', 'origin_prior_std', 'origin_prior_rate'])}
FROM (
  SELECT origin, ship_date,
         CAST(COALESCE(sum(n) OVER w, 0) AS BIGINT) AS origin_prior_n,
         CASE WHEN sum(n) OVER w > 0 THEN sum(s) OVER w / sum(n) OVER w END AS origin_prior_avg,
         CASE WHEN sum(n) OVER w > 1 THEN sqrt(greatest(
              (sum(ss) OVER w - sum(s) OVER w * sum(s) OVER w / sum(n) OVER w) / (sum(n) OVER w - 1), 0.0)) END
           AS origin_prior_std,
         CASE WHEN sum(rws) OVER w > 0 THEN sum(late) OVER w / sum(rws) OVER w END AS origin_prior_rate
  FROM (SELECT origin, ship_date, count(delay) AS n, sum(delay) AS s, sum(delay * delay) AS ss,
               sum(CASE WHEN delay > 15 THEN 1 ELSE 0 END) AS late, count(*) AS rws
        FROM shipments GROUP BY origin, ship_date) d
  WINDOW w AS (PARTITION BY origin ORDER BY ship_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)""", shipments=SHIPMENTS_SQL))
def origin_prior_stats(t):
    """Leakage-safe origin statistics from strictly earlier dates only."""
    return grouping.leakage_safe_stats(shipments(t), "origin", "ship_date", "delay", "origin")
