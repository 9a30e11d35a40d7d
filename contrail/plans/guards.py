"""Queries: what guards the joins and the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from contrail.operators import joins
from contrail.plans.catalog import query
from contrail.plans.shipments import SHIPMENTS_SQL, carriers, locations, shipments, with_ctes
from contrail.session import ensure_checkpoint_dir
from contrail.sources.tables import quarantine_rows


@query("repeated_dimension_keys", """
SELECT dim, key, count(*) AS n FROM (
  SELECT 'carriers' AS dim, CAST(s_suppkey AS VARCHAR) AS key FROM supplier UNION ALL SELECT 'locations', CAST(n_nationkey AS VARCHAR) FROM nation
  UNION ALL SELECT 'orders by customer', CAST(o_custkey AS VARCHAR) FROM orders) WHERE key IS NOT NULL GROUP BY ALL HAVING count(*) > 1""")
def repeated_dimension_keys(t):
    """Keys that would repeat fact rows; the dimensions have none, orders by customer many."""
    return joins.repeated_keys({"carriers": (carriers(t), "carrier_key"), "locations": (locations(t), "loc_key"), "orders by customer": (t["orders"], "o_custkey")})


@query("quarantined_shipments", with_ctes("""
SELECT * FROM (
  SELECT 'validated' AS rows, count(*) FILTER (ok_delay AND ok_distance) AS n FROM r UNION ALL SELECT 'invalidated', count(*) FILTER (NOT (ok_delay AND ok_distance)) FROM r
  UNION ALL SELECT 'delay', count(*) FILTER (NOT ok_delay) FROM r UNION ALL SELECT 'distance', count(*) FILTER (NOT ok_distance) FROM r
  UNION ALL SELECT 'stored invalidated', count(*) FILTER (NOT (ok_delay AND ok_distance)) FROM r)""", shipments=SHIPMENTS_SQL,
    r="SELECT COALESCE(delay BETWEEN -300 AND 300, false) AS ok_delay, COALESCE(distance < 50000, false) AS ok_distance FROM shipments"))
def quarantined_shipments(t):
    """A4: rows set aside by rule, counted by the job that writes them, and what the table then holds."""
    path = f"{ensure_checkpoint_dir(t.spark)}/quarantine-{uuid.uuid4().hex}"
    counts = quarantine_rows(shipments(t), {"delay": F.col("delay").between(-300, 300), "distance": F.col("distance") < 50000}, path)
    stored = t.spark.read.parquet(path).where("quality = 'invalidated'").agg(F.lit("stored invalidated").alias("rows"), F.count(F.lit(1)).alias("n"))
    return t.spark.createDataFrame(list(counts.items()), "rows string, n long").unionByName(stored)
