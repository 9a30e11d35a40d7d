"""What is shuffled and written for the fact (findings F4 - F8 of round 3)."""

import __spark_entry__ as E
from contrail.plans.shipments import shipments, shipments_materialized
from contrail.sources.tables import Tables

from paths import SMOKE
from test_plans import executed_plan


def test_group_stats_of_known_size_shuffle_no_rows(spark):
    plan = executed_plan(E.queries()["shipments_with_group_stats"](spark, SMOKE))
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_stored_fact_is_columnar(spark):
    df = shipments_materialized(Tables(spark, SMOKE))
    assert df.inputFiles() and all(f.endswith(".parquet") for f in df.inputFiles())
    assert df.exceptAll(shipments(Tables(spark, SMOKE))).count() == 0


def test_customer_joins_orders_not_the_fact(spark):
    plan = shipments(Tables(spark, SMOKE))._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    depth = {k: next(line.index("Join") for line in joins if k in line) for k in ("o_custkey", "l_orderkey")}
    assert depth["o_custkey"] > depth["l_orderkey"]


def test_daily_tables_are_made_before_the_fact_meets_them(spark):
    plan = executed_plan(E.queries()["engineered_features"](spark, SMOKE))
    assert "HashAggregate" not in plan
