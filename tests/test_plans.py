"""Physical-plan shape: pruning, partial aggregation, no repeated big join."""

import re

import __spark_entry__ as E

from paths import SMOKE


def executed_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_scan_is_pruned_and_filtered(spark):
    from contrail.plans.shipments import shipments
    from contrail.sources.tables import Tables
    qe = shipments(Tables(spark, SMOKE)).where("carrier = 5")._jdf.queryExecution()
    text = qe.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    schema = re.search(r"ReadSchema: (struct<l_orderkey[^>]*>)", text)
    assert schema and "l_linestatus" not in schema.group(1)
    # the fact keeps lineitems without a key, so only a filter of its own reaches the scan
    assert "EqualTo(l_suppkey,5)" in text


def test_group_stats_aggregate_map_side(spark):
    plan = executed_plan(E.queries()["origin_delay_stats"](spark, SMOKE))
    assert "partial_avg" in plan


def test_multi_branch_plan_joins_the_fact_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed_plan(E.queries()["shipments_with_group_stats"](spark, SMOKE))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    # the fact comes from one checkpoint: only the three group-stat joins remain
    assert plan.count("SortMergeJoin") <= 3
    assert "lineitem.parquet" not in plan
