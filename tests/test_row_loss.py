"""Rows, values and types that must not get lost on the way."""

import math

import pytest
from pyspark.sql import functions as F

from contrail.functions.features import above, below, decode_json_map, encode_json_map, round_display
from contrail.operators import explore, ml, quality
from contrail.plans.shipments import shipments
from contrail.session import ensure_checkpoint_dir, path_exists
from contrail.sources.tables import Tables, load_table

SMOKE = "/root/testdata/sf0.001"


def test_split_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (None, None)], "k long, s string")
    train, test = ml.hash_split(df, ["k", "s"])
    assert train.count() + test.count() == 4


def test_nan_is_no_extreme(spark):
    df = spark.createDataFrame([(math.nan,), (None,), (99.0,), (1.0,)], "x double")
    assert [tuple(r) for r in df.select(above("x", 95), below("x", 5)).collect()] == [(0, 0), (0, 0), (1, 0), (0, 1)]


def test_scan_reads_nan_as_missing(spark, tmp_path):
    spark.createDataFrame([(1, math.nan), (2, None), (3, 1.0)], "k long, x double").write.parquet(f"{tmp_path}/t.parquet")
    t = load_table(spark, str(tmp_path), "t")
    assert {r["col_name"]: r["missing_count"] for r in quality.null_counts(t, only_missing=False).collect()} == {"k": 0, "x": 2}


def test_fact_keeps_orphans(spark):
    t = Tables(spark, SMOKE)
    orphan = t["lineitem"].limit(1).withColumns({"l_orderkey": F.lit(-1).cast("long"), "l_suppkey": F.lit(-1).cast("long")})
    n = t["lineitem"].count()
    t["lineitem"] = t["lineitem"].unionByName(orphan)
    fact = shipments(t)
    assert fact.count() == n + 1
    row = fact.where("order_key = -1").first()
    assert row["origin"] is None and row["dest"] is None and row["delay"] is None


def test_pivot_takes_unlisted_types(spark):
    long = spark.createDataFrame([("2024-01-01", "a", 1.0), ("2024-01-01", "new", 2.0), ("2024-01-02", None, 3.0)], "ts string, k string, v double")
    wide = explore.pivot_daily(long, "ts", "k", "v", prefix="p_")
    assert wide.columns == ["date", "p_a", "p_new"] and wide.count() == 2


def test_range_violations_one_row_per_bound(spark):
    df = spark.createDataFrame([(1.0, 5.0), (200.0, None)], "a double, b double")
    got = {r["col_name"]: (r["total_rows"], r["invalid_count"], r["value_range"]) for r in quality.range_violations(df, {"a": (0, 10), "b": (0, 1)}).collect()}
    assert got == {"a": (2, 1, "1.00 to 200.00"), "b": (2, 1, "5.00 to 5.00")}


def test_checkpoint_folder(spark):
    folder = ensure_checkpoint_dir(spark)
    assert path_exists(spark, folder) and not path_exists(spark, f"file://{folder}/nothing-here")


def test_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_json_map_and_display(spark):
    df = spark.createDataFrame([('{"k": "1"}', 1.25), ("bad", 2.0)], "j string, x double")
    got = df.select(encode_json_map(decode_json_map("j")).alias("j"), round_display("x").alias("x")).collect()
    assert [tuple(r) for r in got] == [('{"k":"1"}', 1.3), ("{}", 2.0)]
