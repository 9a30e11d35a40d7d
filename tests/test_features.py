"""Row-level features against the hand-made edge tables (FIXTURES part C)."""

import math

from pyspark.sql import functions as F

from contrail.functions import features as fx


def col(spark, rows, name, dtype):
    return spark.createDataFrame([(r,) for r in rows], f"{name} {dtype}")


def test_distance_bins_right_closed(spark):
    vals = [0.0, 0.5, 500.0, 500.5, 1000.0, 2000.0, 5000.0, 5000.1, None]
    got = [r[0] for r in col(spark, vals, "d", "double").select(fx.distance_bin("d")).collect()]
    assert got == [None, "short", "short", "medium", "medium", "long", "ultra", None, None]


def test_delay_flag_null_and_nan(spark):
    vals = [15.0, 15.01, -3.0, None, float("nan")]
    got = [r[0] for r in col(spark, vals, "x", "double").select(fx.delay_flag("x")).collect()]
    assert got == [0, 1, 0, 0, 0]


def test_duration_ratio(spark):
    df = spark.createDataFrame([(90.0, 60.0), (90.0, 0.0), (None, 60.0), (90.0, None)], "e double, s double")
    got = [r[0] for r in df.select(fx.duration_ratio("e", "s")).collect()]
    assert got == [1.5, 1.0, None, 1.0]


def test_hour_floor(spark):
    got = [r[0] for r in col(spark, [5, 59, 100, 1259, 2359], "h", "int").select(fx.hour_of_hhmm("h")).collect()]
    assert got == [0, 0, 1, 12, 23]


def test_weekend_and_quarter(spark):
    df = spark.createDataFrame([(d, m) for d, m in zip(range(1, 8), [1, 3, 4, 6, 7, 10, 12])], "d int, m int")
    got = df.select(fx.is_weekend("d"), fx.quarter_of_month("m")).collect()
    assert [r[0] for r in got] == [0, 0, 0, 0, 0, 1, 1]
    assert [r[1] for r in got] == [1, 1, 2, 2, 3, 4, 4]


def test_iso_weekday_from_date(spark):
    df = spark.createDataFrame([("2015-07-04",), ("2015-07-05",), ("2015-07-06",)], "s string")
    got = [r[0] for r in df.select(fx.iso_day_of_week(F.to_date("s"))).collect()]
    assert got == [6, 7, 1]


def test_route_null_side(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None)], "o string, d string")
    assert [r[0] for r in df.select(fx.route_key("o", "d")).collect()] == ["A_B", None]


def test_json_decode_bad_and_null(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("not json",), (None,)], "s string")
    got = [r[0] for r in df.select(fx.decode_json_map("s")).collect()]
    assert got[0] == {"k": "1"} and got[1] == {} and got[2] == {}


def test_date_from_parts_lenient(spark):
    df = spark.createDataFrame([(2015, 2, 28), (2015, 2, 30)], "y int, m int, d int")
    got = [r[0] for r in df.select(fx.date_from_parts("y", "m", "d")).collect()]
    assert str(got[0]) == "2015-02-28" and got[1] is None


def test_extreme_flags_null_is_zero(spark):
    df = spark.createDataFrame([(-11.0,), (None,), (0.0,)], "t double")
    assert [r[0] for r in df.select(fx.below("t", -10.0)).collect()] == [1, 0, 0]
    assert not math.isnan(1.0)
