"""Scans and sinks (A1, A3, A4, A9), contract helpers (B8, B11), C4 calendar mode."""

import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators import contracts, quality
from contrail.sources import tables


def test_typed_csv_maps_nan_and_blank_to_null(spark):
    d = tempfile.mkdtemp(prefix="contrail-csv-")
    with open(os.path.join(d, "f.csv"), "w") as fh:
        fh.write("A,D\nx,1.5\ny,NaN\nz,\n")
    schema = T.StructType([T.StructField("A", T.StringType()), T.StructField("D", T.DoubleType())])
    got = {r["A"]: r["D"] for r in tables.read_csv_typed(spark, d, schema).collect()}
    assert got == {"x": 1.5, "y": None, "z": None}


def test_route_rows_keeps_every_row(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-1.0,)], "x double")
    ok, bad = tables.route_rows(df, F.col("x") > 0)
    assert ok.count() == 1 and bad.count() == 2


def test_sinks_round_trip(spark):
    base = tempfile.mkdtemp(prefix="contrail-sink-")
    df = spark.createDataFrame([(2, 2020, 1), (1, 2021, 2)], "id int, year int, month int")
    tables.write_table(df, f"{base}/t", partition_by=["year", "month"])
    assert sorted(r["id"] for r in spark.read.parquet(f"{base}/t").where("year = 2021").collect()) == [1]
    tables.route_dataset(df, False, base, "d")
    assert spark.read.parquet(f"{base}/invalidated/d").count() == 2
    tables.export_ordered(df, f"{base}/csv", "id")
    rows = spark.read.option("header", "true").csv(f"{base}/csv").collect()
    assert [r["id"] for r in rows] == ["1", "2"]
    tables.report_sink(df, f"{base}/report")
    assert spark.read.json(f"{base}/report").count() == 2


def test_head_sample_orders(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    assert [r["k"] for r in tables.head_sample(df, 2, ["k"]).collect()] == [1, 2]


def test_out_of_range_null_is_valid(spark):
    df = spark.createDataFrame([(91.0,), (None,), (-90.0,)], "lat double")
    assert [r[0] for r in df.select(contracts.out_of_range("lat", -90, 90)).collect()] == [True, False, False]


def test_drop_role_duplicates(spark):
    df = spark.createDataFrame([(1, 2, 3)], "IATA_CODE int, ORIGIN_IATA_CODE int, x int")
    assert contracts.drop_role_duplicates(df, "IATA_CODE", "IATA_CODE").columns == ["IATA_CODE", "x"]


def test_calendar_violations(spark):
    df = spark.createDataFrame([(2015, 2, 29), (2016, 2, 29), (2015, 13, 1)], "year int, month int, day int")
    assert quality.calendar_violations(df).count() == 2


def test_project_features_reports_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, y double")
    out, missing = contracts.project_features(df, ["a", "b"], "y")
    assert out.columns == ["a", "y"] and missing == ["b"]
