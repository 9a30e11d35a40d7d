"""Row counts kept by joins, quarantine counts, clustered and bucketed tables, contracts at once."""

import glob

import pytest
from pyspark.sql import functions as F

from contrail.operators import contracts, joins
from contrail.sources import tables


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame([(i, i % 4 if i % 9 else None) for i in range(100)], "id int, k int").repartition(3)


def test_repeated_key_is_refused_and_reported(spark, fact):
    good = spark.createDataFrame([(0, "a"), (1, "b"), (None, "n"), (None, "m")], "k int, name string")
    bad = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (2, "d"), (2, "e")], "k int, name string")
    joins.require_unique_keys({"good": (good, "k")})
    with pytest.raises(joins.RepeatedKeys, match="bad: 2 repeated keys, one is 1"):
        joins.require_unique_keys({"good": (good, "k"), "bad": (bad, "k")})
    assert {(r["dim"], r["key"], r["n"]) for r in joins.repeated_keys({"bad": (bad, "k")}).collect()} == {("bad", "1", 2), ("bad", "2", 2)}


def test_row_invariant_needs_no_second_pass(spark, fact, tmp_path):
    good = spark.createDataFrame([(i, str(i)) for i in range(3)], "dk int, name string")
    same = joins.RowInvariant()
    out = same.after(joins.enrich(same.before(fact), good, "k", "dk"))
    out.write.parquet(str(tmp_path / "good"))
    assert same.check() == 100 and same.counts() == (100, 100)
    twice = joins.RowInvariant()
    out = twice.after(joins.enrich(twice.before(fact), good.unionByName(good.limit(1)), "k", "dk"))
    out.write.parquet(str(tmp_path / "bad"))
    with pytest.raises(joins.RepeatedKeys, match="100 rows went in"):
        twice.check()


def test_quarantine_counts_match_the_table(spark, fact, tmp_path):
    path = str(tmp_path / "q")
    got = tables.quarantine_rows(fact, {"has_k": F.col("k").isNotNull(), "small": F.col("id") < 90, "odd": F.col("k") != 2}, path)
    rows = spark.read.parquet(path)
    assert rows.count() == 100 and got["validated"] + got["invalidated"] == 100
    assert got["validated"] == rows.where("quality = 'validated'").count()
    assert got["has_k"] == 12 and got["small"] == 10
    assert rows.where("id = 90").first()["broken"] == "has_k,small,odd"   # a null rule result is broken
    empty = tables.quarantine_rows(fact.limit(0), {"has_k": F.col("k").isNotNull()}, str(tmp_path / "e"))
    assert empty == {"validated": 0, "invalidated": 0, "has_k": 0}


def test_clustered_write_makes_few_files(spark, tmp_path):
    df = spark.range(4000).selectExpr("id", "id % 12 AS month", "2020 + id % 2 AS year").repartition(8)
    tables.write_clustered(df, str(tmp_path / "c"), ["year", "month"], ["id"])
    files = glob.glob(str(tmp_path / "c") + "/year=*/month=*/*.parquet")
    folders = {f.rsplit("/", 1)[0] for f in files}
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(folders) == 12 and len(files) <= len(folders) + n
    assert spark.read.parquet(str(tmp_path / "c")).count() == 4000


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucketed LOCATION '{tmp_path}/wh'")
    a = tables.write_bucketed(spark.range(2000).selectExpr("id AS k", "id * 2 AS x"), "bucketed.a", "k", 4)
    b = tables.write_bucketed(spark.range(1000).selectExpr("id AS k", "id * 3 AS y"), "bucketed.b", "k", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b, "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE bucketed CASCADE")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_all_contracts_fail_at_once(spark):
    have = spark.createDataFrame([("x", "y")], "IATA_CODE string, LATITUDE string")
    with pytest.raises(contracts.ContractError) as e:
        contracts.check_all({"airports": have, "airlines": have}, (contracts.AIRPORTS, contracts.AIRLINES, contracts.HOLIDAYS))
    text = str(e.value)
    assert "airports: missing required columns: ['AIRPORT', 'CITY', 'STATE', 'COUNTRY', 'LONGITUDE']" in text
    assert "airports: LATITUDE must be numeric" in text and "airlines: missing" in text and "holidays: no such table" in text
    assert contracts.check_all({"airlines": spark.createDataFrame([("a", "b")], "IATA_CODE string, AIRLINE string")}, (contracts.AIRLINES,))
