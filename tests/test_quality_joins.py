import pytest

from contrail.operators import explore, grouping, joins, quality


def test_one_row_group_std_null(spark):
    df = spark.createDataFrame([("A", 10.0), ("B", 1.0), ("B", 3.0)], "k string, d double")
    got = {r["k"]: r for r in grouping.group_delay_stats(df, ["k"], "d", "o").collect()}
    assert got["A"]["o_std_delay"] is None and got["A"]["o_avg_delay"] == 10.0


def test_dim_miss_kept(spark):
    fact = spark.createDataFrame([(1, "X"), (2, "Q")], "id int, code string")
    dim = spark.createDataFrame([("X", "Xname")], "code string, name string")
    out = joins.enrich(fact, dim, "code", "code", prefix="o_").orderBy("id").collect()
    assert [r["o_name"] for r in out] == ["Xname", None]


def test_median_fill_counts_null_target_rows(spark):
    fact = spark.createDataFrame([(1, "2020-01-01", None), (2, "2020-01-01", 5.0), (3, "2020-01-02", 1.0),
                                  (4, "2020-01-03", 2.0)], "id int, d string, target double")
    daily = spark.createDataFrame([("2020-01-01", 10.0), ("2020-01-02", 30.0)], "day string, t double")
    out = {r["id"]: r["t"] for r in joins.join_daily_and_fill(fact, daily, "d", "day", ["t"]).collect()}
    # joined values 10, 10, 30 (row 1 has a null target but still counts) -> median 10
    assert out[4] == 10.0


def test_clean_drops_target_and_duplicates(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None), (None, "x")], "t double, r string")
    out = joins.clean_joined(df, "t", fill={"r": "None"}).collect()
    assert len(out) == 1 and out[0]["r"] == "None"


def test_null_counts_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    nc = {r["col_name"]: r for r in quality.null_counts(df).collect()}
    assert list(nc) == ["b"] and nc["b"]["missing_pct"] == pytest.approx(66.67)
    d = quality.duplicate_profile(df).first()
    assert (d["total_rows"], d["duplicate_count"]) == (3, 1)


def test_referential_null_code_is_invalid(spark):
    fact = spark.createDataFrame([("A", "B"), (None, "Z")], "o string, d string")
    dim = spark.createDataFrame([("A",), ("B",)], "k string")
    s = {r["fk_column"]: r for r in quality.referential_check(fact, ["o", "d"], dim, "k").collect()}
    assert s["o"]["invalid_count"] == 1 and s["d"]["invalid_count"] == 1
    bad = {(r["fk_column"], r["code"]) for r in quality.invalid_codes(fact, ["o", "d"], dim, "k").collect()}
    assert bad == {("o", None), ("d", "Z")}


def test_quality_score_empty_and_no_baseline(spark):
    empty = spark.createDataFrame([], "x double")
    assert quality.quality_score(empty, empty, []).first()["quality_score"] == 0.0
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    r = quality.quality_score(df, df, []).first()
    assert r["range_validity"] == 1.0 and r["quality_score"] == pytest.approx(0.75)


def test_column_profile_counts_na_as_value(spark):
    df = spark.createDataFrame([(1,), (None,), (1,)], "a int")
    r = quality.column_profile(df).first()
    assert (r["col_class"], r["unique_values"], r["missing_count"]) == ("integer", 2, 1)


def test_leakage_safe_uses_only_earlier_dates(spark):
    df = spark.createDataFrame([("A", "2020-01-01", 10.0), ("A", "2020-01-01", 20.0), ("A", "2020-01-02", 30.0)],
                               "k string, d string, t double")
    got = {r["d"]: r for r in grouping.leakage_safe_stats(df, "k", "d", "t", "p").collect()}
    assert got["2020-01-01"]["p_prior_n"] == 0 and got["2020-01-01"]["p_prior_avg"] is None
    assert got["2020-01-02"]["p_prior_avg"] == 15.0


def test_label_coverage_empty(spark):
    empty = spark.createDataFrame([], "actual_delay double")
    r = explore.label_coverage(empty).first()
    assert (r["total"], r["labeled"], r["coverage_pct"]) == (0, 0, 0.0)


def test_top_k_ties_by_key(spark):
    df = spark.createDataFrame([(s,) for s in ["TX", "CA", "CA", "TX", "AK"]], "s string")
    assert [r["s"] for r in explore.top_k(df, "s", 2).collect()] == ["CA", "TX"]


def test_boxplot_whiskers(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 100]], "x double")
    r = explore.boxplot_stats(df, ["x"]).first()
    assert r["outliers"] == 1 and r["upper_whisker"] == 5.0 and r["lower_whisker"] == 1.0


def test_crosstab_fills_zero(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "r string, c string")
    got = {r["r"]: (r["x"], r["y"]) for r in explore.crosstab_wide(df, "r", "c", ["x", "y"]).collect()}
    assert got == {"a": (1, 0), "b": (0, 1)}
