"""Exact small-sample p-values, permutation importance and tree importances per input column."""

import itertools

import pytest
from pyspark.ml.regression import LinearRegression, RandomForestRegressor

from contrail.operators import drift, importance, ml

from test_order_stats_drift import frame, ks_brute


@pytest.mark.parametrize("n1,n2", [(1, 1), (3, 4), (5, 5), (2, 6)])
def test_exact_p_counts_all_arrangements(n1, n2):
    stats = []
    for first in itertools.combinations(range(n1 + n2), n1):
        rest = [i for i in range(n1 + n2) if i not in first]
        stats.append(ks_brute(list(first), rest))
    for d in sorted(set(round(x, 12) for x in stats)):
        assert drift.exact_ks_p(d, n1, n2) == pytest.approx(sum(x >= d - 1e-9 for x in stats) / len(stats))
    assert drift.exact_ks_p(0.0, n1, n2) == 1.0


def test_twelve_day_feed_and_the_change_to_the_series(spark):
    # six against six values: D = 5/6 has the tabled probability 0.0260 (D = 4/6: 0.1429)
    r = {x.col_name: x for x in drift.ks_drift(frame(spark, a=[1, 2, 3, 4, 5, 6], b=[1, 2, 3, 4, 10, 11]), frame(spark, a=[6.5, 7, 8, 9, 10, 5.5], b=[5, 6, 7, 8, 9, 12]), ["a", "b"]).collect()}
    assert round(r["a"].ks_statistic, 4) == 0.8333 and round(r["a"].p_value, 4) == 0.0260 and r["a"].drift_detected
    assert round(r["b"].ks_statistic, 4) == 0.6667 and round(r["b"].p_value, 4) == 0.1429 and not r["b"].drift_detected
    assert drift.exact_ks_p(0.1, 300, 300) == pytest.approx(0.0996, abs=0.002)   # near the asymptotic 0.0995


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, float(i % 17), float((i * 7) % 5), 3.0, "ab"[i % 2], "only", 5.0 * (i % 17) + 2.0 * ((i * 7) % 5) + 9.0 * (i % 2)) for i in range(600)]
    return spark.createDataFrame(data, "id long, x double, z double, const double, c string, same string, y double").repartition(4)


SPEC = ml.FeatureSpec(["x", "z", "const"], ["c", "same"], "y")


def test_partners_are_a_permutation(rows):
    got = importance.with_partner(rows, "id", ["id"], 7).select("id", "_other.id").collect()
    assert sorted(r[0] for r in got) == sorted(r[1] for r in got) == list(range(600))
    assert sum(r[0] != r[1] for r in got) > 550


def test_permutation_importance_per_column(rows):
    model = ml.fit_pipeline(rows, SPEC, LinearRegression(labelCol="y", solver="normal"))
    got = {r["column"]: r["importance"] for r in importance.permutation_importance(model, rows, "id", SPEC).collect()}
    assert list(got) == ["x", "z", "const", "c", "same"]
    assert got["const"] == 0.0 and got["same"] == 0.0
    assert got["x"] > got["c"] > got["z"] > 0.005
    again = {r["column"]: r["importance"] for r in importance.permutation_importance(model, rows.repartition(3), "id", SPEC).collect()}
    assert again == pytest.approx(got)


def test_tree_importances_belong_to_input_columns(rows):
    model = ml.fit_pipeline(rows, SPEC, RandomForestRegressor(labelCol="y", numTrees=5, maxDepth=5, seed=1))
    got = importance.vector_importances(model, rows, SPEC)
    assert set(got) == {"x", "z", "const", "c", "same"} and sum(got.values()) == pytest.approx(1.0)
    assert got["x"] > 0.5 and got["const"] == 0.0 and got["same"] == 0.0 and got["c"] > 0
