import numpy as np
import pytest
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.regression import LinearRegression
from pyspark.ml.feature import VectorAssembler

from contrail.operators import feedback, metrics, ml

P = "request_id string, features string, prediction double, model_version string, timestamp long"
L = "request_id string, actual_delay double, user_feedback string, label_timestamp long"


def test_upsert_semantics(spark):
    preds = spark.createDataFrame([("r1", '{"a": 1}', 10.0, "v1", 1), ("r1", '{"a": 2}', 20.0, "v1", 3),
                                   ("r2", "{}", 5.0, "v1", 1)], P)
    labels = spark.createDataFrame([("r1", 12.0, "ok", 2),      # cleared by the re-insert at t=3
                                    ("r2", 7.0, "ok", 2), ("r2", 8.0, "late", 4),  # last write wins
                                    ("r9", 1.0, "?", 5)], L)    # unknown id -> no row
    got = {r["request_id"]: r for r in feedback.feedback_table(preds, labels).collect()}
    assert set(got) == {"r1", "r2"}
    assert got["r1"]["prediction"] == 20.0 and got["r1"]["actual_delay"] is None
    assert got["r2"]["actual_delay"] == 8.0 and got["r2"]["user_feedback"] == "late"
    lab = feedback.labeled_view(feedback.feedback_table(preds, labels)).collect()
    assert [r["request_id"] for r in lab] == ["r2"] and lab[0]["features"] == {}


def test_metrics_perfect_and_constant(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (4.0, 4.0)], "y double, p double")
    r = metrics.regression_metrics(df, "y", "p").first()
    assert r["r2_score"] == 1.0 and r["mae"] == 0.0
    const = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "y double, p double")
    assert metrics.regression_metrics(const, "y", "p").first()["r2_score"] is None


def test_accuracy_check_needs_min_rows(spark):
    df = spark.createDataFrame([(float(i), float(i) + 50) for i in range(99)], "y double, p double")
    r = metrics.accuracy_check(df, "y", "p", baseline_r2=0.8).first()
    assert not r["accuracy_drop"] and not r["retrain_on_mae"]
    df2 = spark.createDataFrame([(float(i), float(i) + 50) for i in range(100)], "y double, p double")
    r2 = metrics.accuracy_check(df2, "y", "p", baseline_r2=0.8).first()
    assert r2["accuracy_drop"] and r2["retrain_on_mae"]


def test_hash_split_is_stable(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    a, _ = ml.hash_split(df, ["k"])
    b, _ = ml.hash_split(df.repartition(7), ["k"])
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())
    assert 1500 < a.count() < 1700


def test_one_hot_unknown_and_null_are_empty(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([("b",), ("zz",), (None,)], "c string")
    idx = StringIndexer(inputCol="c", outputCol="i", stringOrderType="alphabetAsc", handleInvalid="keep").fit(train)
    ohe = OneHotEncoder(inputCols=["i"], outputCols=["v"], dropLast=True).fit(idx.transform(train))
    vecs = [r["v"] for r in ohe.transform(idx.transform(test)).collect()]
    assert vecs[0].toArray().tolist() == [0.0, 1.0]
    assert vecs[1].numNonzeros() == 0 and vecs[2].numNonzeros() == 0


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(10, 3, size=200)
    y = 2.0 * x + rng.normal(size=200) + 4.0
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    m = LinearRegression(labelCol="y", regParam=float(np.std(y)) / 200, elasticNetParam=0.0,
                         standardization=False, solver="normal").fit(data)
    m2 = LinearRegression(labelCol="y", regParam=float(np.std(y, ddof=1)) / 200, elasticNetParam=0.0,
                          standardization=False, solver="l-bfgs", maxIter=1000, tol=1e-14).fit(data)
    xc, yc = x - x.mean(), y - y.mean()
    b = float(xc @ yc / (xc @ xc + 1.0))
    assert m.coefficients[0] == pytest.approx(b, rel=1e-9)
    assert m.intercept == pytest.approx(y.mean() - b * x.mean(), rel=1e-9)
    assert m2.coefficients[0] == pytest.approx(b, rel=1e-9)


def test_standardize_population_std(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,), (5.0,)], "x double")
    z = [r["x_z"] for r in ml.standardize(df, ["x"]).collect()]
    arr = np.array([1.0, 3.0, 5.0, 5.0])
    assert z == pytest.approx(list((arr - arr.mean()) / arr.std()))
    c = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r["x_z"] for r in ml.standardize(c, ["x"]).collect()] == [0.0, 0.0]


def test_modes_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    r = ml.category_modes(df, ["c"]).first()
    assert (r["mode_value"], r["mode_count"]) == ("a", 2)


def test_gates(spark):
    assert ml.accept(0.9, 0.85)["accepted"]
    assert not ml.accept(0.9, 0.55)["accepted"]
    assert not ml.accept(0.99, 0.85)["accepted"]


def test_feedback_store_has_no_join_and_handles_hot_id(spark):
    preds = spark.createDataFrame([("hot", "{}", float(i), "v1", i) for i in range(300)]
                                  + [("cold", "{}", 1.0, "v1", 5)], P)
    labels = spark.createDataFrame([("hot", float(i), "x", i) for i in range(150, 400)], L)
    fb = feedback.feedback_table(preds, labels)
    plan = fb._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    got = {r["request_id"]: (r["prediction"], r["actual_delay"]) for r in fb.collect()}
    assert got == {"hot": (299.0, 399.0), "cold": (1.0, None)}
