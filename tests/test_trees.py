"""Forests and boosted trees learnt on packed rows (finding F1 of round 4)."""

import tempfile

import pytest
from pyspark.ml.regression import GBTRegressor, GBTRegressionModel, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from contrail.operators import ml, trees

SPEC = ml.FeatureSpec(["x", "z"], ["c"], "y")


@pytest.fixture(scope="module")
def rows(spark):
    r = spark.range(3000).selectExpr("id", "cast(id * 7919 % 23 as double) as x", "cast(id * 104729 % 17 as double) as z", "concat('c', id * 31 % 5) as c")
    return r.withColumn("y", F.col("x") * 3 + F.when(F.col("c") == "c2", 20.0).otherwise(F.col("z")) + F.expr("id * 13 % 7")).drop("id").cache()


def learn(rows, models, **more):
    report, fitted, best = ml.train_and_evaluate(rows, rows, SPEC, models)
    return {r["model"]: r for r in report}, fitted


def no_native_fit(monkeypatch, *kinds):
    for kind in kinds:
        monkeypatch.setattr(kind, "_fit", lambda *a: pytest.fail("Spark's learner keeps the rows unpacked"))


def test_boosted_trees_are_those_of_spark(spark, rows, monkeypatch):
    est = GBTRegressor(labelCol="y", maxIter=4, maxDepth=3, stepSize=0.3, seed=1)
    data = ml.Pipeline(stages=ml.preprocessing_stages(SPEC)).fit(rows).transform(rows)
    want = est.fit(data)
    no_native_fit(monkeypatch, GBTRegressor)
    report, fitted = learn(rows, {"g": est})
    got = fitted["g"].stages[-1]
    assert isinstance(got, GBTRegressionModel) and got.treeWeights == want.treeWeights
    both = fitted["g"].transform(rows.withColumn("i", F.monotonically_increasing_id())).select("i", F.col("prediction").alias("p")).join(
        want.transform(data.withColumn("i", F.monotonically_increasing_id())).select("i", "prediction"), "i")
    assert both.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-6
    assert list(got.featureImportances.toArray()) == pytest.approx(list(want.featureImportances.toArray()), abs=1e-6)
    assert report["g"]["train_r2"] == pytest.approx(report["g"]["test_r2"], abs=1e-9)   # learner's and model's own predictions


def test_tasks_that_exchange_learn_what_one_task_learns(spark, rows, monkeypatch):
    models = {"g": GBTRegressor(labelCol="y", maxIter=2, maxDepth=2, seed=1), "f": RandomForestRegressor(labelCol="y", numTrees=3, maxDepth=2, seed=1)}
    alone, one = learn(rows, models)
    monkeypatch.setattr(trees, "ALONE", 0)
    shared, many = learn(rows, models)
    splits = lambda m: [x for x in m.stages[-1].toDebugString.split("\n") if "(feature" in x or "Tree" in x][1:]
    assert splits(many["g"]) == splits(one["g"])
    assert {k: v for k, v in shared["g"].items() if k not in ("is_best", "model")} == pytest.approx({k: v for k, v in alone["g"].items() if k not in ("is_best", "model")})
    assert shared["f"]["train_r2"] == pytest.approx(shared["f"]["test_r2"], abs=1e-9)


def test_forest_scores_as_it_learnt_and_is_saved(spark, rows, monkeypatch):
    est = RandomForestRegressor(labelCol="y", numTrees=12, maxDepth=6, featureSubsetStrategy="sqrt", minInstancesPerNode=4, seed=3)
    data = ml.Pipeline(stages=ml.preprocessing_stages(SPEC)).fit(rows).transform(rows)
    native = ml.evaluate(ml.PipelineModel(stages=[est.fit(data)]), data.select("features", "y"), "y")["r2_score"]
    no_native_fit(monkeypatch, RandomForestRegressor)
    monkeypatch.setattr(trees, "CHUNK", 1000)
    monkeypatch.setattr(trees, "HELD", 20_000)      # most rows lie in the scratch file
    report, fitted = learn(rows, {"f": est})
    forest = fitted["f"].stages[-1]
    assert isinstance(forest, RandomForestRegressionModel) and forest.getNumTrees == 12 and max(t.depth for t in forest.trees) == 6
    assert report["f"]["train_r2"] == pytest.approx(report["f"]["test_r2"], abs=1e-9) and report["f"]["train_r2"] > native - 0.05
    assert report["f"]["train_rows"] == 3000
    again = ml.load_model(ml.save_model(fitted["f"], tempfile.mkdtemp(prefix="contrail-forest-")))
    assert ml.evaluate(again, rows, "y")["r2_score"] == pytest.approx(report["f"]["test_r2"], abs=1e-12)


def test_what_the_packed_learner_lacks_is_left_to_spark():
    assert trees.can_learn(GBTRegressor()) and trees.can_learn(RandomForestRegressor())
    assert not trees.can_learn(GBTRegressor(lossType="absolute")) and not trees.can_learn(RandomForestRegressor(minInfoGain=0.1))
    assert not trees.can_learn(RandomForestRegressor(weightCol="w")) and not trees.can_learn(RandomForestRegressor(bootstrap=False))
    assert [trees.features_per_node(s, 63, 50) for s in ("all", "auto", "sqrt", "0.8", "5")] == [63, 21, 8, 51, 5]


def test_cuts_lie_between_values_or_at_equal_counts():
    assert list(trees.cuts([1, 1, 2, 4], 32)) == [1.5, 3.0]
    many = trees.cuts(range(1000), 32)
    assert len(many) == 31 and abs(many[0] - 1000 / 32) < 2 and list(trees.cuts([float("nan"), None, 5.0], 32)) == []


def test_least_squares_and_ridge_predict_as_sparks(spark, rows, monkeypatch):
    models = {"l": LinearRegression(labelCol="y", regParam=0.0, solver="auto"), "r": ml.ridge("y", 3000, 20.0, alpha=500.0)}
    data = ml.Pipeline(stages=ml.preprocessing_stages(SPEC)).fit(rows).transform(rows)
    want = ml.evaluate_all({k: ml.PipelineModel(stages=[m.fit(data)]) for k, m in models.items()}, data.select("features", "y"), "y")
    no_native_fit(monkeypatch, LinearRegression)
    report, fitted = learn(rows, models | {"g": GBTRegressor(labelCol="y", maxIter=1, maxDepth=2)})
    for k in models:
        assert report[k]["test_mse"] == pytest.approx(want[k]["mse"], rel=1e-6) and report[k]["test_mae"] == pytest.approx(want[k]["mae"], rel=1e-6)
        assert report[k]["train_r2"] == pytest.approx(report[k]["test_r2"], abs=1e-9)
    assert report["r"]["test_mse"] > report["l"]["test_mse"]
    again = ml.load_model(ml.save_model(fitted["r"], tempfile.mkdtemp(prefix="contrail-ridge-")))
    assert ml.evaluate(again, rows, "y")["mse"] == pytest.approx(report["r"]["test_mse"])
