"""Mode imputation as a pipeline stage: ties, saving, whole pipelines; models scored together."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression

from contrail.operators import ml
from contrail.operators.imputing import ModeImputer, ModeImputerModel

SCHEMA = "x double, c string, d int, e string, y double"


@pytest.fixture(scope="module")
def train(spark):
    rows = [(float(i), "ab"[i % 2] if i % 5 else None, (i % 3) or None, None, 2.0 * i + (i % 2)) for i in range(40)]
    return spark.createDataFrame(rows, SCHEMA)


def test_ties_go_to_the_smallest_value_and_survive_saving(spark, train, tmp_path):
    stage = ModeImputer(inputCols=["c", "d", "e"], outputCols=["c2", "d2", "e2"])
    model = stage.fit(train)
    assert model.getOrDefault(model.modes)[:2] == ["a", "1"] and model.getOrDefault(model.known) == [1, 1, 0]
    Pipeline(stages=[stage]).fit(train).write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert isinstance(loaded.stages[0], ModeImputerModel)
    test = spark.createDataFrame([(1.0, None, None, None, 0.0), (2.0, "z", 9, "new", 0.0)], SCHEMA)
    assert [(r.c2, r.d2, r.e2) for r in loaded.transform(test).collect()] == [("a", "1", None), ("z", "9", "new")]


def test_null_category_scores_like_the_mode_in_a_saved_model(spark, train, tmp_path):
    spec = ml.FeatureSpec(["x"], ["c", "d"], "y")
    model = ml.fit_pipeline(train, spec, LinearRegression(labelCol="y", solver="normal"))
    loaded = ml.load_model(ml.save_model(model, str(tmp_path / "whole")))
    test = spark.createDataFrame([(7.0, None, None, None, 0.0), (7.0, "a", 1, None, 0.0), (7.0, "zz", 1, None, 0.0)], SCHEMA)
    got = [r.PREDICTED_DELAY for r in ml.score(loaded, test).collect()]
    assert got[0] == pytest.approx(got[1]) and got[2] != pytest.approx(got[1], abs=1e-9)
    assert got == pytest.approx([r.PREDICTED_DELAY for r in ml.score(model, test).collect()])


def test_models_are_scored_in_one_pass(spark, train):
    a = ml.fit_pipeline(train, ml.FeatureSpec(["x"], [], "y"), LinearRegression(labelCol="y", solver="normal"))
    b = ml.fit_pipeline(train, ml.FeatureSpec(["x"], ["c"], "y"), LinearRegression(labelCol="y", solver="normal"))
    both = ml.evaluate_all({"a": a, "b": b}, train, "y")
    assert both == {"a": ml.evaluate(a, train, "y"), "b": ml.evaluate(b, train, "y")}
    d = ml.champion_challenger(train, "y", b, a)
    assert d["challenger_r2"] == both["b"]["r2_score"] and d["champion_r2"] == both["a"]["r2_score"]
    assert ml.champion_challenger(train, "y", b, None)["accepted"]


def test_ridge_of_the_zoo_is_the_checked_one(spark, train):
    zoo = ml.model_zoo("y", n_rows=40, label_std=3.0)
    one = ml.ridge("y", 40, 3.0)
    names = ("regParam", "solver", "standardization", "elasticNetParam")
    assert [zoo["ridge"].getOrDefault(n) for n in names] == [one.getOrDefault(n) for n in names]
