"""Models of one zoo are fitted at the same time (finding F1 of round 3)."""

import threading

from pyspark.ml.regression import LinearRegression

from contrail.operators import ml


class Meeting(LinearRegression):
    """Goes on only when another fit has begun as well."""

    def fit(self, dataset, params=None):
        self.barrier.wait(60)
        return super().fit(dataset, params)


def test_models_are_fitted_side_by_side(spark):
    rows = spark.range(200).selectExpr("cast(id as double) as x", "cast(2 * id as double) as y", "id % 4 as k")
    barrier = threading.Barrier(2)
    models = {n: Meeting(labelCol="y", solver="normal") for n in ("a", "b")}
    for m in models.values():
        m.barrier = barrier
    report, fitted, best = ml.train_and_evaluate(rows.where("k > 0"), rows.where("k = 0"), ml.FeatureSpec(["x"], [], "y"), models)
    assert [r["model"] for r in report] == ["a", "b"] == list(fitted) and best in fitted
    assert all(r["train_rows"] == 150 and r["test_rows"] == 50 and r["test_r2"] > 0.99 for r in report)
