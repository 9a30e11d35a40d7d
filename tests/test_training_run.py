"""End-to-end run on the smoke tables (linear models only, to stay fast)."""

import datetime as dt
import os
import tempfile

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from contrail.operators import ml
from contrail.plans.learning import SPEC
from contrail.plans.training import run_training, score_with_feature_tables
from contrail.plans.shipments import shipments
from contrail.sources.tables import Tables

from paths import SMOKE


def test_run_training_end_to_end(spark):
    out = tempfile.mkdtemp(prefix="contrail-run-")
    zoo = {"linear_regression": LinearRegression(labelCol=SPEC.label, solver="normal")}
    res = run_training(spark, SMOKE, out, models=zoo)
    assert res.best_model == "linear_regression" and res.accepted and res.promoted
    assert os.path.isdir(res.model_path)
    base = {r["col_name"]: r for r in spark.read.parquet(f"{out}/baseline").collect()}
    assert set(base) == set(SPEC.numeric) and base["distance"]["baseline_r2"] > 0.6
    assert spark.read.json(f"{out}/reports/training").count() == 1
    assert base["distance"]["counts"] and base["distance"]["n"] > 0
    fact = shipments(Tables(spark, SMOKE))
    assert spark.read.parquet(f"{out}/features").count() == fact.count()
    # Every stage left its report
    names = {r["check_name"] for r in spark.read.json(f"{out}/reports/validation").collect()}
    assert {"required_columns:shipments", "required_columns:daily_feed", "overall"} <= names
    assert {r["col_name"] for r in spark.read.json(f"{out}/reports/drift").collect()} == {"distance", "discount", "tax", "delay", "sched_time", "priority"}
    assert spark.read.json(f"{out}/reports/drift_summary").first()["total_columns_checked"] == 6
    counts = {r["rows"]: r["n"] for r in spark.read.json(f"{out}/reports/quarantine").collect()}
    assert counts == {"validated": fact.count(), "invalidated": 0, "target": 0, "date": 0}
    # second run: the first model is now the champion; an equal model is not promoted
    res2 = run_training(spark, SMOKE, out + "/second", champion_path=res.model_path, models=zoo)
    assert res2.accepted and not res2.promoted
    # Scoring the same rows finds the same point-in-time inputs; a later day sees them all
    raw = shipments(Tables(spark, SMOKE)).where("order_key % 97 = 0")
    scored = {(r.order_key, r.line_number, r.distance): r for r in score_with_feature_tables(spark, SMOKE, res.model_path, raw, f"{out}/feature_stats").collect()}
    feats = {(r.order_key, r.line_number, r.distance): r for r in spark.read.parquet(f"{out}/features").where("order_key % 97 = 0").collect()}
    assert len(scored) == len(feats) > 10
    for k, r in scored.items():
        assert (r.origin_prior_n, r.origin_prior_avg, r.route_prior_n) == (feats[k].origin_prior_n, feats[k].origin_prior_avg, feats[k].route_prior_n)
    later = raw.withColumn("ship_date", F.lit(dt.date(2035, 1, 1)))
    one = score_with_feature_tables(spark, SMOKE, res.model_path, later, f"{out}/feature_stats").where("origin IS NOT NULL").first()
    assert one.origin_prior_n == fact.where((F.col("origin") == one.origin) & F.col("delay").isNotNull()).count()
    stages = ml.load_model(res.model_path).stages
    assert "origin_prior_avg" in stages[0].getInputCols() and "p_1_urgent" in stages[0].getInputCols()


def test_run_training_refuses_a_broken_contract(spark, monkeypatch):
    import pytest

    from contrail.operators.contracts import Contract, ContractError
    from contrail.plans import training
    monkeypatch.setattr(training, "CONTRACTS", (Contract("shipments", ("delay", "nowhere"), ("priority",)), Contract("missing", ("a",))))
    with pytest.raises(ContractError, match="nowhere.*priority must be numeric.*missing: no such table"):
        run_training(spark, SMOKE, tempfile.mkdtemp(prefix="contrail-run-"))


def test_run_training_fails_on_rejection(spark):
    import pytest
    from pyspark.ml.regression import LinearRegression as LR

    from contrail.plans.training import ModelRejected
    out = tempfile.mkdtemp(prefix="contrail-run-")
    weak = {"intercept_only": LR(labelCol=SPEC.label, solver="normal", regParam=1e9, elasticNetParam=0.0)}
    with pytest.raises(ModelRejected):
        run_training(spark, SMOKE, out, models=weak, fail_on_rejection=True)
