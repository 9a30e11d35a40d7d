"""Queries: learning operators on the fact.

Regression target = net amount (extended price after discount and tax);
the raw driver columns are uncorrelated, so a delay-like target would fail
every acceptance gate.  Training reports are small DataFrames.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators import feedback, importance, imputing, ml
from contrail.plans.catalog import query
from contrail.plans.monitoring import FEEDBACK_SQL, feedback_store
from contrail.plans.shipments import SHIPMENTS_SQL, shipments, with_ctes
from contrail.session import ensure_checkpoint_dir, stored

SPLIT_KEYS = ["order_key", "line_number"]
SPEC = ml.FeatureSpec(numeric=["distance", "discount", "tax", "sched_time", "elapsed_time"],
                      categorical=["priority", "return_flag", "origin", "dest"], label="net_amount")

BUCKET_SQL = "CAST(('0x' || substr(md5(CAST(order_key AS VARCHAR) || '_' || CAST(line_number AS VARCHAR) || '_' || '42'), 1, 8)) AS BIGINT) % 10000"


def split(t):
    return ml.hash_split(shipments(t), SPLIT_KEYS)


def stored_split(t):
    """Train / test with the columns the pipelines use, stored in the shared
    folder: every pipeline stage is a pass over the training rows, and
    without this each pass would recompute the fact join."""
    def build(tt):
        cols = SPLIT_KEYS + SPEC.numeric + SPEC.categorical + [SPEC.label]
        return stored(shipments(tt).select(*cols, ml.hash_bucket(SPLIT_KEYS).alias("_b")))
    base = t.derived("train_test_base", build)
    cut = int(round(ml.TRAIN_FRACTION * 10000))
    return base.where(F.col("_b") < cut).drop("_b"), base.where(F.col("_b") >= cut).drop("_b")


def prepared_split(t):
    """The stored split, cached."""
    tr, te = stored_split(t)
    return tr.cache(), te.cache()


@query("train_test_split_counts", with_ctes(f"""
SELECT CASE WHEN {BUCKET_SQL} < 8000 THEN 'train' ELSE 'test' END AS split, count(*) AS n
FROM shipments GROUP BY 1""", shipments=SHIPMENTS_SQL))
def train_test_split_counts(t):
    """H1: repeatable 80/20 hash split (seed 42) of the fact."""
    tr, te = split(t)
    return (tr.select(F.lit("train").alias("split")).unionByName(te.select(F.lit("test").alias("split")))
            .groupBy("split").agg(F.count(F.lit(1)).alias("n")))


@query("standard_scaled", with_ctes("""
SELECT order_key, line_number,
       ROUND(CASE WHEN stddev_pop(distance) OVER () > 0 THEN (distance - avg(distance) OVER ()) / stddev_pop(distance) OVER () ELSE 0.0 END, 6) AS distance_z,
       ROUND(CASE WHEN stddev_pop(discount) OVER () > 0 THEN (discount - avg(discount) OVER ()) / stddev_pop(discount) OVER () ELSE 0.0 END, 6) AS discount_z
FROM shipments""", shipments=SHIPMENTS_SQL))
def standard_scaled(t):
    """H3: population-std scaling of distance and discount (constant -> 0)."""
    return ml.standardize(shipments(t), ["distance", "discount"]).select(*SPLIT_KEYS, "distance_z", "discount_z")


@query("category_modes", with_ctes("""
SELECT col_name, value AS mode_value, n AS mode_count FROM (
  SELECT col_name, value, n, row_number() OVER (PARTITION BY col_name ORDER BY n DESC, value ASC) AS rn FROM (
    SELECT col_name, value, count(*) AS n FROM (
      SELECT 'priority' AS col_name, CAST(priority AS VARCHAR) AS value FROM shipments
      UNION ALL SELECT 'return_flag', CAST(return_flag AS VARCHAR) FROM shipments
      UNION ALL SELECT 'carrier', CAST(carrier AS VARCHAR) FROM shipments) WHERE value IS NOT NULL
    GROUP BY col_name, value)) WHERE rn = 1""", shipments=SHIPMENTS_SQL))
def category_modes(t):
    """H4: most frequent value per categorical column, ties -> smallest."""
    return imputing.category_modes(shipments(t), ["priority", "return_flag", "carrier"])


def with_gaps(df):
    """The fact with its priority missing on every seventh order and its return flag on every fifth."""
    return df.withColumns({"priority": F.when(F.col("order_key") % 7 != 0, F.col("priority")),
                           "return_flag": F.when(F.col("order_key") % 5 != 0, F.col("return_flag"))})


@query("mode_filled", with_ctes(f"""
SELECT order_key, line_number, COALESCE(priority, (SELECT mode FROM modes WHERE col = 'priority')) AS priority_filled,
       COALESCE(return_flag, (SELECT mode FROM modes WHERE col = 'return_flag')) AS return_flag_filled
FROM gaps WHERE {BUCKET_SQL} >= 8000""", shipments=SHIPMENTS_SQL,
    gaps="SELECT order_key, line_number, CASE WHEN order_key % 7 <> 0 THEN priority END AS priority, CASE WHEN order_key % 5 <> 0 THEN return_flag END AS return_flag FROM shipments",
    modes=f"""SELECT col, v AS mode FROM (SELECT col, v, row_number() OVER (PARTITION BY col ORDER BY count(*) DESC, v) AS rn FROM (
      SELECT 'priority' AS col, priority AS v FROM gaps WHERE {BUCKET_SQL} < 8000 UNION ALL SELECT 'return_flag', return_flag FROM gaps WHERE {BUCKET_SQL} < 8000)
      WHERE v IS NOT NULL GROUP BY col, v) WHERE rn = 1"""))
def mode_filled(t):
    """H4 / H6: modes learnt on train by the pipeline stage, saved, loaded, filled in on test."""
    tr, te = ml.hash_split(with_gaps(shipments(t)), SPLIT_KEYS)
    stage = imputing.ModeImputer(inputCols=["priority", "return_flag"], outputCols=["priority_filled", "return_flag_filled"])
    path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/models/modes-{uuid.uuid4().hex}"
    loaded = ml.load_model(ml.save_model(Pipeline(stages=[stage]).fit(tr), path))
    return loaded.transform(te).select(*SPLIT_KEYS, "priority_filled", "return_flag_filled")


@query("category_index", with_ctes(f"""
SELECT t.order_key, t.line_number, t.priority,
       CAST(COALESCE(i.idx, (SELECT count(*) FROM labels_)) AS DOUBLE) AS priority_idx
FROM (SELECT * FROM shipments WHERE {BUCKET_SQL} >= 8000) t
LEFT JOIN (SELECT priority, dense_rank() OVER (ORDER BY priority) - 1 AS idx FROM labels_) i ON t.priority = i.priority""",
    shipments=SHIPMENTS_SQL,
    labels_=f"SELECT DISTINCT priority FROM shipments WHERE {BUCKET_SQL} < 8000 AND priority IS NOT NULL"))
def category_index(t):
    """H5: alphabetical index fitted on train, applied to test (unknown -> n)."""
    tr, te = split(t)
    model = StringIndexer(inputCol="priority", outputCol="priority_idx", stringOrderType="alphabetAsc",
                          handleInvalid="keep").fit(tr)
    return model.transform(te).select(*SPLIT_KEYS, "priority", "priority_idx")


def _single_feature_fit(t, reg):
    tr, _ = prepared_split(t)
    data = VectorAssembler(inputCols=["distance"], outputCol="features").transform(tr)
    m = reg.fit(data)
    r2 = m.summary.r2
    return t.spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept), float(r2))],
                                   "slope double, intercept double, r2 double")


@query("ols_fit", with_ctes(f"""
SELECT ROUND(regr_slope(net_amount, distance), 6) AS slope, ROUND(regr_intercept(net_amount, distance), 6) AS intercept,
       ROUND(regr_r2(net_amount, distance), 6) AS r2
FROM shipments WHERE {BUCKET_SQL} < 8000""", shipments=SHIPMENTS_SQL))
def ols_fit(t):
    """Ordinary least squares of net amount on distance (train split)."""
    return _single_feature_fit(t, LinearRegression(labelCol="net_amount", regParam=0.0, solver="auto"))


@query("ridge_fit", with_ctes(f"""
SELECT ROUND(b, 6) AS slope, ROUND(my - b * mx, 6) AS intercept,
       ROUND(1 - sse / sst, 6) AS r2 FROM (
  SELECT b, mx, my, sum(power(net_amount - (my - b * mx) - b * distance, 2)) AS sse,
         sum(power(net_amount - my, 2)) AS sst
  FROM tr, (SELECT covar_pop(distance, net_amount) * count(*) / (var_pop(distance) * count(*) + 1.0) AS b,
                   avg(distance) AS mx, avg(net_amount) AS my FROM tr) c
  GROUP BY b, mx, my)""", shipments=SHIPMENTS_SQL, tr=f"SELECT * FROM shipments WHERE {BUCKET_SQL} < 8000"))
def ridge_fit(t):
    """Ridge (alpha = 1, intercept not penalised) of net amount on distance."""
    tr, _ = prepared_split(t)
    s = tr.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("net_amount").alias("sd")).first()
    return _single_feature_fit(t, ml.ridge("net_amount", s["n"], s["sd"]))


LEADERBOARD_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("train_r2", T.DoubleType()),
    T.StructField("test_r2", T.DoubleType()), T.StructField("test_mae", T.DoubleType()),
    T.StructField("test_rmse", T.DoubleType()), T.StructField("test_mse", T.DoubleType()),
    T.StructField("train_rows", T.LongType()), T.StructField("test_rows", T.LongType()),
    T.StructField("is_best", T.BooleanType()), T.StructField("accepted", T.BooleanType()),
    T.StructField("gap", T.DoubleType())])


@query("model_leaderboard")
def model_leaderboard(t):
    """The five regressors, train / test metrics, best and gates."""
    tr, te = stored_split(t)
    rows, _, _ = ml.train_and_evaluate(tr, te, SPEC, keep=lambda df: df)
    return t.spark.createDataFrame([tuple(r[f.name] for f in LEADERBOARD_SCHEMA.fields) for r in rows],
                                   LEADERBOARD_SCHEMA)


@query("champion_challenger")
def champion_challenger(t):
    """Challenger (numeric + categorical linear model) against the
    champion (numeric-only linear model) on the same raw test rows."""
    tr, te = prepared_split(t)
    lr = ml.LinearRegression(labelCol=SPEC.label, regParam=0.0, solver="auto")
    numeric = Pipeline(stages=ml.numeric_stages(SPEC)).fit(tr)   # the same in both models
    champ = ml.fit_pipeline(tr, ml.FeatureSpec(SPEC.numeric, [], SPEC.label), lr, numeric)
    chall = ml.fit_pipeline(tr, SPEC, ml.LinearRegression(labelCol=SPEC.label, regParam=0.0, solver="auto"), numeric)
    r2 = {k: m["r2_score"] for k, m in ml.evaluate_all({"challenger": chall, "champion": champ}, te, SPEC.label).items()}
    first = ml.decide(r2["challenger"], None, False)
    vs = ml.decide(r2["challenger"], r2["champion"], True)
    schema = "round string, challenger_r2 double, champion_r2 double, improvement double, accepted boolean"
    return t.spark.createDataFrame(
        [("first_model", first["challenger_r2"], first["champion_r2"], first["improvement"], first["accepted"]),
         ("against_champion", vs["challenger_r2"], vs["champion_r2"], vs["improvement"], vs["accepted"])], schema)


@query("feature_importance")
def feature_importance(t):
    """Drop of the test R2 per input column when it is dealt out anew among the test rows."""
    tr, te = prepared_split(t)
    model = ml.fit_pipeline(tr, SPEC, ml.LinearRegression(labelCol=SPEC.label, regParam=0.0, solver="auto"))
    keyed = te.withColumn("row_key", F.monotonically_increasing_id())   # order_key, line_number repeat; the rows are stored
    return importance.permutation_importance(model, keyed, "row_key", SPEC)


@query("batch_scoring")
def batch_scoring(t):
    """H16 + H17: fit, save the whole pipeline to the shared checkpoint
    folder, load it back and score the test rows."""
    tr, te = prepared_split(t)
    model = ml.fit_pipeline(tr, SPEC, ml.LinearRegression(labelCol=SPEC.label, regParam=0.0, solver="auto"))
    path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/models/batch_scoring-{uuid.uuid4().hex}"
    loaded = ml.load_model(ml.save_model(model, path))
    return ml.score(loaded, te, keep=SPLIT_KEYS + [SPEC.label])


@query("merged_training_rows", with_ctes(f"""
SELECT 'train' AS source, count(*) AS n FROM shipments WHERE {BUCKET_SQL} < 8000
UNION ALL SELECT 'feedback', count(*) FROM fb WHERE actual_delay IS NOT NULL""",
    shipments=SHIPMENTS_SQL, fb=FEEDBACK_SQL.strip() + " SELECT * FROM fb"))
def merged_training_rows(t):
    """Labelled feedback (feature map expanded) appended to the train rows."""
    tr, _ = split(t)
    lab = feedback.expand_features(feedback.labeled_view(feedback_store(t)), ["k"]) \
        .select(F.col("actual_delay").alias(SPEC.label), "k")
    merged = ml.merge_feedback(tr.select(*SPEC.numeric, SPEC.label).withColumn("source", F.lit("train")),
                               lab.withColumn("source", F.lit("feedback")))
    return merged.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
