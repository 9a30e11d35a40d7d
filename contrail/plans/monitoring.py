"""Queries: drift, baseline, feedback store and monitoring checks
(G1-G11, I1-I3, D9, D10, E13, E14, H7, H20).

Roles on the driver's tables:

* reference / current samples = first / second half of ``events`` by
  event position (G4), features value, user_id and ``props.k``;
* prediction log = non-purchase events (request id = user, prediction =
  value, features = props JSON, time = ts); label log = purchase events
  (actual = value).  Re-predictions of a user clear older labels exactly
  like the reference's upsert.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from contrail.functions.features import decode_json_map
from contrail.operators import baseline, drift, explore, feedback, metrics
from contrail.operators.ordered import split_by_position
from contrail.plans.catalog import query
from contrail.plans.profile import DAILY_WIDE_SQL, FEED_COLS, daily_feed_wide
from contrail.session import ensure_checkpoint_dir

FEATURES = ("value", "user_id", "props_k")
CATEGORICAL = ("event_type",)
BASELINE_R2 = 0.85     # metric record used by the reference's tests
BASELINE_MAE = metrics.BASELINE_MAE


def r6(cols):
    return ", ".join(f"ROUND({c}, 6) AS {c}" for c in cols)


def event_features(t):
    return t["events"].withColumn("props_k", decode_json_map("props")["k"].try_cast("double"))


def event_halves(t):
    return split_by_position(event_features(t), "event_id")


HALVES_SQL = """
WITH ranked AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS props_k,
                       row_number() OVER (ORDER BY event_id) - 1 AS pos, count(*) OVER () AS n FROM events),
ref AS (SELECT * EXCLUDE (pos, n) FROM ranked WHERE pos < n // 2),
cur AS (SELECT * EXCLUDE (pos, n) FROM ranked WHERE pos >= n // 2)"""


def ks_sql(cols, ref="ref", cur="cur") -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, CAST({c} AS DOUBLE) AS v, 0 AS side FROM {ref} "
        f"UNION ALL SELECT '{c}', CAST({c} AS DOUBLE), 1 FROM {cur}" for c in cols)
    return f""",
long AS ({long}),
lv AS (SELECT * FROM long WHERE v IS NOT NULL AND NOT isnan(v)),
counts AS (SELECT col_name, v, count(*) FILTER (WHERE side = 0) AS n1, count(*) FILTER (WHERE side = 1) AS n2
           FROM lv GROUP BY col_name, v),
cdf AS (SELECT col_name, sum(n1) OVER w AS c1, sum(n2) OVER w AS c2,
               sum(n1) OVER (PARTITION BY col_name) AS N1, sum(n2) OVER (PARTITION BY col_name) AS N2
        FROM counts WINDOW w AS (PARTITION BY col_name ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
stat AS (SELECT col_name, CAST(any_value(N1) AS DOUBLE) AS N1, CAST(any_value(N2) AS DOUBLE) AS N2,
                max(abs(c1 / N1 - c2 / N2)) AS D FROM cdf GROUP BY col_name),
mom AS (SELECT col_name, avg(v) FILTER (WHERE side = 0) AS reference_mean, avg(v) FILTER (WHERE side = 1) AS current_mean,
               stddev_samp(v) FILTER (WHERE side = 0) AS reference_std,
               stddev_samp(v) FILTER (WHERE side = 1) AS current_std FROM lv GROUP BY col_name),
pv AS (SELECT col_name, D, N1, N2, sqrt(N1 * N2 / (N1 + N2)) * D AS lam FROM stat WHERE N1 > 0 AND N2 > 0),
ks AS (SELECT pv.col_name, D AS ks_statistic,
              CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2.0 *
                (SELECT sum(power(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam)) FROM range(1, 101) r(k)))) END AS p_value,
              N1, N2, reference_mean, current_mean, reference_std, current_std
       FROM pv LEFT JOIN mom ON pv.col_name = mom.col_name)"""


KS_OUT = f"""SELECT col_name, {r6(['ks_statistic', 'p_value'])}, p_value < 0.05 AS drift_detected,
       CAST(0.05 AS DOUBLE) AS threshold, CAST(N1 AS BIGINT) AS n_ref, CAST(N2 AS BIGINT) AS n_cur,
       {r6(['reference_mean', 'current_mean', 'reference_std', 'current_std'])} FROM ks"""


@query("ks_drift", HALVES_SQL + ks_sql(FEATURES) + "\n" + KS_OUT)
def ks_drift(t):
    """G1: two-sample KS of value, user_id and props.k, first vs second half."""
    ref, cur = event_halves(t)
    return drift.ks_drift(ref, cur, FEATURES)


def tvd_sql(cols, ref="ref", cur="cur") -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, CAST({c} AS VARCHAR) AS category, 0 AS side FROM {ref} "
        f"UNION ALL SELECT '{c}', CAST({c} AS VARCHAR), 1 FROM {cur}" for c in cols)
    return f""",
cl AS ({long}),
cc AS (SELECT col_name, category, count(*) FILTER (WHERE side = 0) AS n_ref, count(*) FILTER (WHERE side = 1) AS n_cur
       FROM cl WHERE category IS NOT NULL GROUP BY col_name, category),
cp AS (SELECT *, CASE WHEN sum(n_ref) OVER (PARTITION BY col_name) > 0
                      THEN n_ref / sum(n_ref) OVER (PARTITION BY col_name) ELSE 0.0 END AS p_ref,
                 CASE WHEN sum(n_cur) OVER (PARTITION BY col_name) > 0
                      THEN n_cur / sum(n_cur) OVER (PARTITION BY col_name) ELSE 0.0 END AS p_cur FROM cc),
tvd AS (SELECT col_name, 0.5 * sum(abs(p_ref - p_cur)) AS drift_score,
               CAST(count(*) FILTER (WHERE n_ref > 0) AS BIGINT) AS reference_unique_values,
               CAST(count(*) FILTER (WHERE n_cur > 0) AS BIGINT) AS current_unique_values,
               CAST(count(*) FILTER (WHERE n_ref = 0 AND n_cur > 0) AS BIGINT) AS new_categories,
               CAST(count(*) FILTER (WHERE n_ref > 0 AND n_cur = 0) AS BIGINT) AS missing_categories
        FROM cp GROUP BY col_name)"""


@query("categorical_drift", HALVES_SQL + tvd_sql(CATEGORICAL) + """
SELECT col_name, ROUND(drift_score, 6) AS drift_score, reference_unique_values, current_unique_values,
       new_categories, missing_categories, drift_score > 0.1 AS drift_detected, CAST(0.1 AS DOUBLE) AS threshold FROM tvd""")
def categorical_drift(t):
    """Total variation distance of the event-type mix between the halves."""
    ref, cur = event_halves(t)
    return drift.categorical_drift(ref, cur, CATEGORICAL)


@query("category_distribution_match", HALVES_SQL + tvd_sql(("event_type", "user_id")) + """
SELECT col_name, category, ROUND(p_ref, 6) AS p_ref, ROUND(p_cur, 6) AS p_cur, n_ref > 0 AS in_ref, n_cur > 0 AS in_cur
FROM cp""")
def category_distribution_match(t):
    """Outer match of two category distributions (absent side -> 0)."""
    ref, cur = event_halves(t)
    return drift.category_distributions(ref, cur, ["event_type", "user_id"])


_EVENT_NUMERIC = ("event_id", "user_id", "value", "props_k")

TABLE_DRIFT_SQL = HALVES_SQL + ks_sql(_EVENT_NUMERIC) + tvd_sql(CATEGORICAL) + """,
per_col AS (SELECT col_name, 'numerical' AS kind, ks_statistic AS score, p_value, p_value < 0.05 AS drift_detected FROM ks
            UNION ALL
            SELECT col_name, 'categorical', drift_score, CAST(NULL AS DOUBLE), drift_score > 0.1 FROM tvd)"""


@query("table_drift", TABLE_DRIFT_SQL + "\nSELECT col_name, kind, ROUND(score, 6) AS score, ROUND(p_value, 6) AS p_value, drift_detected FROM per_col")
def table_drift(t):
    """Every numeric column by KS, the listed categorical columns by TVD."""
    ref, cur = event_halves(t)
    return drift.table_drift(ref, cur, CATEGORICAL)


@query("drift_summary", TABLE_DRIFT_SQL + """
SELECT CAST(count(*) AS BIGINT) AS total_columns_checked,
       CAST(count(*) FILTER (WHERE drift_detected) AS BIGINT) AS drifting_columns,
       COALESCE(string_agg(col_name, ',' ORDER BY col_name) FILTER (WHERE drift_detected), '') AS columns_with_drift,
       ROUND(COALESCE(avg(score) FILTER (WHERE drift_detected), 0.0), 6) AS overall_drift_score,
       COALESCE(avg(score) FILTER (WHERE drift_detected), 0.0) > 0.3 AS drift_threshold_exceeded
FROM per_col""")
def drift_summary(t):
    """G4 + G5: halves by position, table drift, summary with the 0.3 gate."""
    ref, cur = event_halves(t)
    return drift.drift_summary(drift.table_drift(ref, cur, CATEGORICAL))


WEATHER_HALVES_SQL = f"""
WITH ranked AS (SELECT *, row_number() OVER (ORDER BY date) - 1 AS pos, count(*) OVER () AS n FROM ({DAILY_WIDE_SQL})),
ref AS (SELECT * EXCLUDE (pos, n) FROM ranked WHERE pos < n // 2),
cur AS (SELECT * EXCLUDE (pos, n) FROM ranked WHERE pos >= n // 2)"""


@query("weather_drift", WEATHER_HALVES_SQL + ks_sql(FEED_COLS) + "\n" + KS_OUT)
def weather_drift(t):
    """G3 on the daily feed (the reference's weather drift), halves by date."""
    w = daily_feed_wide(t)
    ref, cur = split_by_position(w, "date")
    return drift.ks_drift(ref, cur, FEED_COLS)


_DECILES = "[" + ", ".join(f"{p:.1f}" for p in drift.DECILES) + "]"


def _edges_sql(src: str, cols) -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS col_name, CAST({c} AS DOUBLE) AS v FROM {src}" for c in cols)
    return f"""(SELECT col_name, list_sort(list_distinct(quantile_cont(v, {_DECILES}))) AS edges
               FROM ({long}) WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY col_name)"""


@query("baseline_stats", HALVES_SQL + f""",
bl AS ({" UNION ALL ".join(f"SELECT '{c}' AS col_name, CAST({c} AS DOUBLE) AS v FROM ref" for c in FEATURES)}),
m AS (SELECT col_name, CAST(count(*) AS BIGINT) AS n, avg(v) AS mean, stddev_pop(v) AS std, min(v) AS min, max(v) AS max
      FROM bl WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY col_name),
e AS {_edges_sql('ref', FEATURES)}
SELECT m.col_name, n, {r6(['mean', 'std', 'min', 'max'])}, list_transform(e.edges, lambda x: ROUND(x, 6)) AS edges
FROM m LEFT JOIN e ON m.col_name = e.col_name""")
def baseline_stats(t):
    """Baseline moments and decile edges of the reference half."""
    ref, _ = event_halves(t)
    return drift.baseline_stats(ref, FEATURES)


def stored_baseline(t):
    """G8 written to the shared folder and read back, and the second half measured against it."""
    ref, cur = event_halves(t)
    path = f"{ensure_checkpoint_dir(t.spark)}/baseline-{uuid.uuid4().hex}"
    profile = baseline.save_profile(baseline.baseline_profile(ref, FEATURES), path)
    return profile, baseline.measure(cur, profile, FEATURES)


def _histogram_sql(src: str) -> str:
    """Counts of ``src`` on the edges of the first half, and its moments."""
    long = " UNION ALL ".join(f"SELECT '{c}' AS col_name, CAST({c} AS DOUBLE) AS v FROM {src}" for c in FEATURES)
    return f"""
, e AS {_edges_sql('ref', FEATURES)},
v AS (SELECT l.*, e.edges FROM ({long}) l JOIN e ON e.col_name = l.col_name WHERE v IS NOT NULL AND NOT isnan(v)),
h AS (SELECT col_name, edges, CAST(count(*) AS BIGINT) AS n, avg(v) AS mean, var_pop(v) * count(*) AS m2, min(v) AS min, max(v) AS max,
  CAST(count(*) FILTER (v < edges[1]) AS BIGINT) AS below, CAST(count(*) FILTER (v > edges[-1]) AS BIGINT) AS above, list(v) AS vs FROM v GROUP BY ALL)
SELECT col_name, n, {r6(['mean', 'm2', 'min', 'max'])}, list_transform(edges, lambda x: ROUND(x, 6)) AS edges,
  list_transform(generate_series(1, len(edges) - 1), lambda i: CAST(len(list_filter(vs, lambda x: x >= edges[i] AND (x < edges[i + 1] OR (i = len(edges) - 1 AND x = edges[i + 1])))) AS BIGINT)) AS counts,
  below, above FROM h"""


@query("baseline_histogram", HALVES_SQL + _histogram_sql("ref"))
def baseline_histogram(t):
    """The baseline table of the first half: edges, counts per bin and moments, stored and read back."""
    profile, _ = stored_baseline(t)
    return profile


@query("baseline_merged", HALVES_SQL + _histogram_sql("events_k").replace("\n, e AS", ",\nevents_k AS (SELECT * FROM ref UNION ALL SELECT * FROM cur)\n, e AS", 1))
def baseline_merged(t):
    """The stored baseline and the measured second half merged: the profile of all events."""
    profile, measured = stored_baseline(t)
    return baseline.merge_profiles(profile, measured)


PSI_SQL = HALVES_SQL + f""",
e AS {_edges_sql('ref', FEATURES)},
eb AS (SELECT col_name, i - 1 AS bin, edges[i] AS lo, edges[i + 1] AS hi, i = len(edges) - 1 AS is_last
       FROM (SELECT col_name, edges, unnest(range(1, len(edges))) AS i FROM e)),
vals AS ({" UNION ALL ".join(f"SELECT '{c}' AS col_name, CAST({c} AS DOUBLE) AS v, 0 AS side FROM ref UNION ALL SELECT '{c}', CAST({c} AS DOUBLE), 1 FROM cur" for c in FEATURES)}),
vv AS (SELECT * FROM vals WHERE v IS NOT NULL AND NOT isnan(v)),
sizes AS (SELECT col_name, count(*) FILTER (WHERE side = 0) AS N_e, count(*) FILTER (WHERE side = 1) AS N_a FROM vv GROUP BY col_name),
binned AS (SELECT eb.col_name, eb.bin, count(*) FILTER (WHERE side = 0) AS c_e, count(*) FILTER (WHERE side = 1) AS c_a
           FROM vv JOIN eb ON vv.col_name = eb.col_name AND vv.v >= eb.lo AND (vv.v < eb.hi OR (eb.is_last AND vv.v = eb.hi))
           GROUP BY eb.col_name, eb.bin),
filled AS (SELECT eb.col_name, greatest(COALESCE(c_e, 0) / N_e, 1e-8) AS ee, greatest(COALESCE(c_a, 0) / N_a, 1e-8) AS aa
           FROM eb LEFT JOIN binned b ON eb.col_name = b.col_name AND eb.bin = b.bin JOIN sizes s ON eb.col_name = s.col_name),
ps AS (SELECT e.col_name, CASE WHEN len(e.edges) < 2 THEN 0.0 ELSE (SELECT sum((aa - ee) * ln(aa / ee)) FROM filled f
              WHERE f.col_name = e.col_name) END AS psi, CAST(s.N_a AS BIGINT) AS n_production
       FROM e JOIN sizes s ON e.col_name = s.col_name WHERE s.N_a >= 10),
psl AS (SELECT *, CASE WHEN psi > 0.2 THEN 'significant' WHEN psi > 0.1 THEN 'moderate' ELSE 'none' END AS level FROM ps)"""


@query("psi_by_feature", PSI_SQL + "\nSELECT col_name, ROUND(psi, 6) AS psi, n_production, level FROM psl")
def psi_by_feature(t):
    """PSI of each feature, second half against the stored first-half baseline."""
    profile, measured = stored_baseline(t)
    return drift.psi_from_baseline(profile, measured)


@query("psi_drift_score", PSI_SQL + """
SELECT ROUND(COALESCE(avg(psi), 0.0), 6) AS mean_psi, CAST(count(*) AS BIGINT) AS features_checked,
       COALESCE(avg(psi), 0.0) > 0.5 AS alert FROM psl""")
def psi_drift_score(t):
    """Mean PSI over checked features and the alert flag."""
    profile, measured = stored_baseline(t)
    return drift.drift_score(drift.psi_from_baseline(profile, measured))


# --- feedback store -----------------------------------------------------------

def prediction_log(t):
    e = t["events"]
    return e.where(F.col("event_type") != "purchase").select(
        F.col("user_id").alias("request_id"), F.col("props").alias("features"),
        F.col("value").alias("prediction"), F.lit("v1").alias("model_version"),
        F.col("ts").alias("timestamp"), "event_id")


def label_log(t):
    e = t["events"]
    return e.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("request_id"), F.col("value").alias("actual_delay"),
        F.col("event_type").alias("user_feedback"), F.col("ts").alias("label_timestamp"),
        F.col("event_id").alias("label_event_id"))


def feedback_store(t):
    return feedback.feedback_table(prediction_log(t), label_log(t), tiebreak="event_id",
                                   label_tiebreak="label_event_id")


FEEDBACK_SQL = """
WITH preds AS (SELECT user_id AS request_id, props AS features, value AS prediction, 'v1' AS model_version,
                      ts AS timestamp, event_id FROM events WHERE event_type <> 'purchase'),
labs AS (SELECT user_id AS request_id, value AS actual_delay, event_type AS user_feedback, ts AS label_timestamp,
                event_id AS label_event_id FROM events WHERE event_type = 'purchase'),
latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY request_id
           ORDER BY timestamp DESC, event_id DESC) AS rn FROM preds) WHERE rn = 1),
surv AS (SELECT request_id, actual_delay, user_feedback FROM (
           SELECT l.*, row_number() OVER (PARTITION BY l.request_id ORDER BY label_timestamp DESC, label_event_id DESC) AS rn
           FROM labs l JOIN latest p ON l.request_id = p.request_id WHERE l.label_timestamp >= p.timestamp) WHERE rn = 1),
fb AS (SELECT p.*, s.actual_delay, s.user_feedback FROM latest p LEFT JOIN surv s ON p.request_id = s.request_id)"""


@query("feedback_table", FEEDBACK_SQL + "\nSELECT * REPLACE (ROUND(prediction, 6) AS prediction, ROUND(actual_delay, 6) AS actual_delay) FROM fb")
def feedback_table(t):
    """I1 + I2 (D10): latest prediction per request with its surviving label."""
    return feedback_store(t)


@query("labeled_feedback", FEEDBACK_SQL + """
SELECT request_id, ROUND(prediction, 6) AS prediction, ROUND(actual_delay, 6) AS actual_delay, timestamp,
       TRY_CAST(json_extract_string(features, '$.k') AS DOUBLE) AS k
FROM fb WHERE actual_delay IS NOT NULL""")
def labeled_feedback(t):
    """I3 (+ F12, H19): labelled rows, feature JSON decoded, ``k`` expanded."""
    lab = feedback.labeled_view(feedback_store(t))
    return feedback.expand_features(lab, ["k"]).select("request_id", "prediction", "actual_delay", "timestamp", "k")


@query("label_coverage", FEEDBACK_SQL + """
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(actual_delay) AS BIGINT) AS labeled,
       ROUND(count(actual_delay) * 100.0 / greatest(count(*), 1), 1) AS coverage_pct FROM fb""")
def label_coverage(t):
    """Total, labelled and coverage percentage of the feedback store."""
    return explore.label_coverage(feedback_store(t))


@query("score_summary", """
SELECT CAST(count(*) AS BIGINT) AS total, CAST(sum(CASE WHEN value > 15 THEN 1 ELSE 0 END) AS BIGINT) AS delayed,
       CAST(sum(CASE WHEN value > 15 THEN 0 ELSE 1 END) AS BIGINT) AS on_time
FROM events WHERE event_type <> 'purchase'""")
def score_summary(t):
    """Total / delayed / on-time counts of the prediction log."""
    return explore.score_summary(prediction_log(t), "prediction")


@query("feedback_metrics", FEEDBACK_SQL + f"""
, m AS (SELECT count(*) AS n, 1 - sum((actual_delay - prediction) * (actual_delay - prediction))
               / (var_pop(actual_delay) * count(*)) AS r2_score,
               avg(abs(actual_delay - prediction)) AS mae,
               sqrt(avg((actual_delay - prediction) * (actual_delay - prediction))) AS rmse,
               avg((actual_delay - prediction) * (actual_delay - prediction)) AS mse
        FROM fb WHERE actual_delay IS NOT NULL AND prediction IS NOT NULL)
SELECT CAST(n AS BIGINT) AS n, {r6(['r2_score', 'mae', 'rmse', 'mse'])} FROM m""")
def feedback_metrics(t):
    """H7: R^2, MAE, RMSE, MSE over the labelled feedback."""
    return metrics.regression_metrics(feedback_store(t), "actual_delay", "prediction")


@query("feedback_classification", FEEDBACK_SQL + """
, f AS (SELECT CASE WHEN actual_delay > 15 THEN 1 ELSE 0 END AS y, CASE WHEN prediction > 15 THEN 1 ELSE 0 END AS p,
               actual_delay, prediction FROM fb WHERE actual_delay IS NOT NULL AND prediction IS NOT NULL),
c AS (SELECT sum(y * p) AS tp, sum((1 - y) * p) AS fp, sum(y * (1 - p)) AS fn, sum((1 - y) * (1 - p)) AS tn, count(*) AS n,
             avg(CASE WHEN actual_delay <> 0 THEN abs((actual_delay - prediction) / actual_delay) END) AS mape FROM f)
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
       ROUND((tp + tn) / n, 6) AS accuracy, ROUND(tp / (tp + fp), 6) AS precision, ROUND(tp / (tp + fn), 6) AS recall,
       ROUND(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))), 6) AS f1,
       ROUND(mape * 100, 6) AS mape FROM c""")
def feedback_classification(t):
    """Accuracy / precision / recall / F1 / MAPE of the delayed flag."""
    return metrics.classification_metrics(feedback_store(t), "actual_delay", "prediction")


ACC_SQL = FEEDBACK_SQL + f"""
, m AS (SELECT count(*) AS n, 1 - sum((actual_delay - prediction) * (actual_delay - prediction))
               / (var_pop(actual_delay) * count(*)) AS r2_score, avg(abs(actual_delay - prediction)) AS mae
        FROM fb WHERE actual_delay IS NOT NULL AND prediction IS NOT NULL),
acc AS (SELECT CAST(n AS BIGINT) AS n, r2_score, mae, CAST({BASELINE_R2} AS DOUBLE) AS baseline_r2, CAST({BASELINE_MAE} AS DOUBLE) AS baseline_mae,
               COALESCE(n >= 100 AND r2_score < {BASELINE_R2} - 0.05, false) AS accuracy_drop,
               COALESCE(n >= 100 AND mae > {BASELINE_MAE} * 1.2, false) AS retrain_on_mae FROM m)"""


@query("accuracy_check", ACC_SQL + f"\nSELECT * REPLACE ({r6(['r2_score', 'mae'])}) FROM acc")
def accuracy_check(t):
    """G9 + G10: R^2 drop against the baseline and the MAE retrain rule."""
    return metrics.accuracy_check(feedback_store(t), "actual_delay", "prediction", BASELINE_R2, BASELINE_MAE)


@query("monitor_full_check", PSI_SQL.replace(HALVES_SQL, HALVES_SQL + ",\n" + ACC_SQL.strip()[len("WITH "):]) + """
SELECT ROUND(COALESCE((SELECT avg(psi) FROM psl), 0.0), 6) AS drift_score,
       (SELECT accuracy_drop FROM acc) AS accuracy_drop,
       COALESCE((SELECT avg(psi) FROM psl), 0.0) > 0.5 OR (SELECT accuracy_drop FROM acc) AS should_retrain""")
def monitor_full_check(t):
    """Drift score (mean PSI), accuracy drop and the retrain decision."""
    profile, measured = stored_baseline(t)
    score = drift.drift_score(drift.psi_from_baseline(profile, measured)).select(F.col("mean_psi").alias("drift_score"))
    acc = metrics.accuracy_check(feedback_store(t), "actual_delay", "prediction", BASELINE_R2, BASELINE_MAE).select("accuracy_drop")
    both = score.unionByName(acc, allowMissingColumns=True)   # two rows to one
    both = both.agg(F.max("drift_score").alias("drift_score"), F.bool_or("accuracy_drop").alias("accuracy_drop"))
    return both.withColumn("should_retrain", (F.col("drift_score") > drift.PSI_ALERT) | F.col("accuracy_drop"))


@query("feedback_confusion", FEEDBACK_SQL + """
SELECT CASE WHEN actual_delay > 15 THEN 1 ELSE 0 END AS actual, CASE WHEN prediction > 15 THEN 1 ELSE 0 END AS predicted,
       count(*) AS n
FROM fb WHERE actual_delay IS NOT NULL AND prediction IS NOT NULL GROUP BY 1, 2""")
def feedback_confusion(t):
    """Confusion matrix of the delayed flag on labelled feedback."""
    return metrics.confusion_matrix(feedback_store(t), "actual_delay", "prediction")
