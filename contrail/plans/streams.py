"""Queries: batch forms of the monitoring streams (S3-S7) over ``events``.

The same window operators run on a ``readStream`` of the events files
(see ``tests/test_streaming.py``); here they run on the whole table so the
driver can compare them with SQL.  Latency role: value / 100 seconds.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from contrail.operators import metrics
from contrail.plans.catalog import query
from contrail.plans.monitoring import BASELINE_MAE, BASELINE_R2, FEATURES, FEEDBACK_SQL, HALVES_SQL, _edges_sql, event_features, label_log, prediction_log, r6, stored_baseline
from contrail.session import ensure_checkpoint_dir
from contrail.streaming import alerts as A
from contrail.streaming import feedback as L
from contrail.streaming import windows as W

ALERT_THRESHOLD = 4      # events of one type per hour
ALERT_MIN_WINDOWS = 2    # consecutive hours ("for: 2h")


def latency_events(t):
    return t["events"].withColumn("latency_s", F.col("value") / 100.0)


@query("prediction_volume_per_minute", """
SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS window_end, count(*) AS n
FROM events WHERE event_type <> 'purchase' GROUP BY 1, 2""")
def prediction_volume_per_minute(t):
    """S3: predictions per 1-minute tumbling window."""
    return W.volume(prediction_log(t), "timestamp", "1 minute")


@query("prediction_volume_per_day", """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, count(*) AS n
FROM events WHERE event_type <> 'purchase' GROUP BY 1, 2""")
def prediction_volume_per_day(t):
    """S3: predictions per 24-hour window."""
    return W.volume(prediction_log(t), "timestamp", "1 day")


@query("class_ratio_sliding", """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS total,
       CAST(sum(CASE WHEN value > 15 THEN 1 ELSE 0 END) AS BIGINT) AS delayed,
       count(*) - sum(CASE WHEN value > 15 THEN 1 ELSE 0 END) AS on_time,
       ROUND(sum(CASE WHEN value > 15 THEN 1 ELSE 0 END) / count(*), 6) AS delayed_ratio
FROM (SELECT value, time_bucket(INTERVAL 10 MINUTE, ts) - k * INTERVAL 10 MINUTE AS window_start
      FROM events, (SELECT unnest(range(0, 6)) AS k) ks WHERE event_type <> 'purchase')
GROUP BY window_start""")
def class_ratio_sliding(t):
    """Delayed / on-time ratio over 1-hour windows sliding by 10 minutes."""
    return W.class_ratio(prediction_log(t), "timestamp", "prediction", "1 hour", "10 minutes")


def _hq_sql(q: float, bounds, total="total") -> str:
    expr = f"{float(bounds[-1])}"
    for i in reversed(range(len(bounds))):
        lo = 0.0 if i == 0 else float(bounds[i - 1])
        c_lo = "0" if i == 0 else f"le_{i - 1}"
        interp = (f"({lo} + ({float(bounds[i])} - {lo}) * CASE WHEN (le_{i} - {c_lo}) = 0 THEN NULL "
                  f"ELSE ({q} * {total} - {c_lo}) / (le_{i} - {c_lo}) END)")
        expr = f"CASE WHEN le_{i} >= {q} * {total} THEN {interp} ELSE {expr} END"
    return f"CASE WHEN {total} > 0 THEN {expr} END"


_LE = ", ".join(f"count(*) FILTER (WHERE value / 100.0 <= {b}) AS le_{i}" for i, b in enumerate(W.LATENCY_BUCKETS))


@query("latency_quantiles_5min", f"""
SELECT window_start, total, ROUND({_hq_sql(0.5, W.LATENCY_BUCKETS)}, 6) AS p50,
       ROUND({_hq_sql(0.95, W.LATENCY_BUCKETS)}, 6) AS p95, ROUND({_hq_sql(0.99, W.LATENCY_BUCKETS)}, 6) AS p99
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS total, {_LE}
      FROM events GROUP BY 1)""")
def latency_quantiles_5min(t):
    """p50 / p95 / p99 latency per 5 minutes from the 10-bucket histogram."""
    return W.latency_quantiles(latency_events(t), "ts", "latency_s", "5 minutes")


@query("event_rate_5min", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS n,
       ROUND(count(*) / 300.0, 6) AS rate_per_s
FROM events GROUP BY 1, 2""")
def event_rate_5min(t):
    """Events per second by type over 5-minute windows."""
    return W.event_rate(t["events"], "ts", "event_type", "5 minutes", 300.0)


@query("alert_episodes", f"""
WITH per AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n
             FROM events GROUP BY 1, 2),
b AS (SELECT *, CAST(epoch(window_start) AS BIGINT) // 3600 AS idx FROM per WHERE n > {ALERT_THRESHOLD}),
r AS (SELECT *, idx - row_number() OVER (PARTITION BY event_type ORDER BY idx) AS island FROM b)
SELECT event_type, min(window_start) AS episode_start, max(window_start) AS last_window_start,
       count(*) AS breach_windows, max(n) AS peak,
       min(window_start) + INTERVAL {3600 * ALERT_MIN_WINDOWS} SECOND AS fires_at
FROM r GROUP BY event_type, island HAVING count(*) >= {ALERT_MIN_WINDOWS}""")
def alert_episodes(t):
    """Episodes where one event type exceeds 4 events per hour for at
    least 2 consecutive hours, and when the alert fires."""
    per = W.event_rate(t["events"], "ts", "event_type", "1 hour", 3600.0)
    return W.breach_episodes(per, ["event_type"], "window_start", "n", ALERT_THRESHOLD, 3600, ALERT_MIN_WINDOWS)


FEEDBACK_GAP = 2 * 86400   # seconds without an event that end a request's session
FOREVER = 400 * 86400


def feedback_log(t):
    return L.feedback_events(prediction_log(t), label_log(t), "event_id", "label_event_id")


@query("feedback_stream", FEEDBACK_SQL + """
SELECT CAST(request_id AS VARCHAR) AS request_id, ROUND(prediction, 6) AS prediction, features, model_version, timestamp, event_id AS seq,
       ROUND(actual_delay, 6) AS actual_delay, user_feedback FROM fb""")
def feedback_stream(t):
    """The two logs as a stream through the keyed state machine, drained to the feedback table."""
    L.use_rocksdb(t.spark)
    folder = f"{ensure_checkpoint_dir(t.spark)}/feedback-{uuid.uuid4().hex}"
    changes = L.feedback_changes(feedback_log({"events": t.stream("events")}), FOREVER)
    run = changes.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/state").format("parquet").option("path", f"{folder}/changes")
    run.trigger(availableNow=True).start().awaitTermination()
    out = L.latest_feedback(t.spark.read.schema(changes.schema).parquet(f"{folder}/changes"))
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


_ACCURACY_SQL = f"""
WITH log AS (SELECT user_id AS id, ts, event_id AS seq, event_type = 'purchase' AS is_label, value FROM events),
gaps AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY id ORDER BY ts, seq) > {FEEDBACK_GAP * 1_000_000} THEN 1 ELSE 0 END AS apart FROM log),
ses AS (SELECT *, sum(apart) OVER (PARTITION BY id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS session FROM gaps),
one AS (SELECT id, session, max(ts) + INTERVAL {FEEDBACK_GAP} SECOND AS closed_at,
    arg_max(value, (ts, seq)) FILTER (NOT is_label) AS prediction, max(ts) FILTER (NOT is_label) AS p_ts,
    arg_max(value, (ts, seq)) FILTER (is_label) AS actual, max(ts) FILTER (is_label) AS l_ts FROM ses GROUP BY id, session),
lab AS (SELECT time_bucket(INTERVAL 1 DAY, closed_at) AS window_start, prediction, actual FROM one WHERE l_ts >= p_ts),
m AS (SELECT window_start, CAST(count(*) AS BIGINT) AS n,
    CASE WHEN var_pop(actual) = 0 THEN NULL ELSE 1 - sum((actual - prediction) * (actual - prediction)) / (var_pop(actual) * count(*)) END AS r2_score,
    avg(abs(actual - prediction)) AS mae, sqrt(avg((actual - prediction) * (actual - prediction))) AS rmse, avg((actual - prediction) * (actual - prediction)) AS mse
    FROM lab GROUP BY 1)"""


@query("feedback_accuracy_windows", _ACCURACY_SQL + f"\nSELECT window_start, n, {r6(['r2_score', 'mae', 'rmse', 'mse'])} FROM m")
def feedback_accuracy_windows(t):
    """S2 behind I1 / I2: daily MAE and R2 of the requests whose sessions closed that day."""
    out = L.accuracy_windows(L.feedback_sessions(feedback_log(t), FEEDBACK_GAP), "1 day")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("event_rate_sliding", """
SELECT window_start, event_type, count(*) AS n, ROUND(count(*) / 300.0, 6) AS rate_per_s
FROM (SELECT event_type, time_bucket(INTERVAL 1 MINUTE, ts) - k * INTERVAL 1 MINUTE AS window_start
      FROM events, (SELECT unnest(range(0, 5)) AS k) ks) GROUP BY 1, 2""")
def event_rate_sliding(t):
    """Events per second by type over 5-minute windows advancing by a minute."""
    return W.event_rate(t["events"], "ts", "event_type", "5 minutes", 300.0, slide="1 minute")


DAY = 86400
_PROFILE_WINDOWS_SQL = HALVES_SQL + f""",
e AS {_edges_sql('ref', FEATURES)},
bm AS ({" UNION ALL ".join(f"SELECT '{c}' AS col_name, avg(CAST({c} AS DOUBLE)) AS mean, stddev_pop(CAST({c} AS DOUBLE)) AS std, count({c}) AS n FROM ref" for c in FEATURES)}),
allv AS (SELECT * FROM ref UNION ALL SELECT * FROM cur),
days AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n_rows,
  (count(event_id) + count(user_id) + count(event_type) + count(value) + count(props) + count(props_k)) / (count(*) * 6.0) AS complete FROM allv GROUP BY 1),
lv AS ({" UNION ALL ".join(f"SELECT '{c}' AS col_name, time_bucket(INTERVAL 1 DAY, ts) AS window_start, CAST({c} AS DOUBLE) AS v FROM allv WHERE {c} IS NOT NULL" for c in FEATURES)}),
rv AS ({" UNION ALL ".join(f"SELECT '{c}' AS col_name, CAST({c} AS DOUBLE) AS v FROM ref WHERE {c} IS NOT NULL" for c in FEATURES)}),
eb AS (SELECT col_name, i AS bin, edges[i] AS lo, edges[i + 1] AS hi, i = len(edges) - 1 AS is_last FROM (SELECT col_name, edges, unnest(range(1, len(edges))) AS i FROM e)),
be AS (SELECT eb.col_name, eb.bin, count(*) AS c FROM rv JOIN eb ON rv.col_name = eb.col_name AND v >= lo AND (v < hi OR (is_last AND v = hi)) GROUP BY ALL),
dn AS (SELECT lv.col_name, window_start, count(*) AS n, avg(CAST(v BETWEEN mean - 3 * std AND mean + 3 * std AS DOUBLE)) AS valid FROM lv JOIN bm USING (col_name) GROUP BY ALL),
dc AS (SELECT lv.col_name, window_start, eb.bin, count(*) AS c FROM lv JOIN eb ON lv.col_name = eb.col_name AND v >= lo AND (v < hi OR (is_last AND v = hi)) GROUP BY ALL),
tp AS (SELECT dn.col_name, dn.window_start, greatest(coalesce(be.c, 0) / bm.n, 1e-8) AS p, greatest(coalesce(dc.c, 0) / dn.n, 1e-8) AS q
  FROM dn JOIN eb USING (col_name) JOIN bm USING (col_name) LEFT JOIN be ON be.col_name = eb.col_name AND be.bin = eb.bin
  LEFT JOIN dc ON dc.col_name = eb.col_name AND dc.bin = eb.bin AND dc.window_start = dn.window_start WHERE dn.n >= 10),
ps AS (SELECT window_start, avg(psi) AS mean_psi FROM (SELECT col_name, window_start, sum((q - p) * ln(q / p)) AS psi FROM tp GROUP BY ALL) GROUP BY 1),
qs AS (SELECT window_start, avg(valid) AS valid FROM dn GROUP BY 1),
pw AS (SELECT days.window_start, n_rows, coalesce(mean_psi, 0.0) AS mean_psi, 0.5 * complete + 0.5 * coalesce(valid, 1.0) AS quality_score
  FROM days LEFT JOIN ps USING (window_start) LEFT JOIN qs USING (window_start))"""


def profile_windows(t):
    profile, _ = stored_baseline(t)
    return W.profile_windows(event_features(t), "ts", profile, FEATURES, "1 day")


@query("profile_windows_daily", _PROFILE_WINDOWS_SQL + "\nSELECT window_start, n_rows, ROUND(mean_psi, 6) AS mean_psi, ROUND(quality_score, 6) AS quality_score FROM pw")
def profile_windows_daily(t):
    """G7 + C7 over time: mean PSI and quality per day against the stored first-half baseline."""
    return profile_windows(t)


# Rules on the roles' scales, so that each fires on the driver's events.
HELD = {
    "prediction_latency_p99": A.Rule("prediction_latency_p99", ">", 2.0, 3600, 3),
    "prediction_error_rate": A.Rule("prediction_error_rate", ">", 1 / 3600, 3600, 2),
    "model_r2": A.Rule("model_r2", "<", 0.70, DAY, 2),
    "drift_psi": A.Rule("drift_psi", ">", 0.03, DAY, 2),
    "data_quality": A.Rule("data_quality", "<", 0.9999, DAY, 1),
}


def _held_sql(rule, source: str, metric: str) -> str:
    return f"""(SELECT '{rule.name}' AS rule, 'all' AS series, to_timestamp((idx - {rule.min_windows - 1}) * {rule.window_seconds}) AT TIME ZONE 'UTC' AS episode_start,
  to_timestamp((idx + 1) * {rule.window_seconds}) AT TIME ZONE 'UTC' AS fires_at, ROUND(m, 6) AS value
FROM (SELECT *, row_number() OVER (PARTITION BY island ORDER BY idx) AS place FROM (SELECT *, idx - row_number() OVER (ORDER BY idx) AS island
  FROM (SELECT CAST(floor(epoch(window_start) / {rule.window_seconds}) AS BIGINT) AS idx, CAST({metric} AS DOUBLE) AS m FROM {source}) WHERE m {rule.op} {rule.threshold!r}))
WHERE place = {rule.min_windows})"""


_HELD_SQL = _PROFILE_WINDOWS_SQL + ",\n" + _ACCURACY_SQL.strip()[len("WITH "):] + f""",
lq AS (SELECT window_start, total, {_hq_sql(0.99, W.LATENCY_BUCKETS)} AS p99 FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS total, {_LE} FROM events GROUP BY 1)),
er AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) / 3600.0 AS rate FROM events WHERE event_type = 'error' GROUP BY 1)
""" + "\nUNION ALL ".join(_held_sql(HELD[r], src, m) for r, src, m in (
    ("prediction_latency_p99", "lq", "p99"), ("prediction_error_rate", "er", "rate"), ("model_r2", "m", "r2_score"), ("drift_psi", "pw", "mean_psi"), ("data_quality", "pw", "quality_score")))


@query("held_alerts", _HELD_SQL)
def held_alerts(t):
    """Alerts of five rules (p99 latency, error rate, R2, PSI, quality) that held for their windows."""
    errors = t["events"].where("event_type = 'error'")
    windows = {"prediction_latency_p99": (W.latency_quantiles(latency_events(t), "ts", "latency_s", "1 hour"), "p99"),
               "prediction_error_rate": (W.event_rate(errors, "ts", "event_type", "1 hour", 3600.0), "rate_per_s"),
               "model_r2": (L.accuracy_windows(L.feedback_sessions(feedback_log(t), FEEDBACK_GAP), "1 day"), "r2_score"),
               "drift_psi": (profile_windows(t), "mean_psi"), "data_quality": (profile_windows(t), "quality_score")}
    out = None
    for name, (rows, metric) in windows.items():
        got = A.held_alerts(rows, HELD[name], metric)
        out = got if out is None else out.unionByName(got)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("episode_start", "fires_at")})


SHORT_GAP = 6 * 3600   # short sessions give enough labelled rows for the accuracy rules


@query("accuracy_check_sessions", _ACCURACY_SQL.replace(f"> {FEEDBACK_GAP * 1_000_000} THEN", f"> {SHORT_GAP * 1_000_000} THEN").replace(f"INTERVAL {FEEDBACK_GAP} SECOND", f"INTERVAL {SHORT_GAP} SECOND") + f"""
, a AS (SELECT CAST(count(*) AS BIGINT) AS n, 1 - sum((actual - prediction) * (actual - prediction)) / (var_pop(actual) * count(*)) AS r2, avg(abs(actual - prediction)) AS mae
  FROM lab WHERE prediction IS NOT NULL AND actual IS NOT NULL)
SELECT n, ROUND(r2, 6) AS r2_score, ROUND(mae, 6) AS mae, CAST({BASELINE_R2} AS DOUBLE) AS baseline_r2, CAST({BASELINE_MAE} AS DOUBLE) AS baseline_mae,
  n >= 100 AND r2 < {BASELINE_R2} - 0.05 AS accuracy_drop, n >= 100 AND mae > {BASELINE_MAE} * 1.2 AS retrain_on_mae FROM a""")
def accuracy_check_sessions(t):
    """G9 + G10 over the labelled sessions of the feedback log, of which there are more than the 100 the rules ask for."""
    sessions = L.feedback_sessions(feedback_log(t), SHORT_GAP)
    return metrics.accuracy_check(sessions, "actual_delay", "prediction", BASELINE_R2, BASELINE_MAE)
