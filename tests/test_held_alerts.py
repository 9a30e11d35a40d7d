"""Held-condition alerts: the stream equals the batch for every kind of metric."""

import datetime as dt
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from contrail.operators import baseline
from contrail.streaming import alerts as A
from contrail.streaming import feedback as S
from contrail.streaming import windows as W

from paths import SF01, SMOKE
from test_feedback_stream import EVENTS, H, T0, label, pred

WINDOWS = "series string, window_start timestamp, m double"


@pytest.fixture(scope="module", autouse=True)
def rocksdb(spark):
    S.use_rocksdb(spark)


def test_every_rule_fires_on_the_driver_tables(spark):
    got = Counter(r.rule for r in E.queries()["held_alerts"](spark, SF01).collect())
    assert set(got) == set(A.RULES)


@pytest.mark.parametrize("op,threshold", [(">", 5.0), ("<", 5.0)])
def test_runs_breaks_gaps_and_nulls(spark, op, threshold):
    low, high = (1.0, 9.0) if op == ">" else (9.0, 1.0)
    series = {"a": [high] * 5, "b": [high, low, high, high, low, high, high, high], "gap": [high, None, "missing", high, high], "null": [high, high, None, high], "edge": [threshold] * 4}
    rows = [(s, T0 + i * H, None if v is None else v) for s, vs in series.items() for i, v in enumerate(vs) if v != "missing"]
    rule = A.Rule("r", op, threshold, 3600, 2)
    got = {(r.series, r.episode_start, r.fires_at, r.value) for r in A.held_alerts(spark.createDataFrame(rows, WINDOWS), rule, "m", series="series").collect()}
    assert got == {("a", T0, T0 + 2 * H, high), ("b", T0 + 2 * H, T0 + 4 * H, high), ("b", T0 + 5 * H, T0 + 7 * H, high),
                   ("gap", T0 + 3 * H, T0 + 5 * H, high), ("null", T0, T0 + 2 * H, high)}


def streamed(spark, batches, schema, windows, rule, metric, series=None):
    """Alerts of a stream fed with the batches one after another."""
    src, out, state = (tempfile.mkdtemp(prefix="contrail-held-") for _ in range(3))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    alerts = A.held_alerts_stream(windows(stream), rule, metric, series=series)
    q = alerts.writeStream.outputMode("append").option("checkpointLocation", state).format("parquet").option("path", out).start()
    try:
        for x in batches:
            x.coalesce(1).write.mode("append").parquet(src)
            q.processAllAvailable()
    finally:
        q.stop()
    return rows_of(spark.read.schema(A.ALERTS).parquet(out))


def rows_of(df):
    return sorted((r.rule, r.series, r.episode_start, r.fires_at, round(r.value, 9)) for r in df.collect())


def batches_of(ev, ts="ts"):
    """Three slices in event order and two closing rows that move the watermark past all windows."""
    cuts = ("2023-01-01", "2024-01-11", "2024-01-21", "2024-03-01")
    parts = [ev.where((F.col(ts) >= a) & (F.col(ts) < b)) for a, b in zip(cuts, cuts[1:])]
    far = [ev.limit(1).withColumn(ts, F.lit(dt.datetime(2030, 1, d)).cast(ev.schema[ts].dataType)) for d in (1, 5)]
    return parts + far


@pytest.mark.parametrize("kind", ["latency", "errors", "quality"])
def test_stream_equals_batch(spark, kind):
    ev = spark.read.parquet(f"{SMOKE}/events.parquet").select("ts", "value", "event_type", F.col("user_id").cast("double").alias("user_id"))
    if kind == "latency":
        rule, metric, series = A.Rule("p99", ">", 0.9, 6 * 3600, 3), "p99", None
        windows = lambda d, wm=None: W.latency_quantiles(d.withColumn("latency_s", F.col("value") / 100), "ts", "latency_s", "6 hours", watermark=wm)
    elif kind == "errors":
        rule, metric, series = A.Rule("rate", ">", 1.0 / 86400, 86400, 2), "rate_per_s", "event_type"
        windows = lambda d, wm=None: W.event_rate(d, "ts", "event_type", "1 day", 86400.0, wm)
    else:
        profile = baseline.save_profile(baseline.baseline_profile(ev, ["value", "user_id"]), tempfile.mkdtemp() + "/p")
        rule, metric, series = A.Rule("quality", "<", 0.99, 86400, 2), "quality_score", None
        windows = lambda d, wm=None: W.profile_windows(d, "ts", profile, ["value", "user_id"], "1 day", wm)
        ev = ev.withColumn("value", F.when(F.dayofmonth("ts") % 5 > 1, F.col("value")))
    want = rows_of(A.held_alerts(windows(ev), rule, metric, series=series))
    got = streamed(spark, batches_of(ev), ev.schema, lambda d: windows(d, "1 hour"), rule, metric, series)
    assert want and [r for r in got if r[2] < dt.datetime(2029, 1, 1)] == want


def test_r2_alerts_behind_the_feedback_machine(spark):
    """Three stateful operators in a row: sessions, accuracy windows, runs."""
    events = []
    for n in range(96):   # the second and third day's predictions are far off
        off = 0.0 if n < 24 or n >= 72 else 40.0
        events += [pred(f"r{n}", n, float(n % 7) + off * (n % 3 - 1), 2 * n), label(f"r{n}", n, float(n % 7), 2 * n + 1)]
    gap, rule = 4, A.Rule("model_r2", "<", 0.7, 86400, 2)
    batch = A.held_alerts(S.accuracy_windows(S.feedback_sessions(spark.createDataFrame(events, EVENTS), gap * 3600), "1 day"), rule, "r2_score")
    want = rows_of(batch)
    frames = [spark.createDataFrame(x, EVENTS) for x in (events[:60], events[60:], *[[pred("zz", h, 0.0)] for h in (2000, 4000, 6000, 6001)])]
    got = streamed(spark, frames, EVENTS, lambda d: S.accuracy_windows(S.feedback_changes(d, gap * 3600).where("final"), "1 day"), rule, "r2_score")
    assert len(want) == 1 and got == want
