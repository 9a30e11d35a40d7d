"""Streams drain to the same answer as the batch operators; late data."""

import datetime as dt
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from contrail.streaming import stateful
from contrail.streaming import windows as W

from paths import SMOKE


def _scratch():
    return tempfile.mkdtemp(prefix="contrail-stream-")


def _drain(q):
    q.processAllAvailable()
    q.stop()


def test_volume_stream_equals_batch(spark):
    ev = spark.read.parquet(f"{SMOKE}/events.parquet")
    src = _scratch()
    ev.repartition(4).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (W.volume(stream, "ts", "1 hour").writeStream.outputMode("complete").format("memory")
         .queryName("vol_stream").start())
    _drain(q)
    got = {(r["window_start"], r["n"]) for r in spark.table("vol_stream").collect()}
    want = {(r["window_start"], r["n"]) for r in W.volume(ev, "ts", "1 hour").collect()}
    assert got == want


def test_latency_stream_append_with_watermark(spark):
    ev = spark.read.parquet(f"{SMOKE}/events.parquet").withColumn("latency_s", F.col("value") / 100)
    src = _scratch()
    ev.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    q = (W.latency_quantiles(stream, "ts", "latency_s", "1 day", watermark="1 hour")
         .writeStream.outputMode("append").format("memory").queryName("lat_stream").start())
    q.processAllAvailable()
    # a closing row far in the future moves the watermark past every window
    closing = ev.limit(1).withColumn("ts", F.lit(dt.datetime(2030, 1, 1)).cast(ev.schema["ts"].dataType))
    closing.write.mode("append").parquet(src)
    _drain(q)
    got = {r["window_start"]: r["p50"] for r in spark.table("lat_stream").collect()}
    want = {r["window_start"]: r["p50"] for r in W.latency_quantiles(ev, "ts", "latency_s", "1 day").collect()}
    assert got == want


def test_label_join_late_label_dropped(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    h = dt.timedelta(hours=1)
    psrc, lsrc = _scratch(), _scratch()
    preds = pd.DataFrame({"request_id": ["p1", "p2", "p3"], "prediction": [10.0, 20.0, 30.0],
                          "timestamp": [t0, t0, t0]})
    labels = pd.DataFrame({"request_id": ["p1", "p3"], "actual_delay": [11.0, 33.0],
                           "label_timestamp": [t0 + h, t0 + 72 * h]})   # p3's label is 3 days late
    pschema = "request_id string, prediction double, timestamp timestamp"
    lschema = "request_id string, actual_delay double, label_timestamp timestamp"
    spark.createDataFrame(preds, pschema).write.mode("append").parquet(psrc)
    spark.createDataFrame(labels, lschema).write.mode("append").parquet(lsrc)
    joined = stateful.join_labels(spark.readStream.schema(pschema).parquet(psrc),
                                  spark.readStream.schema(lschema).parquet(lsrc), max_delay="1 day")
    q = joined.writeStream.outputMode("append").format("memory").queryName("label_join").start()
    q.processAllAvailable()
    far = t0 + 240 * h
    spark.createDataFrame(pd.DataFrame({"request_id": ["zz"], "prediction": [0.0], "timestamp": [far]}),
                          pschema).write.mode("append").parquet(psrc)
    spark.createDataFrame(pd.DataFrame({"request_id": ["zz"], "actual_delay": [0.0], "label_timestamp": [far]}),
                          lschema).write.mode("append").parquet(lsrc)
    q.processAllAvailable()
    _drain(q)
    got = {r["request_id"]: r["actual_delay"] for r in spark.table("label_join").collect()}
    assert got["p1"] == 11.0
    assert got.get("p2", "missing") is None and got.get("p3", "missing") is None


def test_stateful_alerts_equal_batch_episodes(spark):
    ev = spark.read.parquet(f"{SMOKE}/events.parquet")
    per_batch = W.event_rate(ev, "ts", "event_type", "1 hour", 3600.0)
    want = {(r["event_type"], r["episode_start"]) for r in
            W.breach_episodes(per_batch, ["event_type"], "window_start", "n", 0, 3600, 3).collect()}
    src = _scratch()
    # three files written one after another, each a later time slice: the
    # stream sees the data in event-time order, so nothing is late
    for lo, hi in (("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")):
        ev.where((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    alerts = stateful.breach_alerts(stream, "event_type", "ts", 0, 3600, 3, watermark="1 hour")
    q = alerts.writeStream.outputMode("append").format("memory").queryName("alerts").start()
    q.processAllAvailable()
    closing = ev.limit(1).withColumn("ts", F.lit(dt.datetime(2030, 1, 1)).cast(ev.schema["ts"].dataType))
    closing.write.mode("append").parquet(src)
    q.processAllAvailable()
    _drain(q)
    got = {(r["series"], r["episode_start"]) for r in spark.table("alerts").collect()}
    assert want and got == want


def test_foreach_batch_monitoring_from_a_stored_baseline(spark):
    """Rows equal the raw computation per batch; the baseline rows are gone when the stream starts."""
    from contrail.operators import baseline, drift, quality
    ev = spark.read.parquet(f"{SMOKE}/events.parquet").select("value", "user_id", "event_type")
    feats = ["value", "user_id"]
    profile = baseline.save_profile(baseline.baseline_profile(ev.where("value < 60"), feats), _scratch() + "/baseline")
    src, sink = _scratch(), _scratch() + "/monitor"
    parts = [ev.where("value < 50"), ev.where("value >= 50"), ev.where("event_type = 'click'").withColumn("value", F.lit(None).cast("double"))]
    for x in parts:
        x.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = stream.writeStream.foreachBatch(stateful.monitor_batches(profile, feats, sink)).start()
    _drain(q)
    got = {r["batch_id"]: (round(r["mean_psi"], 9), round(r["quality_score"], 9), r["drift_alert"]) for r in spark.read.parquet(sink).collect()}
    base = ev.where("value < 60")
    want = {}
    for i, x in enumerate(parts):
        s = drift.drift_score(drift.psi(base, x, feats)).first()
        want[i] = (round(s["mean_psi"], 9), round(quality.quality_score(x, base, feats).first()["quality_score"], 9), s["alert"])
    assert got == want and want[2][1] < want[0][1]


def test_score_stream_equals_batch(spark):
    from pyspark.ml.regression import LinearRegression

    from contrail.operators import ml
    ev = spark.read.parquet(f"{SMOKE}/events.parquet").select("event_id", "user_id", "value")
    model = ml.fit_pipeline(ev, ml.FeatureSpec(["user_id"], [], "value"),
                            LinearRegression(labelCol="value", solver="normal"))
    src = _scratch()
    ev.write.mode("overwrite").parquet(src)
    q = (stateful.score_stream(model, spark.readStream.schema(ev.schema).parquet(src))
         .writeStream.format("memory").queryName("scored").start())
    _drain(q)
    got = {r["event_id"]: r["PREDICTED_DELAY"] for r in spark.table("scored").collect()}
    want = {r["event_id"]: r["PREDICTED_DELAY"] for r in ml.score(model, ev).collect()}
    assert got == want
