"""Late labels on a stream: order, batching, sessions, timers and the chained accuracy windows."""

import datetime as dt
import itertools
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from contrail.operators import feedback
from contrail.streaming import feedback as S

from paths import SMOKE

T0 = dt.datetime(2024, 1, 1)
H = dt.timedelta(hours=1)
EVENTS = "request_id string, us long, seq long, is_label boolean, prediction double, features string, model_version string, actual_delay double, user_feedback string"


def us(hours):
    return int((T0 + hours * H - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))


def pred(rid, hours, value, seq=0):
    return (rid, us(hours), seq, False, value, "{}", "v1", None, None)


def label(rid, hours, value, seq=0):
    return (rid, us(hours), seq, True, None, None, None, value, "ok")


@pytest.fixture(scope="module", autouse=True)
def rocksdb(spark):
    S.use_rocksdb(spark)


def run(spark, batches, gap_hours, shape=lambda x: x, watermark="1 hour"):
    """Feeds the batches one after another; returns the emitted rows."""
    src, out, state = (tempfile.mkdtemp(prefix="contrail-fb-") for _ in range(3))
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(src)
    changes = shape(S.feedback_changes(stream, gap_hours * 3600, watermark))
    q = changes.writeStream.outputMode("append").option("checkpointLocation", state).format("parquet").option("path", out).start()
    try:
        for rows in batches:
            spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(src)
            q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.schema(changes.schema).parquet(out)


def labels_of(df):
    return {r.request_id: (r.prediction, r.actual_delay) for r in S.latest_feedback(df).collect()}


def test_upsert_rules_in_any_order(spark):
    events = [pred("reinsert", 0, 1.0), label("reinsert", 1, 9.0), pred("reinsert", 2, 2.0),
              pred("last", 0, 1.0), label("last", 1, 5.0), label("last", 3, 6.0), label("last", 2, 7.0),
              label("unknown", 1, 5.0), pred("unlabelled", 1, 3.0),
              pred("tie", 1, 1.0, 1), pred("tie", 1, 2.0, 2), label("tie", 1, 8.0, 3)]
    want = {"reinsert": (2.0, None), "last": (1.0, 6.0), "unlabelled": (3.0, None), "tie": (2.0, 8.0)}
    assert {r.request_id: (r.prediction, r.actual_delay) for r in S.feedback_sessions(spark.createDataFrame(events, EVENTS), 86400).collect()} == want
    random.Random(1).shuffle(events)
    assert labels_of(run(spark, [events], 24)) == want
    assert labels_of(run(spark, [events[:4], events[4:5], events[5:]], 24, watermark="10 days")) == want


def test_sessions_close_by_timer_and_later_labels_have_no_effect(spark):
    batches = [[pred("a", 0, 1.0), label("a", 1, 4.0), pred("b", 0, 1.0)], [pred("far", 100, 0.0)],
               [label("b", 101, 5.0), pred("a", 102, 7.0)], [pred("far", 300, 0.0)], [pred("far", 301, 0.0)]]
    out = run(spark, batches, 5)
    finals = {(r.request_id, r.prediction, r.actual_delay, r.closed_at) for r in out.where("final").collect()}
    assert finals == {("a", 1.0, 4.0, T0 + 6 * H), ("b", 1.0, None, T0 + 5 * H), ("a", 7.0, None, T0 + 107 * H), ("far", 0.0, None, T0 + 105 * H)}
    batch = S.feedback_sessions(spark.createDataFrame([r for b in batches for r in b], EVENTS), 5 * 3600)
    assert finals == {(r.request_id, r.prediction, r.actual_delay, r.closed_at) for r in batch.where(F.col("closed_at") < T0 + 290 * H).collect()}


def brute_sessions(events, gap):
    out = []
    for rid, rows in itertools.groupby(sorted(events, key=lambda r: (r[0], r[1], r[2])), key=lambda r: r[0]):
        sessions, last = [], None
        for r in rows:
            if last is None or r[1] - last > gap:
                sessions.append([])
            sessions[-1].append(r)
            last = r[1]
        for s in sessions:
            p = [r for r in s if not r[3]]
            if p:
                lab = [r for r in s if r[3] and r[1] >= p[-1][1]]
                out.append((rid, p[-1][4], lab[-1][7] if lab else None, s[-1][1] + gap))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [0, 1])
def test_batch_and_stream_equal_a_scan_in_order(spark, seed):
    rng = random.Random(seed)
    events = []
    for n in range(300):
        rid, hours = rng.choice(["hot"] * 8 + ["x", "y", "z"]), rng.randrange(0, 200)
        events.append(label(rid, hours, float(n), n) if rng.random() < 0.5 else pred(rid, hours, float(n), n))
    gap = 3 * 3_600_000_000
    want = brute_sessions(events, gap)
    got = S.feedback_sessions(spark.createDataFrame(events, EVENTS).repartition(5), 3 * 3600)
    assert sorted(((r.request_id, r.prediction, r.actual_delay, us(0) + int((r.closed_at - T0) / dt.timedelta(microseconds=1))) for r in got.collect()), key=repr) == want
    events.sort(key=lambda r: r[1])
    batches = [events[:100], events[100:190], events[190:], [pred("zz", 900, 0.0)], [pred("zz", 901, 0.0)]]
    out = run(spark, batches, 3).where("final AND request_id <> 'zz'")
    assert sorted(((r.request_id, r.prediction, r.actual_delay, us(0) + int((r.closed_at - T0) / dt.timedelta(microseconds=1))) for r in out.collect()), key=repr) == want


def test_accuracy_windows_behind_the_state_machine(spark):
    rng = random.Random(3)
    events = []
    for n in range(120):
        hours = n
        events += [pred(f"r{n}", hours, float(rng.randrange(50)), 2 * n), label(f"r{n}", hours + rng.choice([0, 1, 2]), float(rng.randrange(50)), 2 * n + 1)]
    events.sort(key=lambda r: r[1])
    batches = [events[:80], events[80:], [pred("zz", 2000, 0.0)], [pred("zz", 4000, 0.0)], [pred("zz", 4001, 0.0)]]
    stream = run(spark, batches, 4, lambda c: S.accuracy_windows(c.where("final"), "1 day"))
    batch = S.accuracy_windows(S.feedback_sessions(spark.createDataFrame(events, EVENTS), 4 * 3600), "1 day")
    rows = lambda d: {r.window_start: (r.n, round(r.r2_score, 9), round(r.mae, 9)) for r in d.collect()}
    assert len(rows(batch)) >= 5 and rows(stream) == rows(batch)


def test_drained_stream_equals_the_feedback_table(spark):
    ev = spark.read.parquet(f"{SMOKE}/events.parquet")
    p = ev.where("event_type <> 'purchase'").selectExpr("user_id AS request_id", "props AS features", "value AS prediction", "'v1' AS model_version", "ts AS timestamp", "event_id")
    lab = ev.where("event_type = 'purchase'").selectExpr("user_id AS request_id", "value AS actual_delay", "event_type AS user_feedback", "ts AS label_timestamp", "event_id AS label_event_id")
    want = feedback.feedback_table(p, lab, tiebreak="event_id", label_tiebreak="label_event_id")
    events = S.feedback_events(p, lab, "event_id", "label_event_id").collect()
    events.sort(key=lambda r: r.us)
    third = len(events) // 3
    got = S.latest_feedback(run(spark, [events[:third], events[third:2 * third], events[2 * third:]], 24 * 400))
    rows = lambda d, seq: sorted((str(r.request_id), r.prediction, r.actual_delay, r.user_feedback, r[seq]) for r in d.collect())
    assert repr(rows(got, "seq")) == repr(rows(want, "event_id"))


def test_small_batches_are_summarised_together():
    """A request costs the state machine a summary per bucket, not one per Arrow batch of a task."""
    import pandas as pd
    names = [c.split()[0] for c in EVENTS.split(", ")]
    frames = [pd.DataFrame([pred(r, n, float(n), n) if n % 2 else label(r, n, float(n), n) for r in "abc"], columns=names) for n in range(10)]
    got = pd.concat(S._summarised(24 * 3_600_000_000)(iter([*frames, frames[0].iloc[:0]])))
    assert sorted(got["request_id"]) == ["a", "b", "c"]
    assert (got["start_us"] == us(0)).all() and (got["end_us"] == us(9)).all() and (got["prediction"] == 9.0).all() and (got["actual_delay"] == 8.0).all()


def test_state_machine_returns_rows():
    """A request costs rows, not a data frame that becomes an Arrow batch of its own."""
    out = list(S.FeedbackMachine(1)._out(("a",), [(0, 5, 0, 1, 1.0, "{}", "v", 5, 2, 2.0, "ok", 2), (0, 5, S._NONE, S._NONE, None, None, None, 5, 2, 2.0, "ok", 1)], True))
    assert [(r.request_id, r.prediction, r.seq, r.actual_delay, r.merged, r.final) for r in out] == [("a", 1.0, 1, 2.0, 2, True)]
