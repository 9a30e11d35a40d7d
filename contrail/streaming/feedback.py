"""Late labels on a stream with upsert semantics (inventory S2, I1, I2).

Predictions and labels form one event log.  A request's events belong to one
*session* while no two neighbours are more than ``gap_seconds`` apart; within a
session the latest prediction wins, the latest label wins, and a label older
than the latest prediction was cleared by the re-insert.  A session without a
prediction (label of an unknown id) has no row.  "Latest" and "session" are
both merges that neither order nor batching changes, so the batch form, the
stream and any split of it into micro-batches agree.

* ``feedback_sessions`` -- batch: events are first summarised per (request,
  time bucket) with map-side combine, so a request with a third of all events
  is spread over its buckets; sessions are then gaps between summaries.
* ``feedback_changes`` -- stream: each partition summarises its rows the same
  way, ``CHUNK`` at a time, then a keyed state machine (``transformWithState``
  over rows, as a data frame per request costs more than the merge; list state
  and event-time timers) merges them.  It emits a row per change and a final row
  when the watermark closes the session; the state is dropped then.
* ``accuracy_windows`` -- MAE and R2 per window of closing time, chained
  behind either.

The state machine needs the RocksDB state store (``use_rocksdb``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from contrail.operators.metrics import metric_aggs

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PREDICTION = "prediction double, features string, model_version string"
LABEL = "actual_delay double, user_feedback string"
_P = [c.split()[0] for c in PREDICTION.split(", ")]
_L = [c.split()[0] for c in LABEL.split(", ")]
# A summary: first and last event, latest prediction and latest label with their order (time in
# microseconds, then sequence number), and how many summaries it was merged from.
_SUMMARY = f"start_us long, end_us long, p_us long, p_seq long, {PREDICTION}, l_us long, l_seq long, {LABEL}, merged long"
_FIELDS = [c.split()[0] for c in _SUMMARY.split(", ")]
_START, _END, _PU, _LU = (_FIELDS.index(c) for c in ("start_us", "end_us", "p_us", "l_us"))
# Stands for a missing time or sequence number: pandas would turn a long column with nulls into doubles.
_NONE = -(1 << 62)
_P_AT, _L_AT = slice(_PU, _PU + 2 + len(_P)), slice(_LU, _LU + 2 + len(_L))
CHUNK = 100_000   # events that are summarised at once
MERGED = 1_000    # summaries of a request that are merged at once
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)
CHANGES = f"request_id string, {PREDICTION}, timestamp timestamp, seq long, {LABEL}, closed_at timestamp, merged long, final boolean"
_CHANGE = Row(*[c.split()[0] for c in CHANGES.split(", ")])


def use_rocksdb(spark: SparkSession) -> None:
    """State machines with timers and list state need the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def feedback_events(predictions: DataFrame, labels: DataFrame, tiebreak: str, label_tiebreak: str) -> DataFrame:
    """The two logs as one: ``request_id, us, seq, is_label`` and the payload of either kind."""
    def us(c):
        return F.unix_micros(F.col(c).cast("timestamp")).alias("us")
    nulls = lambda kinds: [F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in kinds.split(", "))]
    kept = lambda kinds: [F.col(c).cast(t).alias(c) for c, t in (x.split() for x in kinds.split(", "))]
    rid = F.col("request_id").cast("string").alias("request_id")
    p = predictions.select(rid, us("timestamp"), F.coalesce(F.col(tiebreak).cast("long"), F.lit(_NONE)).alias("seq"), F.lit(False).alias("is_label"), *kept(PREDICTION), *nulls(LABEL))
    lab = labels.select(rid, us("label_timestamp"), F.coalesce(F.col(label_tiebreak).cast("long"), F.lit(_NONE)).alias("seq"), F.lit(True).alias("is_label"), *nulls(PREDICTION), *kept(LABEL))
    return p.unionByName(lab).where("us IS NOT NULL")


def _latest(label: bool):
    rows = F.col("is_label") == label
    names = _L if label else _P
    return F.max_by(F.struct(F.col("us"), F.col("seq"), *names), F.when(rows, F.struct("us", "seq")))


def feedback_sessions(events: DataFrame, gap_seconds: int) -> DataFrame:
    """Batch form: one row per session with a prediction, closed ``gap_seconds`` after its last event."""
    gap = gap_seconds * 1_000_000
    summary = events.groupBy("request_id", F.expr(f"us div {gap}").alias("bucket")).agg(
        F.min("us").alias("start_us"), F.max("us").alias("end_us"), _latest(False).alias("p"), _latest(True).alias("l"))
    per_id = Window.partitionBy("request_id").orderBy("start_us")
    apart = F.col("start_us") - F.lag("end_us").over(per_id) > gap
    island = summary.withColumn("apart", F.coalesce(apart.cast("int"), F.lit(0))).withColumn("session", F.sum("apart").over(per_id))
    one = island.groupBy("request_id", "session").agg(F.max("end_us").alias("end_us"), F.max_by("p", F.struct("p.us", "p.seq")).alias("p"), F.max_by("l", F.struct("l.us", "l.seq")).alias("l"))
    keep = F.col("l.us") >= F.col("p.us")
    return one.where("p IS NOT NULL").select(
        "request_id", *[F.col(f"p.{c}") for c in _P], F.timestamp_micros("p.us").alias("timestamp"), F.when(F.col("p.seq") != _NONE, F.col("p.seq")).alias("seq"),
        *[F.when(keep, F.col(f"l.{c}")).alias(c) for c in _L], F.timestamp_micros(F.col("end_us") + gap).alias("closed_at"))


def _summarised(gap: int):
    """Latest rows and time range per (request, bucket) of each ``CHUNK`` events."""
    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for rows in batches:
            if len(rows):
                held.append(rows)
            if sum(map(len, held)) >= CHUNK:
                yield pd.concat(held, ignore_index=True)
                held = []
        if held:
            yield pd.concat(held, ignore_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in chunks(batches):
            rows = rows.assign(bucket=rows["us"] // gap).sort_values(["us", "seq"])
            key = ["request_id", "bucket"]
            out = rows.groupby(key, dropna=False).agg(start_us=("us", "min"), end_us=("us", "max"))
            for prefix, names, part in (("p", _P, rows[~rows["is_label"]]), ("l", _L, rows[rows["is_label"]])):
                last = part.drop_duplicates(key, keep="last").set_index(key)
                out = out.join(last[names])
                for c in ("us", "seq"):
                    out[f"{prefix}_{c}"] = last[c].reindex(out.index, fill_value=_NONE)
            out = out.assign(merged=1, ts=pd.to_datetime(out["end_us"], unit="us")).reset_index()
            yield out[["request_id", "ts", *_FIELDS]]
    return run


def merge_summaries(rows: list[tuple], gap: int) -> list[tuple]:
    """Summaries of one request merged into sessions, in time order."""
    out: list[tuple] = []
    for row in sorted(rows, key=lambda r: (r[_START], r[_END])):
        if out and row[_START] - out[-1][_END] <= gap:
            have = out[-1]
            p = max(have, row, key=lambda r: r[_PU:_PU + 2])[_P_AT]
            lab = max(have, row, key=lambda r: r[_LU:_LU + 2])[_L_AT]
            out[-1] = (have[_START], max(have[_END], row[_END]), *p, *lab, have[-1] + row[-1])
        else:
            out.append(row)
    return out


def _timestamp(us: int) -> dt.datetime:
    return _EPOCH + dt.timedelta(microseconds=us)


class FeedbackMachine(StatefulProcessor):
    """Open sessions of a request; a timer per session closes it."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getListState("sessions", _SUMMARY)

    def _closing_ms(self, row: tuple) -> int:
        return -(-(row[_END] + self.gap) // 1000)

    def _out(self, key, rows: list[tuple], final: bool) -> Iterator[Row]:
        for r in rows:
            if r[_PU] == _NONE:
                continue  # only labels: the id is unknown
            keep = r[_LU] >= r[_PU]
            label = r[_LU + 2: _LU + 2 + len(_L)] if keep else (None,) * len(_L)
            yield _CHANGE(key[0], *r[_PU + 2: _PU + 2 + len(_P)], _timestamp(r[_PU]), None if r[_PU + 1] == _NONE else r[_PU + 1], *label, _timestamp(self._closing_ms(r) * 1000), r[-1], final)

    def handleInputRows(self, key, rows, timerValues):
        held = [tuple(r) for r in self.sessions.get()]
        before = set(held)
        new = (tuple(r[c] for c in _FIELDS) for r in rows)
        while part := list(islice(new, MERGED)):
            held = merge_summaries(held + part, self.gap)
        self.sessions.put(held)
        for ms in {self._closing_ms(r) for r in held}:
            self.handle.registerTimer(ms)
        yield from self._out(key, [r for r in held if r not in before], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = [tuple(r) for r in self.sessions.get()]
        closed = [r for r in held if self._closing_ms(r) <= expiredTimerInfo.getExpiryTimeInMs()]
        left = [r for r in held if r not in closed]
        self.sessions.put(left) if left else self.sessions.clear()
        yield from self._out(key, closed, True)

    def close(self) -> None:
        pass


def feedback_changes(events: DataFrame, gap_seconds: int, watermark: str = "1 hour") -> DataFrame:
    """Stream form: ``CHANGES`` rows, ``final`` when a session closed.

    Events later than the watermark allows are dropped; a label that comes
    after its session closed finds no prediction and has no effect."""
    gap = gap_seconds * 1_000_000
    rows = events.mapInPandas(_summarised(gap), f"request_id string, ts timestamp, {_SUMMARY}")
    return rows.withWatermark("ts", watermark).groupBy("request_id").transformWithState(
        FeedbackMachine(gap), CHANGES, "Append", "EventTime", eventTimeColumnName="closed_at")


def latest_feedback(changes: DataFrame) -> DataFrame:
    """The feedback table of a drained change log: the last state of each request."""
    names = [*_P, "timestamp", "seq", *_L]
    last = changes.groupBy("request_id").agg(F.max_by(F.struct(*names), F.struct("closed_at", "merged", "final")).alias("r"))
    return last.select("request_id", "r.*")


def accuracy_windows(sessions: DataFrame, window: str = "1 day") -> DataFrame:
    """n, R2, MAE, RMSE and MSE of the labelled sessions per window of closing time (batch or stream)."""
    rows = sessions.where(F.col("actual_delay").isNotNull() & F.col("prediction").isNotNull())
    return rows.groupBy(F.window("closed_at", window).alias("w")).agg(*metric_aggs("actual_delay", "prediction")).select(
        F.col("w.start").alias("window_start"), "n", "r2_score", "mae", "rmse", "mse")
