"""Stream operators with state (inventory S1, S2, S7, S8).

* S1: stateless scoring of a stream with a fitted ``PipelineModel``.
* S2: stream-stream left outer join of predictions and late labels, with
  watermarks on both sides and a time bound so join state is dropped.
* S7: "condition held for N windows" alerts with ``applyInPandasWithState``:
  per series the open window counts (bounded by the watermark delay) and
  the current run of breaching windows.
* S8: ``foreachBatch`` monitoring -- drift and quality of every
  micro-batch, appended idempotently by batch id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def score_stream(model, stream: DataFrame, threshold: float = 15.0) -> DataFrame:
    """The batch scorer applied to a stream (stateless)."""
    from contrail.operators.ml import score
    return score(model, stream, threshold)


def join_labels(predictions: DataFrame, labels: DataFrame, max_delay: str = "1 day",
                prediction_watermark: str = "1 hour", label_watermark: str = "1 hour") -> DataFrame:
    """Left outer stream-stream join on request id.

    A label counts when it arrives within ``max_delay`` after its
    prediction; predictions without a label are emitted with nulls once the
    watermark passes prediction time + max_delay.  Labels later than that
    are dropped (the reference accepts them for ever)."""
    p = predictions.withColumn("timestamp", F.col("timestamp").cast("timestamp")) \
        .withWatermark("timestamp", prediction_watermark)
    lab = (labels.withColumnRenamed("request_id", "label_request_id")
           .withColumn("label_timestamp", F.col("label_timestamp").cast("timestamp"))
           .withWatermark("label_timestamp", label_watermark))
    cond = ((F.col("request_id") == F.col("label_request_id"))
            & (F.col("label_timestamp") >= F.col("timestamp"))
            & (F.col("label_timestamp") <= F.col("timestamp") + F.expr(f"INTERVAL {max_delay}")))
    return p.join(lab, cond, "leftOuter").drop("label_request_id")


ALERT_SCHEMA = "series string, episode_start timestamp, fires_at timestamp, breach_windows long"
ALERT_STATE = ("open_idx array<long>, open_cnt array<long>, run_start long, run_len long, "
               "last_idx long, fired boolean")
_NO_WINDOW = -(2 ** 62)


def _alert_fn(threshold: float, width_s: int, min_windows: int):
    width_ms = width_s * 1000

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        if state.exists:
            open_idx, open_cnt, run_start, run_len, last_idx, fired = state.get
            counts = dict(zip(open_idx, open_cnt))
        else:
            counts, run_start, run_len, last_idx, fired = {}, -1, 0, _NO_WINDOW, False
        if not state.hasTimedOut:
            # Arrow chunks are folded one at a time into per-window counts,
            # so a hot series never has to sit in memory as raw rows.
            for pdf in pdfs:
                for idx, c in (pdf["_t"] // width_ms).value_counts().items():
                    if idx > last_idx:                      # older windows are closed: late rows drop
                        counts[int(idx)] = counts.get(int(idx), 0) + int(c)
        wm = state.getCurrentWatermarkMs()
        out = []
        for idx in sorted(k for k in counts if (k + 1) * width_ms <= wm):
            c = counts.pop(idx)
            if c > threshold:
                if run_len > 0 and idx == last_idx + 1:
                    run_len += 1
                else:
                    run_start, run_len, fired = idx, 1, False
                if run_len >= min_windows and not fired:
                    out.append((str(key[0]), pd.Timestamp(run_start * width_s, unit="s"),
                                pd.Timestamp((run_start + min_windows) * width_s, unit="s"), int(run_len)))
                    fired = True
            else:
                run_start, run_len, fired = -1, 0, False
            last_idx = idx
        state.update((list(counts), [counts[k] for k in counts], int(run_start), int(run_len),
                      int(last_idx), bool(fired)))
        if counts:
            state.setTimeoutTimestamp(max((k + 1) * width_ms for k in counts))
        if out:
            yield pd.DataFrame(out, columns=["series", "episode_start", "fires_at", "breach_windows"])
    return fn


def breach_alerts(events: DataFrame, series: str, ts: str, threshold: float, window_seconds: int,
                  min_windows: int, watermark: str = "1 hour") -> DataFrame:
    """S7 (stream): one alert row when a series has more than ``threshold``
    events in each of ``min_windows`` consecutive tumbling windows.

    ``applyInPandasWithState`` keeps per series only the still-open window
    counts and the current run; windows close when the watermark passes
    their end (event-time timeout), so quiet series still close windows.
    Equivalent to ``windows.breach_episodes`` over ``windows.event_rate``."""
    ev = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    prepared = ev.select(F.col(series).cast("string").alias("series"), F.col(ts),
                         F.floor(F.unix_micros(F.col(ts)) / 1000).cast("long").alias("_t"))
    return prepared.groupBy("series").applyInPandasWithState(
        _alert_fn(threshold, window_seconds, min_windows), ALERT_SCHEMA, ALERT_STATE,
        "append", GroupStateTimeout.EventTimeTimeout)


def monitor_batches(profile: DataFrame, features, sink_path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing one monitoring row per
    micro-batch (mean PSI and data quality against a stored baseline profile).
    A batch is read once and the raw baseline never.  Rows are keyed by batch
    id and written with dynamic partition overwrite, so a retried batch
    replaces its own row."""
    from contrail.operators import drift

    def run(batch: DataFrame, batch_id: int) -> None:
        row = drift.monitor_batch(profile, batch, features).where("n_rows > 0").select(
            F.lit(int(batch_id)).cast("long").alias("batch_id"), "mean_psi", "features_checked",
            F.col("alert").alias("drift_alert"), "quality_score")
        (row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(sink_path))
    return run
