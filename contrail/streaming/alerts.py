"""Alerts on conditions that hold for a while (inventory S7), on any windowed metric.

A rule names a metric, a direction, a threshold and for how many consecutive
windows it must hold.  The input is a windowed aggregate -- latency quantiles,
error rate, R2, PSI, quality -- so what reaches a series' task is one row per
window, never raw rows, however hot the series is.

* ``held_alerts`` -- batch: gaps and islands over the window rows.
* ``held_alerts_stream`` -- stream: a state machine chained behind the window
  aggregate (append mode) that keeps the current run of a series.  Windows
  arrive in order because the watermark closes them in order.

Both give a row when a run reaches its length: ``rule, series, episode_start,
fires_at, value`` (the value of the window that fired).  A window without rows
has no metric and ends the run, like a window that breaks the condition; so
does a null metric.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ALERTS = "rule string, series string, episode_start timestamp, fires_at timestamp, value double"


@dataclass(frozen=True)
class Rule:
    name: str
    op: str                # ">" or "<"
    threshold: float
    window_seconds: int
    min_windows: int       # consecutive windows the condition must hold

    def holds(self, metric):
        return metric > self.threshold if self.op == ">" else metric < self.threshold


# The reference's alert rules, as windows of the length each must hold.
RULES = {r.name: r for r in (
    Rule("model_r2", "<", 0.70, 300, 3),
    Rule("prediction_latency_p99", ">", 1.0, 300, 1),
    Rule("prediction_error_rate", ">", 0.1, 300, 1),
    Rule("data_quality", "<", 0.8, 300, 1),
    Rule("drift_psi", ">", 0.5, 300, 1),
)}


def _rows(windows: DataFrame, rule: Rule, metric: str, start: str, series: str | None) -> DataFrame:
    name = F.col(series).cast("string") if series else F.lit("all")
    idx = F.floor(F.unix_seconds(F.col(start).cast("timestamp")) / rule.window_seconds).cast("long")
    return windows.select(F.coalesce(name, F.lit("null")).alias("series"), idx.alias("idx"), F.col(metric).cast("double").alias("value"))


def held_alerts(windows: DataFrame, rule: Rule, metric: str, start: str = "window_start", series: str | None = None) -> DataFrame:
    """Batch form over one row per window (and series)."""
    rows = _rows(windows, rule, metric, start, series).where(F.coalesce(rule.holds(F.col("value")), F.lit(False)))
    order = Window.partitionBy("series").orderBy("idx")
    runs = rows.withColumn("island", F.col("idx") - F.row_number().over(order))
    place = Window.partitionBy("series", "island").orderBy("idx")
    fired = runs.withColumn("n", F.row_number().over(place)).where(F.col("n") == rule.min_windows)
    begin = (F.col("idx") - rule.min_windows + 1) * rule.window_seconds
    return fired.select(F.lit(rule.name).alias("rule"), "series", F.timestamp_seconds(begin).alias("episode_start"),
                        F.timestamp_seconds((F.col("idx") + 1) * rule.window_seconds).alias("fires_at"), "value")


class RunMachine(StatefulProcessor):
    """The current run of windows of a series that hold the condition."""

    def __init__(self, rule: Rule):
        self.rule = rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "last_idx long, length long")

    def handleInputRows(self, key, rows, timerValues):
        last, length = self.run.get() if self.run.exists() else (None, 0)
        seen = pd.concat(list(rows)).sort_values("idx")   # one row per closed window
        width, out = self.rule.window_seconds, []
        for idx, value in zip(seen["idx"].tolist(), seen["value"].tolist()):
            holds = value is not None and value == value and self.rule.holds(value)
            length = 0 if not holds else length + 1 if last is not None and idx == last + 1 else 1
            last = idx
            if length == self.rule.min_windows:
                out.append((self.rule.name, key[0], pd.Timestamp((idx - length + 1) * width, unit="s"), pd.Timestamp((idx + 1) * width, unit="s"), value))
        self.run.update((last, length))
        frame = pd.DataFrame(out, columns=["rule", "series", "episode_start", "fires_at", "value"])
        yield frame.astype({"episode_start": "datetime64[us]", "fires_at": "datetime64[us]", "value": "float64"})

    def close(self) -> None:
        pass


def held_alerts_stream(windows: DataFrame, rule: Rule, metric: str, start: str = "window_start", series: str | None = None) -> DataFrame:
    """Stream form; ``windows`` is a windowed aggregate in append mode (needs ``feedback.use_rocksdb``)."""
    rows = _rows(windows, rule, metric, start, series)
    return rows.groupBy("series").transformWithStateInPandas(RunMachine(rule), ALERTS, "Append", "None")
