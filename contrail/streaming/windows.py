"""Windowed monitoring operators (inventory S3-S7).

Each function takes a batch *or* streaming DataFrame: the same
``groupBy(window(...))`` plan runs in both modes.  For streams pass a
``watermark`` so state for closed windows is dropped and append mode can
emit them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.features import DELAY_THRESHOLD, delay_flag
from contrail.operators.baseline import SIGMAS
from contrail.operators.drift import PSI_EPS, PSI_MIN_VALUES

# The latency histogram buckets (seconds) of the reference.
LATENCY_BUCKETS = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def _wm(df: DataFrame, ts: str, watermark: str | None) -> DataFrame:
    """Watermarks need a zone-aware TIMESTAMP; a TIMESTAMP_NTZ event time is
    read as session-time-zone (UTC) time first."""
    if not watermark:
        return df
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, watermark)


def volume(df: DataFrame, ts: str, window: str = "1 minute", watermark: str | None = None,
           keys: Sequence[str] = ()) -> DataFrame:
    """S3: rows per tumbling window (and keys)."""
    return (_wm(df, ts, watermark).groupBy(F.window(ts, window).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n"))


def class_ratio(df: DataFrame, ts: str, value: str, window: str = "1 hour", slide: str = "10 minutes",
                threshold: float = DELAY_THRESHOLD, watermark: str | None = None) -> DataFrame:
    """Delayed / on-time counts and the delayed ratio over sliding windows."""
    flag = delay_flag(value, threshold)
    return (_wm(df, ts, watermark).groupBy(F.window(ts, window, slide).alias("w"))
            .agg(F.count(F.lit(1)).alias("total"), F.sum(flag).cast("bigint").alias("delayed"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "total", "delayed", (F.col("total") - F.col("delayed")).alias("on_time"),
                    (F.col("delayed") / F.col("total")).alias("delayed_ratio")))


def histogram_quantile(q: float, cum: Sequence[Column], bounds: Sequence[float], total: Column) -> Column:
    """Quantile from cumulative bucket counts (Prometheus rules): find the
    first bucket whose cumulative count reaches q * total and interpolate
    linearly inside it (lower bound 0 for the first bucket); in the +Inf
    bucket return the highest finite bound; no observations -> null."""
    rank = F.lit(q) * total
    expr = F.lit(float(bounds[-1]))  # +Inf bucket
    for i in reversed(range(len(bounds))):
        lo = 0.0 if i == 0 else float(bounds[i - 1])
        c_lo = F.lit(0) if i == 0 else cum[i - 1]
        width = cum[i] - c_lo
        interp = F.lit(lo) + (F.lit(float(bounds[i])) - lo) * F.try_divide(rank - c_lo, width)
        expr = F.when(cum[i] >= rank, interp).otherwise(expr)
    return F.when(total > 0, expr)


def latency_quantiles(df: DataFrame, ts: str, latency: str, window: str = "5 minutes",
                      quantiles: Sequence[float] = (0.5, 0.95, 0.99),
                      buckets: Sequence[float] = LATENCY_BUCKETS, watermark: str | None = None) -> DataFrame:
    """Per window the cumulative bucket counts (one aggregate, so it
    is a single stateful operator in a stream) and p50 / p95 / p99 by
    bucket interpolation."""
    aggs = [F.count_if(F.col(latency) <= b).alias(f"le_{i}") for i, b in enumerate(buckets)]
    agg = (_wm(df, ts, watermark).groupBy(F.window(ts, window).alias("w"))
           .agg(F.count(F.lit(1)).alias("total"), *aggs))
    cum = [F.col(f"le_{i}") for i in range(len(buckets))]
    return agg.select(F.col("w.start").alias("window_start"), "total",
                      *[histogram_quantile(q, cum, buckets, F.col("total")).alias(f"p{int(round(q * 100))}")
                        for q in quantiles])


def event_rate(df: DataFrame, ts: str, key: str, window: str = "5 minutes",
               window_seconds: float = 300.0, watermark: str | None = None, slide: str | None = None) -> DataFrame:
    """Events per second per key over tumbling windows, or windows that advance by ``slide``."""
    return (_wm(df, ts, watermark).groupBy(F.window(ts, window, slide or window).alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), key, "n",
                    (F.col("n") / F.lit(window_seconds)).alias("rate_per_s")))


def profile_windows(df: DataFrame, ts: str, profile: DataFrame, features: Sequence[str], window: str = "1 day",
                    watermark: str | None = None, min_values: int = PSI_MIN_VALUES) -> DataFrame:
    """Mean PSI and data quality per window against a stored baseline profile (G7 and C7 over time).

    The profile's rows (one per feature) become literals of one aggregate, so
    the same plan runs on a stream: bin counts, non-null cells and values in
    range of all features in a single stateful operator.
    """
    base = {r["col_name"]: r for r in profile.collect() if r["col_name"] in features}
    cells = [c for c in df.columns if c != ts]
    aggs = [F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"_has_{i}") for i, c in enumerate(cells)]]
    psi, valid = [], []
    for i, c in enumerate(features):
        if c not in base:
            continue
        b, v = base[c], F.col(c).cast("double")
        edges, std = b["edges"], (b["m2"] / b["n"]) ** 0.5
        aggs += [F.count(v).alias(f"_n_{i}"), F.count_if(v.between(b["mean"] - SIGMAS * std, b["mean"] + SIGMAS * std)).alias(f"_in_{i}")]
        terms = []
        for j, (lo, hi) in enumerate(zip(edges, edges[1:])):
            inside = (v >= lo) & ((v <= hi) if j == len(edges) - 2 else (v < hi))
            aggs.append(F.count_if(inside).alias(f"_c_{i}_{j}"))
            e = max(b["counts"][j] / b["n"], PSI_EPS)
            a = F.greatest(F.try_divide(F.col(f"_c_{i}_{j}"), F.col(f"_n_{i}")), F.lit(PSI_EPS))
            terms.append((a - e) * F.log(a / e))
        psi.append(F.when(F.col(f"_n_{i}") >= min_values, sum(terms, F.lit(0.0))))
        valid.append(F.try_divide(F.col(f"_in_{i}"), F.col(f"_n_{i}")))

    def mean(parts, otherwise):
        known = sum((F.when(p.isNotNull(), 1).otherwise(0) for p in parts), F.lit(0))
        return F.coalesce(F.try_divide(sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0)), known), F.lit(otherwise))
    one = _wm(df, ts, watermark).groupBy(F.window(ts, window).alias("w")).agg(*aggs)
    complete = sum((F.col(f"_has_{i}") for i in range(len(cells))), F.lit(0)) / (F.col("n_rows") * len(cells))
    return one.select(F.col("w.start").alias("window_start"), "n_rows", mean(psi, 0.0).alias("mean_psi"),
                      (0.5 * complete + 0.5 * mean(valid, 1.0)).alias("quality_score"))


def breach_episodes(per_window: DataFrame, series: Sequence[str], start: str, metric: str,
                    threshold: float, window_seconds: int, min_windows: int) -> DataFrame:
    """S7 (batch): an alert fires when ``metric > threshold`` holds for at
    least ``min_windows`` consecutive windows ("for: N minutes").

    Gaps-and-islands: breaching windows get index = start / width; index
    minus row_number is constant along a run.  The window function sorts
    pre-aggregated windows per series (bounded by span / width), not rows.
    """
    idx = (F.unix_seconds(F.col(start).cast("timestamp")) / window_seconds).cast("bigint")
    b = per_window.where(F.col(metric) > threshold).withColumn("_idx", idx)
    w = Window.partitionBy(*series).orderBy("_idx")
    runs = b.withColumn("_island", F.col("_idx") - F.row_number().over(w))
    return (runs.groupBy(*series, "_island")
            .agg(F.min(start).alias("episode_start"), F.max(start).alias("last_window_start"),
                 F.count(F.lit(1)).alias("breach_windows"), F.max(metric).alias("peak"))
            .where(F.col("breach_windows") >= min_windows)
            .withColumn("fires_at", F.col("episode_start")
                        + F.expr(f"INTERVAL {window_seconds * min_windows} SECONDS"))
            .drop("_island"))
