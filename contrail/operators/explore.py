"""Exploratory summaries (inventory E5-E15).

Quantile-based summaries use the distributed order statistics in
``contrail.operators.ordered``; everything else is one aggregate.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.features import DELAY_THRESHOLD, delay_flag
from contrail.operators.ordered import (column_value_counts, quantiles_from_counts, quantiles_long,
                                        unpivot_values)


def safe_name(value: str, prefix: str = "") -> str:
    return prefix + re.sub(r"[^0-9a-zA-Z]+", "_", str(value)).strip("_").lower()


def pivot_daily(long: DataFrame, ts: str, key: str, value: str,
                values: Sequence[str] | None = None, prefix: str = "") -> DataFrame:
    """E5: long feed -> one row per date, one column per reading type with
    the mean reading (timestamp -> date first).

    The types come from the data, so none is left out; a caller may name
    them instead to keep the output width fixed."""
    values = pivot_values(long, key) if values is None else values
    wide = (long.groupBy(F.to_date(F.col(ts)).alias("date"))
            .pivot(key, list(values)).agg(F.avg(value)))
    return wide.select("date", *[F.col(f"`{v}`").alias(safe_name(v, prefix)) for v in values])


MAX_PIVOT_COLUMNS = 10_000   # as Spark's own spark.sql.pivotMaxValues


def pivot_values(df: DataFrame, key: str, most: int = MAX_PIVOT_COLUMNS) -> list:
    """Distinct non-null values of a column that becomes columns, in order; an error beyond ``most``."""
    values = df.select(key).where(F.col(key).isNotNull()).distinct()
    got = sorted(r[0] for r in values.limit(most + 1).collect())
    if len(got) > most:
        raise ValueError(f"{key} has more than {most} distinct values to become columns")
    return got


def class_balance(df: DataFrame, target: str, threshold: float = DELAY_THRESHOLD,
                  name: str = "delayed") -> DataFrame:
    """Rows per delay flag; a null target counts as on time."""
    return df.groupBy(delay_flag(target, threshold).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def named_group_means(df: DataFrame, key: str, target: str, dim: DataFrame,
                      dim_key: str, dim_name: str) -> DataFrame:
    """E7 (+ D8): mean target per group (nulls ignored), left-joined to the
    dimension names, sorted ascending by the mean."""
    means = df.groupBy(key).agg(F.avg(target).alias("mean_value"))
    names = dim.select(F.col(dim_key).alias(key), F.col(dim_name).alias("name"))
    return means.join(names, key, "left").select("name", key, "mean_value").orderBy("mean_value", key)


def frequency(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """E8 long form: counts per combination of ``cols`` (no zero cells)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def crosstab_wide(df: DataFrame, row: str, col: str, col_values: Sequence | None = None) -> DataFrame:
    """E8 wide form (R ``table(a, b)``): one row per ``row`` value, one
    column per ``col`` value, absent cells 0.  The values come from the data unless given."""
    col_values = pivot_values(df, col) if col_values is None else col_values
    wide = df.groupBy(row).pivot(col, list(col_values)).agg(F.count(F.lit(1)))
    return wide.na.fill(0)


def top_k(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """Top-k keys by row count, ties in ascending key order.
    The limit is the feature; the plan is TakeOrderedAndProject."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(key).asc()).limit(k))


SUMMARY_PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """E10 (R ``summary``): min, Q1, median, mean, Q3, max and NA count per
    column -- all from one checkpointed pass of (column, value) counts."""
    counts = column_value_counts(df, columns)
    q = quantiles_from_counts(counts, SUMMARY_PROBS, len(columns))
    wide = (q.groupBy("col_name")
            .agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n)
                   for p, n in zip(SUMMARY_PROBS, ("min", "q1", "median", "q3", "max"))]))
    moments = counts.groupBy("col_name").agg(
        (F.sum(F.col("v") * F.col("n")) / F.sum(F.when(F.col("v").isNotNull(), F.col("n")))).alias("mean"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("na_count"))
    return moments.join(F.broadcast(wide), "col_name", "left").select("col_name", "min", "q1", "median", "mean", "q3", "max",
                                                         "na_count")


# The reference's tail grid, 0..0.9 by 0.1 and 0.9..1.0 by 0.01.
BODY_PROBS = tuple(round(i / 10, 2) for i in range(10))
TAIL_PROBS = tuple(round(0.9 + i / 100, 2) for i in range(11))


def positive_quantiles(df: DataFrame, columns: Sequence[str],
                       probs: Sequence[float] = BODY_PROBS + TAIL_PROBS[1:]) -> DataFrame:
    """Quantiles (type 7) of the strictly positive values of each column."""
    long = unpivot_values(df, columns).where(F.col("v") > 0)
    return quantiles_long(long, ["col_name"], probs, max_groups=len(columns))


def boxplot_stats(df: DataFrame, columns: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """Interpolated quartiles, whiskers = most extreme values inside
    Q1 - 1.5 IQR / Q3 + 1.5 IQR, and the number of values outside them.
    Quartiles, whiskers and outlier counts all come from one checkpointed
    pass of (column, value) counts.

    (R's boxplot uses Tukey hinges; interpolated quartiles are used here.)"""
    counts = column_value_counts(df, columns).where(F.col("v").isNotNull())
    q = quantiles_from_counts(counts, (0.25, 0.5, 0.75), len(columns))
    quart = (q.groupBy("col_name")
             .agg(F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
                  F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
                  F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
             .withColumn("iqr", F.col("q3") - F.col("q1"))
             .withColumn("_lo", F.col("q1") - whisker * F.col("iqr"))
             .withColumn("_hi", F.col("q3") + whisker * F.col("iqr")))
    tagged = counts.join(F.broadcast(quart), "col_name")   # one row per column
    inside = (F.col("v") >= F.col("_lo")) & (F.col("v") <= F.col("_hi"))
    return (tagged.groupBy("col_name", "q1", "median", "q3", "iqr")
            .agg(F.min(F.when(inside, F.col("v"))).alias("lower_whisker"),
                 F.max(F.when(inside, F.col("v"))).alias("upper_whisker"),
                 F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).cast("bigint").alias("outliers")))


def score_summary(scored: DataFrame, prediction: str, threshold: float = DELAY_THRESHOLD) -> DataFrame:
    """Total, delayed (prediction > threshold) and on-time counts."""
    flag = delay_flag(prediction, threshold)
    return scored.agg(F.count(F.lit(1)).alias("total"),
                      F.sum(flag).cast("bigint").alias("delayed"),
                      F.sum(1 - flag).cast("bigint").alias("on_time"))


def label_coverage(feedback: DataFrame, label: str = "actual_delay") -> DataFrame:
    """Total, labelled, round(100 * labelled / max(total, 1), 1)."""
    return feedback.agg(F.count(F.lit(1)).alias("total"), F.count(label).alias("labeled")) \
        .withColumn("coverage_pct",
                    F.round(F.col("labeled") * 100.0 / F.greatest(F.col("total"), F.lit(1)), 1))


def flag_shares(df: DataFrame, flags: dict, distinct: dict | None = None) -> DataFrame:
    """Percentage of rows where each 0/1 flag column (or expression) is 1, and the
    number of distinct non-null values of the columns in ``distinct`` (name -> column)."""
    unique = [F.count_distinct(F.col(c)).alias(k) for k, c in (distinct or {}).items()]
    return df.agg(*unique, *[F.round(F.avg(F.col(v) if isinstance(v, str) else v) * 100.0, 4).alias(k)
                    for k, v in flags.items()])
