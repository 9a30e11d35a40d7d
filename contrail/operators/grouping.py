"""Group statistics joined back as features (inventory E1-E4, E16, D7).

All of these are single-pass hash aggregates with partial (map-side)
aggregation, so a key holding a third of the rows is pre-combined in every
task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.features import DELAY_THRESHOLD, delay_flag, route_key
from contrail.session import cut_lineage, stored


def group_delay_stats(df: DataFrame, keys: Sequence[str], target: str,
                      prefix: str, threshold: float = DELAY_THRESHOLD,
                      with_std: bool = True, with_rate: bool = True) -> DataFrame:
    """Per group mean, sample std (ddof 1; one row -> null) and rate
    of target > threshold (null target counts as not delayed, but is
    excluded from mean and std as pandas does)."""
    aggs = [F.avg(target).alias(f"{prefix}_avg_delay")]
    if with_std:
        aggs.append(F.stddev_samp(target).alias(f"{prefix}_std_delay"))
    if with_rate:
        aggs.append(F.avg(delay_flag(target, threshold)).alias(f"{prefix}_delay_rate"))
    return df.groupBy(*keys).agg(*aggs)


def route_stats(df: DataFrame, origin: str, dest: str, target: str,
                name: str = "route") -> DataFrame:
    """Route key origin_dest and its mean target."""
    return (df.withColumn(name, route_key(origin, dest))
            .groupBy(name).agg(F.avg(target).alias(f"{name}_avg_delay"),
                               F.count(F.lit(1)).alias(f"{name}_flights")))


def with_group_stats(df: DataFrame, origin: str, carrier: str, dest: str,
                     target: str, threshold: float = DELAY_THRESHOLD) -> DataFrame:
    """E1-E3 joined back to every row (D7), the reference's three merges.

    The rows are aggregated by carrier and by (origin, dest), from which the
    origins and routes are rolled up; a carrier crossed with all its locations
    would leave nearly as many groups as rows.  The three tables are stored, so
    their sizes are known when the joins are planned: rows are shuffled only for
    a table too large to broadcast."""
    from contrail.operators.joins import attach_group_stats
    x = F.col(target).cast("double")

    def sums(*keys):
        return df.groupBy(*keys).agg(F.count(x).alias("_n"), F.sum(x).alias("_s"), F.sum(x * x).alias("_ss"),
                                     F.sum(delay_flag(target, threshold)).alias("_late"), F.count(F.lit(1)).alias("_rows"))

    n, s, ss = F.sum("_n"), F.sum("_s"), F.sum("_ss")
    mean = F.try_divide(s, n)
    std = F.when(n > 1, F.sqrt(F.greatest((ss - s * s / n) / (n - 1), F.lit(0.0))))
    rate = F.sum("_late") / F.sum("_rows")
    pairs = stored(sums(origin, dest))
    o = pairs.groupBy(origin).agg(mean.alias("origin_avg_delay"), std.alias("origin_std_delay"), rate.alias("origin_delay_rate"))
    a = sums(carrier).select(carrier, F.try_divide("_s", "_n").alias("carrier_avg_delay"), (F.col("_late") / F.col("_rows")).alias("carrier_delay_rate"))
    r = pairs.withColumn("route", route_key(origin, dest)).groupBy("route").agg(mean.alias("route_avg_delay"))
    out = attach_group_stats(df, stored(o), [origin])
    out = attach_group_stats(out, stored(a), [carrier])
    out = out.withColumn("route", route_key(origin, dest))
    return attach_group_stats(out, stored(r), ["route"])


def leakage_safe_stats(df: DataFrame, key: str, date: str, target: str,
                       prefix: str, threshold: float = DELAY_THRESHOLD) -> DataFrame:
    """For every (key, date) the statistics of strictly earlier dates.

    Pre-aggregates to one row per (key, date) first, so the window sorts
    distinct dates per key, not rows: a hot key costs its number of dates.
    Std from sums of squares (sample, ddof 1), clamped at 0.
    """
    daily = (df.groupBy(key, date)
             .agg(F.count(target).alias("_n"), F.sum(target).alias("_s"),
                  F.sum(F.col(target) * F.col(target)).alias("_ss"),
                  F.sum(delay_flag(target, threshold)).alias("_late"),
                  F.count(F.lit(1)).alias("_rows")))
    w = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    n = F.sum("_n").over(w)
    s = F.sum("_s").over(w)
    ss = F.sum("_ss").over(w)
    late = F.sum("_late").over(w)
    rows = F.sum("_rows").over(w)
    var = (ss - s * s / n) / (n - 1)
    return daily.select(
        key, date,
        F.coalesce(n, F.lit(0)).alias(f"{prefix}_prior_n"),
        F.when(n > 0, s / n).alias(f"{prefix}_prior_avg"),
        F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).alias(f"{prefix}_prior_std"),
        F.when(rows > 0, late / rows).alias(f"{prefix}_prior_rate"),
    )


def relative_frequency(df: DataFrame, col: str, name: str = "share") -> DataFrame:
    """Value -> share of non-null rows (``value_counts(normalize=True)``).

    ``df`` is read once; the denominator is a scalar summed from the counts, so
    no global window funnels the (possibly many) categories through one task."""
    counts = cut_lineage(df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 1
    return counts.select(col, "n", (F.col("n") / F.lit(float(total))).alias(name))
