"""Distribution drift (inventory G1-G11).

* KS (G1): both samples are unpivoted, collapsed to (column, value) with a
  count per side, and the two empirical CDFs come from the distributed
  running totals of ``ordered.running_totals`` -- no column is ever sorted
  in one task.  The p-value is exact for small samples and the asymptotic
  Kolmogorov series, JVM-side, for others.
* TVD (G2): two relative-frequency tables matched by a full outer join.
* PSI (G6/G7): from a stored baseline profile (``baseline.py``: exact decile
  edges, counts, moments) and the profile of a batch on the same edges.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators import baseline as B
from contrail.operators.ordered import ranged, running_totals, unpivot_values
from contrail.session import cut_lineage

# The reference's drift thresholds.
KS_P_THRESHOLD = 0.05
TVD_THRESHOLD = 0.1
OVERALL_THRESHOLD = 0.3
PSI_BINS = 10
PSI_EPS = 1e-8
PSI_MODERATE = 0.1
PSI_SIGNIFICANT = 0.2
PSI_ALERT = 0.5
PSI_MIN_VALUES = 10
KOLMOGOROV_TERMS = 100


def kolmogorov_pvalue(d: Column, n1: Column, n2: Column) -> Column:
    """Two-sided asymptotic p-value: Q(sqrt(n1 n2 / (n1 + n2)) * D) with
    Q(l) = 2 sum_{k>=1} (-1)^(k-1) exp(-2 k^2 l^2); Q = 1 for l < 0.2."""
    lam = F.sqrt(n1 * n2 / (n1 + n2)) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KOLMOGOROV_TERMS)), F.lit(0.0),
        lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))


EXACT_PRODUCT = 100_000   # sample sizes up to this product get the exact distribution


def exact_ks_p(d: float, n1: int, n2: int) -> float:
    """P(D >= d) of the two-sample statistic under equal continuous distributions: the share of
    lattice paths from (0, 0) to (n1, n2) that touch |i / n1 - j / n2| >= d.  Work n1 * n2."""
    import math

    import numpy as np
    edge = round(d * n1 * n2)   # the statistic is a multiple of 1 / (n1 * n2)
    if edge <= 0:
        return 1.0
    row = (np.arange(n2 + 1) * n1 < edge).astype(float)   # paths that stay inside, along i = 0
    for i in range(1, n1 + 1):
        inside = np.abs(i * n2 - np.arange(n2 + 1) * n1) < edge
        row = np.cumsum(np.where(inside, row, 0.0)) * inside   # the inside of a row is one interval
    return float(min(max(1.0 - row[-1] / math.comb(n1 + n2, n1), 0.0), 1.0))


@F.pandas_udf(T.DoubleType())
def _exact_p(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([exact_ks_p(x, int(a), int(b)) if 0 < a * b <= EXACT_PRODUCT else None for x, a, b in zip(d, n1, n2)], dtype="float64")


def ks_pvalue(d: Column, n1: Column, n2: Column) -> Column:
    """Exact for small samples, the asymptotic series beyond ``EXACT_PRODUCT``."""
    series = kolmogorov_pvalue(d, n1.cast("double"), n2.cast("double"))
    return F.when(n1 * n2 <= EXACT_PRODUCT, _exact_p(d, n1, n2)).otherwise(series)


def _two_sided_long(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (unpivot_values(ref, columns).withColumn("side", F.lit(0))
            .unionByName(unpivot_values(cur, columns).withColumn("side", F.lit(1))))


def ks_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str],
             threshold: float = KS_P_THRESHOLD) -> DataFrame:
    """G1: two-sample KS per numeric column on non-null values.

    Returns (col_name, ks_statistic, p_value, drift_detected, threshold,
    n_ref, n_cur, reference_mean, current_mean, reference_std, current_std).
    Both samples are read once; sizes, moments and CDFs come from the counts.
    """
    long = _two_sided_long(ref, cur, columns)
    counts = ranged(long.groupBy("col_name", "v").agg(
        F.count_if(F.col("side") == 0).alias("n1"), F.count_if(F.col("side") == 1).alias("n2")), ["col_name"], "v")
    sizes = counts.groupBy("col_name").agg(
        F.sum("n1").alias("tot1"), F.sum("n2").alias("tot2"),
        F.try_divide(F.sum(F.col("v") * F.col("n1")), F.sum("n1")).alias("reference_mean"),
        F.try_divide(F.sum(F.col("v") * F.col("n2")), F.sum("n2")).alias("current_mean"))
    cdf = running_totals(counts, ["col_name"], "v", ["n1", "n2"])

    def spread(n, mean):
        return F.sum(F.col(n) * F.pow(F.col("v") - F.col(mean), 2))

    # one row per requested column: a join on the column name alone would shuffle a whole column into one task
    stat = (cdf.join(F.broadcast(sizes), "col_name").where((F.col("tot1") > 0) & (F.col("tot2") > 0))
            .groupBy("col_name", "tot1", "tot2", "reference_mean", "current_mean")
            .agg(F.max(F.abs(F.col("cum_n1") / F.col("tot1") - F.col("cum_n2") / F.col("tot2"))).alias("ks_statistic"),
                 spread("n1", "reference_mean").alias("_m1"), spread("n2", "current_mean").alias("_m2")))
    p = ks_pvalue(F.col("ks_statistic"), F.col("tot1"), F.col("tot2"))   # a row per column
    return (stat.withColumn("p_value", p)
            .select("col_name", "ks_statistic", "p_value",
                    (F.col("p_value") < threshold).alias("drift_detected"),
                    F.lit(threshold).alias("threshold"),
                    F.col("tot1").cast("bigint").alias("n_ref"), F.col("tot2").cast("bigint").alias("n_cur"),
                    "reference_mean", "current_mean",
                    F.sqrt(F.try_divide(F.col("_m1"), F.col("tot1") - 1)).alias("reference_std"),
                    F.sqrt(F.try_divide(F.col("_m2"), F.col("tot2") - 1)).alias("current_std")))


def _category_counts(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    def long(df, side):
        return (df.select(*[F.col(c).cast("string").alias(c) for c in columns])
                .unpivot([], list(columns), "col_name", "category")
                .where(F.col("category").isNotNull()).withColumn("side", F.lit(side)))
    both = long(ref, 0).unionByName(long(cur, 1))
    counts = both.groupBy("col_name", "category").agg(
        F.count_if(F.col("side") == 0).alias("n_ref"), F.count_if(F.col("side") == 1).alias("n_cur"))
    sizes = counts.groupBy("col_name").agg(F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"))
    return (counts.join(F.broadcast(sizes), "col_name")   # one row per requested column
            .withColumn("p_ref", F.when(F.col("tot_ref") > 0, F.col("n_ref") / F.col("tot_ref")).otherwise(0.0))
            .withColumn("p_cur", F.when(F.col("tot_cur") > 0, F.col("n_cur") / F.col("tot_cur")).otherwise(0.0)))


def category_distributions(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """D9 / G2 detail: per (column, category) both relative frequencies
    (absent side -> 0) and which side has it -- new and missing categories
    are the rows with ``in_ref`` or ``in_cur`` false."""
    c = _category_counts(ref, cur, columns)
    return c.select("col_name", "category", "p_ref", "p_cur",
                    (F.col("n_ref") > 0).alias("in_ref"), (F.col("n_cur") > 0).alias("in_cur"))


def categorical_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str],
                      threshold: float = TVD_THRESHOLD) -> DataFrame:
    """Total variation distance 0.5 * sum |p - q| over the union of
    categories; drift iff > threshold; unique / new / missing counts."""
    c = _category_counts(ref, cur, columns)
    return (c.groupBy("col_name")
            .agg((0.5 * F.sum(F.abs(F.col("p_ref") - F.col("p_cur")))).alias("drift_score"),
                 F.count_if(F.col("n_ref") > 0).cast("bigint").alias("reference_unique_values"),
                 F.count_if(F.col("n_cur") > 0).cast("bigint").alias("current_unique_values"),
                 F.count_if((F.col("n_ref") == 0) & (F.col("n_cur") > 0)).cast("bigint").alias("new_categories"),
                 F.count_if((F.col("n_ref") > 0) & (F.col("n_cur") == 0)).cast("bigint").alias("missing_categories"))
            .withColumn("drift_detected", F.col("drift_score") > threshold)
            .withColumn("threshold", F.lit(threshold)))


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def table_drift(ref: DataFrame, cur: DataFrame, categorical: Sequence[str] = ()) -> DataFrame:
    """KS for every numeric column, TVD for the listed string columns
    (the reference's "important" list).  One row per column:
    (col_name, kind, score, p_value, drift_detected)."""
    num = [f.name for f in ref.schema.fields if isinstance(f.dataType, NUMERIC) and f.name in cur.columns]
    cat = [c for c in categorical if c in ref.columns and c in cur.columns
           and isinstance(ref.schema[c].dataType, T.StringType)]
    parts = []
    if num:
        parts.append(ks_drift(ref, cur, num).select(
            "col_name", F.lit("numerical").alias("kind"), F.col("ks_statistic").alias("score"),
            "p_value", "drift_detected"))
    if cat:
        parts.append(categorical_drift(ref, cur, cat).select(
            "col_name", F.lit("categorical").alias("kind"), F.col("drift_score").alias("score"),
            F.lit(None).cast("double").alias("p_value"), "drift_detected"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_summary(per_column: DataFrame, threshold: float = OVERALL_THRESHOLD) -> DataFrame:
    """Columns checked, drifting columns (count and sorted names -- the
    list is bounded by the schema width), overall score = mean score of the
    drifting columns only (0 when none), exceeded iff > threshold."""
    s = per_column.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_columns_checked"),
        F.count_if("drift_detected").cast("bigint").alias("drifting_columns"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("drift_detected"), F.col("col_name")))), ",")
         .alias("columns_with_drift"),
        F.coalesce(F.avg(F.when(F.col("drift_detected"), F.col("score"))), F.lit(0.0)).alias("overall_drift_score"))
    return s.withColumn("drift_threshold_exceeded", F.col("overall_drift_score") > threshold)


DECILES = tuple(i / PSI_BINS for i in range(PSI_BINS + 1))


def baseline_stats(df: DataFrame, features: Sequence[str], bins: int = PSI_BINS) -> DataFrame:
    """Per feature n, mean, population std (numpy ``std``), min, max and
    the sorted unique decile edges used by PSI -- the whole baseline
    distribution is summarised instead of keeping its first 5,000 values."""
    return B.baseline_profile(df, features, bins).select(
        "col_name", "n", "mean", F.sqrt(F.col("m2") / F.col("n")).alias("std"), "min", "max", "edges")


def psi_from_baseline(profile: DataFrame, measured: DataFrame, min_values: int = PSI_MIN_VALUES) -> DataFrame:
    """G6 from a stored baseline and a measured batch; neither is read again.

    Production values outside the baseline range lose mass; proportions are
    clipped at 1e-8.  Features with fewer than ``min_values`` production
    values are skipped (G7).
    """
    out = B.psi_of_profiles(profile, measured, PSI_EPS).where(F.col("n_production") >= min_values)
    level = (F.when(F.col("psi") > PSI_SIGNIFICANT, "significant")
             .when(F.col("psi") > PSI_MODERATE, "moderate").otherwise("none"))
    return out.select("col_name", "psi", "n_production").withColumn("level", level)


def psi(baseline: DataFrame, production: DataFrame, features: Sequence[str],
        bins: int = PSI_BINS, min_values: int = PSI_MIN_VALUES) -> DataFrame:
    """Population stability index per feature of two samples."""
    profile = cut_lineage(B.baseline_profile(baseline, features, bins))
    return psi_from_baseline(profile, B.measure(production.select(*features), profile, features), min_values)


def monitor_batch(profile: DataFrame, batch: DataFrame, features: Sequence[str], alert: float = PSI_ALERT) -> DataFrame:
    """S8 / G7 + C7: one row (mean_psi, features_checked, alert, completeness, range_validity,
    quality_score, n_rows) from one scan of the batch and the stored baseline."""
    measured = cut_lineage(B.measure(batch, profile, features))   # a row per column
    score = drift_score(psi_from_baseline(profile, measured), alert)
    quality = B.quality_of(measured)
    size = measured.agg(F.coalesce(F.max("n_rows"), F.lit(0)).alias("n_rows"))
    both = score.unionByName(quality, allowMissingColumns=True).unionByName(size, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def drift_score(psi_rows: DataFrame, alert: float = PSI_ALERT) -> DataFrame:
    """Mean PSI over the checked features (0 when none) and the alert flag."""
    s = psi_rows.agg(F.coalesce(F.avg("psi"), F.lit(0.0)).alias("mean_psi"),
                     F.count(F.lit(1)).cast("bigint").alias("features_checked"))
    return s.withColumn("alert", F.col("mean_psi") > alert)
