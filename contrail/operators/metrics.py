"""Model metrics as single aggregates (inventory H7, H20, G9, G10).

R^2 uses the centred form 1 - SSE / SST with SST from the label's
variance (``var_pop * n``), which avoids the cancellation of the
sum-of-squares form.  SST = 0 -> R^2 is null (undefined), never an ANSI
division error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.features import DELAY_THRESHOLD, delay_flag

# The reference's monitoring constants.
MIN_LABELED_ROWS = 100
BASELINE_MAE = 10.0
RETRAIN_MAE_MULTIPLIER = 1.20
R2_DROP_TOLERANCE = 0.05


def metric_aggs(label: str, prediction: str):
    err = F.col(label) - F.col(prediction)
    sse = F.sum(err * err)
    sst = F.var_pop(label) * F.count(F.lit(1))
    return [F.count(F.lit(1)).cast("bigint").alias("n"),
            (1 - F.try_divide(sse, sst)).alias("r2_score"),
            F.avg(F.abs(err)).alias("mae"),
            F.sqrt(F.avg(err * err)).alias("rmse"),
            F.avg(err * err).alias("mse")]


def regression_metrics(df: DataFrame, label: str, prediction: str,
                       by: Sequence[str] = ()) -> DataFrame:
    """H7: n, R^2, MAE, RMSE, MSE -- optionally per group (per model, H15)."""
    rows = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    if by:
        return rows.groupBy(*by).agg(*metric_aggs(label, prediction))
    return rows.agg(*metric_aggs(label, prediction))


def classification_metrics(df: DataFrame, label: str, prediction: str,
                           threshold: float = DELAY_THRESHOLD) -> DataFrame:
    """Accuracy / precision / recall / F1 of the delayed flag, plus MAPE
    over non-zero labels, from one aggregate."""
    y, p = delay_flag(label, threshold), delay_flag(prediction, threshold)
    tp = F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0))
    fp = F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0))
    fn = F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0))
    tn = F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0))
    prec = F.try_divide(tp, tp + fp)
    rec = F.try_divide(tp, tp + fn)
    mape = F.avg(F.when(F.col(label) != 0, F.abs((F.col(label) - F.col(prediction)) / F.col(label))))
    rows = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return rows.agg(tp.cast("bigint").alias("tp"), fp.cast("bigint").alias("fp"),
                    fn.cast("bigint").alias("fn"), tn.cast("bigint").alias("tn"),
                    F.try_divide(tp + tn, F.count(F.lit(1))).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    F.try_divide(2 * prec * rec, prec + rec).alias("f1"),
                    (mape * 100).alias("mape"))


def confusion_matrix(df: DataFrame, label: str, prediction: str,
                     threshold: float = DELAY_THRESHOLD) -> DataFrame:
    """Counts per (actual flag, predicted flag)."""
    return (df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
            .groupBy(delay_flag(label, threshold).alias("actual"),
                     delay_flag(prediction, threshold).alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")))


def accuracy_check(labeled: DataFrame, label: str, prediction: str, baseline_r2: float | None,
                   baseline_mae: float = BASELINE_MAE, min_rows: int = MIN_LABELED_ROWS) -> DataFrame:
    """G9 + G10 on the labelled rows, one row:

    * accuracy_drop: at least ``min_rows`` rows and R^2 < baseline_r2 - 0.05
      (false without a baseline R^2);
    * retrain_on_mae: at least ``min_rows`` rows and MAE > baseline_mae * 1.2.
    """
    m = regression_metrics(labeled, label, prediction)
    enough = F.col("n") >= min_rows
    drop = (enough & (F.col("r2_score") < F.lit(baseline_r2) - R2_DROP_TOLERANCE)) \
        if baseline_r2 is not None else F.lit(False)
    return m.select("n", "r2_score", "mae",
                    F.lit(baseline_r2).cast("double").alias("baseline_r2"),
                    F.lit(baseline_mae).cast("double").alias("baseline_mae"),
                    F.coalesce(drop, F.lit(False)).alias("accuracy_drop"),
                    F.coalesce(enough & (F.col("mae") > baseline_mae * RETRAIN_MAE_MULTIPLIER),
                               F.lit(False)).alias("retrain_on_mae"))
