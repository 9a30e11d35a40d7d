"""Feedback store as table operators (inventory I1-I3, D10, E14).

The reference keeps one SQLite row per request id: a prediction upsert
replaces the row (clearing any label), a label update sets the label of an
existing row, and a label for an unknown id does nothing.  Over append-only
logs the same final state is:

* latest prediction per id (I1);
* the latest label with ``label_ts >= prediction_ts`` of that id (I2) --
  labels older than the latest prediction were cleared by the re-insert.

Both come out of one ``groupBy(id)`` over the union of the two logs with
``max_by`` aggregates, which combine map-side, so an id with a third of
all log rows is pre-reduced in every task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.features import decode_json_map


def feedback_table(predictions: DataFrame, labels: DataFrame, key: str = "request_id",
                   ts: str = "timestamp", label_ts: str = "label_timestamp",
                   tiebreak: str | None = None, label_tiebreak: str | None = None) -> DataFrame:
    """I1 + I2 (D10): one row per predicted id with its surviving label.

    ``labels`` has (key, actual_delay, user_feedback, label_ts[, tiebreak]).
    No join: both logs are unioned and reduced by one ``groupBy(key)`` whose
    ``max_by`` aggregates combine map-side, so an id with a third of all log
    rows is pre-reduced in every task.  The latest label survives iff it is
    not older than the latest prediction (an older one was cleared by the
    re-insert, and then every label of that id is older).  Labels of unknown
    ids never create rows.
    """
    p_cols = [c for c in predictions.columns if c != key]
    p_order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    l_order = F.struct(F.col(label_ts), F.col(label_tiebreak)) if label_tiebreak else F.col(label_ts)
    p = predictions.select(key, F.struct(*p_cols).alias("_p"), p_order.alias("_po"),
                           F.lit(None).cast("struct<actual_delay:double,user_feedback:string>").alias("_l"),
                           F.lit(None).cast(labels.select(l_order.alias("o")).schema["o"].dataType).alias("_lo"),
                           F.lit(None).cast(labels.schema[label_ts].dataType).alias("_lts"))
    lab = labels.select(key, F.lit(None).cast(p.schema["_p"].dataType).alias("_p"),
                        F.lit(None).cast(p.schema["_po"].dataType).alias("_po"),
                        F.struct(F.col("actual_delay").cast("double").alias("actual_delay"),
                                 F.col("user_feedback").cast("string").alias("user_feedback")).alias("_l"),
                        l_order.alias("_lo"), F.col(label_ts).alias("_lts"))
    red = (p.unionByName(lab).groupBy(key)
           .agg(F.max_by("_p", "_po").alias("_p"), F.max_by(F.struct("_l", "_lts"), "_lo").alias("_ll")))
    keep = F.col("_ll._lts") >= F.col(f"_p.{ts}")
    return (red.where(F.col("_p").isNotNull())
            .select(key, "_p.*",
                    F.when(keep, F.col("_ll._l.actual_delay")).alias("actual_delay"),
                    F.when(keep, F.col("_ll._l.user_feedback")).alias("user_feedback")))


def labeled_view(feedback: DataFrame, features_col: str = "features",
                 ts: str = "timestamp") -> DataFrame:
    """Labelled rows ordered by time with the feature JSON decoded to a map."""
    return (feedback.where(F.col("actual_delay").isNotNull())
            .withColumn(features_col, decode_json_map(F.col(features_col)))
            .orderBy(ts))


def expand_features(labeled: DataFrame, keys, features_col: str = "features") -> DataFrame:
    """H19 helper: pull named keys out of the feature map as double columns."""
    return labeled.withColumns({k: F.col(features_col)[k].try_cast("double") for k in keys})
