"""Mode imputation as a persistable Spark ML stage (inventory H4, H6).

``ModeImputer`` learns the most frequent non-null value of each column on the
training rows, ties going to the smallest value, and ``ModeImputerModel`` fills
nulls with it.  Both are ordinary pipeline stages: their state is in params, so
they are saved and loaded inside a ``PipelineModel``.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_modes(df: DataFrame, cols) -> DataFrame:
    """H4: most frequent non-null value per column, ties -> smallest value.

    Counts per (column, value) are a distributed aggregate; the pick is a
    ``min_by`` over (-count, value), so no column's values meet in one task
    before they are reduced."""
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], list(cols), "col_name", "value").where(F.col("value").isNotNull()))
    counts = long.groupBy("col_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("col_name").agg(
        F.min_by(F.struct((-F.col("n")).alias("neg_n"), F.col("value")), F.struct(-F.col("n"), F.col("value")))
         .alias("_m")).select("col_name", F.col("_m.value").alias("mode_value"),
                              (-F.col("_m.neg_n")).cast("bigint").alias("mode_count"))


class ModeImputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns one value per input column (cast to string)."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ModeImputerModel:
        cols = self.getInputCols()
        found = {r["col_name"]: r["mode_value"] for r in category_modes(dataset, cols).collect()}   # a row per column
        model = ModeImputerModel(inputCols=cols, outputCols=self.getOutputCols(),
                                 modes=[found.get(c, "") for c in cols], known=[int(c in found) for c in cols])
        return self._copyValues(model)


class ModeImputerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fills nulls with the learned values; a column without any value in training stays null."""

    modes = Param(Params._dummy(), "modes", "value per input column", typeConverter=TypeConverters.toListString)
    known = Param(Params._dummy(), "known", "1 where training had a value", typeConverter=TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, modes=None, known=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = {}
        for c, out, mode, known in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.modes), self.getOrDefault(self.known)):
            text = F.col(c).cast("string")
            filled[out] = F.coalesce(text, F.lit(mode)) if known else text
        return dataset.withColumns(filled)
