"""Which inputs a model uses (inventory H20).

* ``permutation_importance``: the drop of R2 when one input column is dealt out
  anew among the test rows.  Every row gets a partner by two global orders of
  keyed hashes -- positions come from range partitions and prefix sums -- and one
  join stores each row with its partner's values; a column's stage then swaps
  that column only.
* ``vector_importances``: a tree model's importances added up per input column,
  found through the attributes of the feature vector.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.operators.ml import FeatureSpec, evaluate
from contrail.operators.ordered import ranged, running_totals
from contrail.session import cut_lineage


def positions(rows: DataFrame, key: str, seed: int, name: str) -> DataFrame:
    """(key, ``name``): 0-based place of each row in the order of a seeded hash of its unique key."""
    order = rows.select(F.struct(F.xxhash64(key, F.lit(seed)).alias("h"), F.col(key)).alias("v"), F.lit(0).alias("_g"), F.lit(1).alias("n"))
    placed = running_totals(ranged(order, ["_g"], "v"), ["_g"], "v", ["n"])
    return placed.select(F.col(f"v.{key}").alias(key), (F.col("cum_n") - 1).alias(name))


def with_partner(rows: DataFrame, key: str, columns: Sequence[str], seed: int) -> DataFrame:
    """``rows`` with ``_other``: the ``columns`` of another row; over all rows every row is a partner once."""
    mine = positions(rows, key, seed, "_a")
    theirs = positions(rows, key, seed + 1, "_b").withColumnRenamed(key, "_partner")
    pair = mine.join(theirs, F.col("_a") == F.col("_b")).select(key, "_partner")
    values = rows.select(F.col(key).alias("_partner"), F.struct(*columns).alias("_other"))
    return rows.join(pair, key).join(values, "_partner").drop("_partner")


def permutation_importance(model: PipelineModel, test: DataFrame, key: str, spec: FeatureSpec, seed: int = 42) -> DataFrame:
    """``column, importance, r2_score, r2_permuted`` per input column, from the stored test rows.
    ``key`` is unique; a constant column has importance 0."""
    spark, columns = test.sparkSession, [*spec.numeric, *spec.categorical]
    rows = cut_lineage(test.select(key, *columns, spec.label))
    stored = cut_lineage(with_partner(rows, key, columns, seed))
    whole = evaluate(model, rows, spec.label)["r2_score"]
    out = []
    for c in columns:
        permuted = stored.withColumn(c, F.col("_other")[c]).drop("_other")
        r2 = evaluate(model, permuted, spec.label)["r2_score"]
        out.append((c, None if whole is None or r2 is None else whole - r2, whole, r2))
    return spark.createDataFrame(out, "column string, importance double, r2_score double, r2_permuted double")


def vector_importances(model: PipelineModel, df: DataFrame, spec: FeatureSpec) -> dict[str, float]:
    """A tree model's ``featureImportances`` per input column of the whole pipeline."""
    meta = model.transform(df.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in meta.values() for a in kind}
    total = dict.fromkeys([*spec.numeric, *spec.categorical], 0.0)
    weights = model.stages[-1].featureImportances
    for i in range(weights.size):
        name = names[i]
        if name.startswith(("_num_scaled_", "_num_vec_")):
            total[spec.numeric[int(name.rsplit("_", 1)[1])]] += float(weights[i])
        else:
            total[max((c for c in spec.categorical if name.startswith(f"{c}__ohe_")), key=len)] += float(weights[i])
    return total
