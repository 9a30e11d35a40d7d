"""Stored baseline distributions that merge across batches (inventory G8, G6, G7, C7, S8).

A profile is a table with one row per feature: the histogram edges (deciles of
the data it was first made from), the counts between and beyond them, and the
moments.  Two profiles over the same edges merge by addition, so a baseline
grows by batches without reading the older ones again, and everything the
monitoring needs of the baseline -- PSI, mean +- 3 std -- is in the stored rows.

``measure`` profiles a batch in one scan against a stored baseline: all
features, the non-null cells of every column and the values in range, in one
aggregate with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.ordered import quantile_array, quantiles_ranged, ranged, unpivot_values, value_counts_long

PROFILE = ("col_name string, n long, mean double, m2 double, min double, max double, edges array<double>, "
           "counts array<long>, below long, above long")
SIGMAS = 3.0   # values within mean +- 3 std are in range


def bin_count(edges: Column) -> Column:
    return F.greatest(F.size(edges) - 1, F.lit(1))


def cell_index(v: Column, edges: Column) -> Column:
    """Histogram cell of ``v``: -1 below the edges, ``bin_count`` above; [e_i, e_i+1), the last bin closed."""
    i = F.size(F.filter(edges, lambda e: e <= v)) - 1
    return F.when(v < F.element_at(edges, 1), -1).when(v > F.element_at(edges, -1), bin_count(edges)).otherwise(F.least(i, bin_count(edges) - 1))


def _shift(edges: Column) -> Column:
    """A value inside the data that the sums are taken around, so the squares keep their digits."""
    return F.element_at(edges, (F.size(edges) / 2).cast("int") + 1)


def _roll_up(cells: DataFrame, edges: DataFrame, *more: Column) -> DataFrame:
    """(col_name, cell, c, s1, s2, lo, hi) -> one profile row per column; ``more`` are further aggregates."""
    per = cells.groupBy("col_name").agg(
        F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("n"), F.sum("s1").alias("_s1"), F.sum("s2").alias("_s2"),
        F.min("lo").alias("min"), F.max("hi").alias("max"),
        F.map_from_entries(F.collect_list(F.when(F.col("cell").isNotNull(), F.struct("cell", "c")))).alias("_cells"), *more)  # bins + 2 entries
    one = per.join(F.broadcast(edges), "col_name", "left")   # a row per column on both sides

    def held(i):
        return F.coalesce(F.try_element_at("_cells", i), F.lit(0)).cast("long")
    e = F.col("edges")
    n = F.when(F.col("n") > 0, F.col("n"))
    return one.select(
        "col_name", "n", (_shift(e) + F.col("_s1") / n).alias("mean"), F.greatest(F.col("_s2") - F.col("_s1") * F.col("_s1") / n, F.lit(0.0)).alias("m2"), "min", "max", "edges",
        F.when(e.isNotNull(), F.transform(F.sequence(F.lit(0), bin_count(e) - 1), held)).alias("counts"), held(F.lit(-1)).alias("below"), held(bin_count(e)).alias("above"),
        *[c for c in per.columns if c not in ("col_name", "n", "_s1", "_s2", "min", "max", "_cells")])


def _sums(v: Column, w: Column) -> list[Column]:
    d = v - _shift(F.col("edges"))
    return [F.sum(F.when(v.isNotNull(), w)).alias("c"), F.sum(d * w).alias("s1"), F.sum(d * d * w).alias("s2"), F.min(v).alias("lo"), F.max(v).alias("hi")]


def baseline_profile(df: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """The profile of ``df`` with edges at its own exact quantiles.  One read
    of ``df``: edges, counts and moments come from the collapsed values."""
    probs = tuple(i / bins for i in range(bins + 1))
    counts = ranged(value_counts_long(unpivot_values(df, features), ["col_name"]), ["col_name"], "v")
    q = quantile_array(quantiles_ranged(counts, ["col_name"], probs, "v", len(features)), ["col_name"])
    edges = q.select("col_name", F.array_distinct("qs").alias("edges"))
    tagged = counts.join(F.broadcast(edges), "col_name")   # a row per feature
    cells = tagged.groupBy("col_name", cell_index(F.col("v"), F.col("edges")).alias("cell")).agg(*_sums(F.col("v"), F.col("n")))
    return _roll_up(cells, edges)


def save_profile(profile: DataFrame, path: str) -> DataFrame:
    """Writes the rows (one per feature) and returns the stored table."""
    profile.write.mode("overwrite").parquet(path)
    return load_profile(profile.sparkSession, path)


def load_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROFILE).parquet(path)


def measure(batch: DataFrame, baseline: DataFrame, features: Sequence[str]) -> DataFrame:
    """The profile of ``batch`` on the edges of ``baseline``, in one scan.

    Rows for the other columns carry counts only.  Further columns: ``n_rows``
    (rows of the batch) and ``in_range`` (values within the baseline's mean +-
    3 population std).  NaN counts as missing.
    """
    std = F.sqrt(F.col("m2") / F.col("n"))
    known = baseline.select("col_name", "edges", (F.col("mean") - SIGMAS * std).alias("_lo"), (F.col("mean") + SIGMAS * std).alias("_hi"))

    def entry(c):
        v = F.col(f"`{c}`")
        number = v.cast("double") if c in features else F.lit(None).cast("double")
        return F.struct(F.lit(c).alias("col_name"), v.isNotNull().alias("present"), F.when(~F.isnan(number), number).alias("v"), F.lit(c in features).alias("is_feature"))
    long = batch.select(F.inline(F.array(*[entry(c) for c in batch.columns]))).join(F.broadcast(known), "col_name", "left")   # a row per feature
    v = F.col("v")
    present = F.when(F.col("is_feature"), v.isNotNull()).otherwise(F.col("present"))
    cells = long.groupBy("col_name", cell_index(v, F.col("edges")).alias("cell")).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(present).alias("_present"), F.count_if(v.between(F.col("_lo"), F.col("_hi"))).alias("_in"), *_sums(v, F.lit(1)))
    cells = cells.withColumn("cell", F.when(F.col("c") > 0, F.col("cell")))
    return _roll_up(cells, known.select("col_name", "edges"), F.sum("_rows").alias("n_rows"), F.sum("_present").alias("n_present"), F.sum("_in").alias("in_range"))


def merge_profiles(*profiles: DataFrame) -> DataFrame:
    """The profile of all data behind ``profiles``, which must have the same edges."""
    rows = profiles[0].select(*[c.split()[0] for c in PROFILE.split(", ")])
    for p in profiles[1:]:
        rows = rows.unionByName(p.select(*rows.columns))
    # a row per profile and feature; the columns that are no feature have no edges
    held = rows.where(F.col("edges").isNotNull()).groupBy("col_name").agg(F.sort_array(F.collect_list(F.struct("edges", "n", "mean", "m2", "min", "max", "counts", "below", "above"))).alias("ps"))

    def total(f, zero=None):
        return F.aggregate("ps", F.lit(0).cast("long") if zero is None else zero, lambda a, x: a + f(x))
    n = F.col("n")
    first = F.element_at("ps", 1)
    same = F.forall("ps", lambda x: x["edges"].eqNullSafe(first["edges"]))
    out = held.withColumn("n", total(lambda x: x["n"]))
    out = out.withColumn("mean", total(lambda x: F.coalesce(x["n"] * x["mean"], F.lit(0.0)), F.lit(0.0)) / F.when(n > 0, n))
    return out.select(
        "col_name", "n", "mean", total(lambda x: F.coalesce(x["m2"] + x["n"] * F.pow(x["mean"] - F.col("mean"), 2), F.lit(0.0)), F.lit(0.0)).alias("m2"),
        F.array_min(F.transform("ps", lambda x: x["min"])).alias("min"), F.array_max(F.transform("ps", lambda x: x["max"])).alias("max"),
        F.when(same, first["edges"]).otherwise(F.raise_error(F.concat(F.lit("profiles with different edges: "), F.col("col_name")))).alias("edges"),
        F.aggregate(F.slice("ps", 2, F.greatest(F.size("ps") - 1, F.lit(0))), first["counts"], lambda a, x: F.zip_with(a, x["counts"], lambda i, j: i + j)).alias("counts"),
        total(lambda x: x["below"]).alias("below"), total(lambda x: x["above"]).alias("above"))


def psi_of_profiles(baseline: DataFrame, measured: DataFrame, eps: float) -> DataFrame:
    """``col_name, n_edges, n_production, psi`` per feature on both sides; proportions are of all
    non-null values, clipped at ``eps``; fewer than two edges give 0."""
    b = baseline.select("col_name", "edges", F.col("counts").alias("e"), F.col("n").alias("n_e"))
    a = measured.where(F.col("counts").isNotNull()).select("col_name", F.col("counts").alias("a"), F.col("n").alias("n_production"))

    def term(x, y):
        p, q = F.greatest(x / F.col("n_e"), F.lit(eps)), F.greatest(y / F.col("n_production"), F.lit(eps))
        return (q - p) * F.log(q / p)
    both = b.join(a, "col_name").where((F.col("n_e") > 0) & (F.col("n_production") > 0))
    total = F.aggregate(F.zip_with("e", "a", term), F.lit(0.0), lambda s, x: s + x)
    return both.select("col_name", F.size("edges").alias("n_edges"), "n_production", F.when(F.size("edges") < 2, F.lit(0.0)).otherwise(total).alias("psi"))


def quality_of(measured: DataFrame) -> DataFrame:
    """C7 from a measured batch: 0.5 * completeness (share of non-null cells) + 0.5 * range
    validity (mean share of a feature's values in the baseline's range; 1.0 without features).
    An empty batch scores 0."""
    known = F.col("edges").isNotNull() & (F.col("n") > 0)
    one = measured.agg(F.max("n_rows").alias("_N"), F.try_divide(F.sum("n_present").cast("double"), F.sum("n_rows")).alias("_c"),
                       F.avg(F.when(known, F.col("in_range") / F.col("n"))).alias("_r"))
    some = F.coalesce(F.col("_N"), F.lit(0)) > 0
    validity = F.coalesce(F.col("_r"), F.lit(1.0))
    return one.select(F.when(some, F.col("_c")).otherwise(0.0).alias("completeness"), F.when(some, validity).alias("range_validity"),
                      F.when(some, 0.5 * F.col("_c") + 0.5 * validity).otherwise(0.0).alias("quality_score"))
