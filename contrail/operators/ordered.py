"""Order statistics that stay distributed.

Exact quantiles, two-sample empirical CDFs (KS) and positional splits all
need running totals in value order.  A plain ``Window.partitionBy(column)
.orderBy(value)`` would put every distinct value of a column into one task,
so the work is split by range partitions:

1. collapse to one row per (group, value) -- this removes hot values, a
   value holding a third of all rows becomes one row;
2. ``ranged``: deal the rows out by ranges of (group, value) and keep the
   number of the partition; a large group spans many partitions;
3. totals per (group, partition) and their prefix sums: a table of about as
   many rows as there are partitions and groups;
4. running sums inside a (group, partition), plus its prefix.

A quantile needs step 4 only in the partitions that hold its ranks, which the
prefix table names.  A single rank (``value_at_rank``) needs no collapse of
all rows: a quantile sketch brackets it, and only the bracket is selected from.

Everything is exact; ranges and sketch only decide where the work is done.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.session import cut_lineage

SKETCH_ACCURACY = 10_000   # percentile_approx: a rank is off by rows / accuracy at most


def ranged(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``counts`` (one row per keys and value) in range partitions, checkpointed
    together with the partition number ``_part``."""
    n = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(counts.repartitionByRange(n, *keys, value).withColumn("_part", F.spark_partition_id()))


def unpivot_values(df: DataFrame, columns: Sequence[str], name: str = "col_name",
                   value: str = "v", keep: Sequence[str] = ()) -> DataFrame:
    """Wide -> long (column name, value as double), nulls and NaN dropped."""
    cast = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    long = cast.unpivot(list(keep), list(columns), name, value)
    return long.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value)))


def small_side(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast a table of at most ``max_rows`` rows, a bound the caller knows
    from its column list.  A join on column names alone would send a whole
    column to one task.  Without a bound Catalyst and AQE choose the join."""
    return F.broadcast(df) if max_rows is not None else df


def prefix_totals(rows: DataFrame, keys: Sequence[str], weights: Sequence[str]) -> DataFrame:
    """(keys, _part) -> per weight its total ``_tot_`` and the sum ``_off_`` of the partitions before."""
    keys = list(keys)
    totals = rows.groupBy(*keys, "_part").agg(*[F.sum(w).alias(f"_tot_{w}") for w in weights])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("*", *[F.coalesce(F.sum(f"_tot_{w}").over(before), F.lit(0)).alias(f"_off_{w}") for w in weights])


def _local_sums(rows: DataFrame, keys: Sequence[str], value: str, weights: Sequence[str]) -> DataFrame:
    inside = Window.partitionBy("_part", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select("*", *[F.sum(w).over(inside).alias(f"_loc_{w}") for w in weights])


def running_totals(rows: DataFrame, keys: Sequence[str], value: str, weights: Sequence[str]) -> DataFrame:
    """Add ``cum_<w>`` (inclusive running sum in ``value`` order within ``keys``)
    for every weight column of ``ranged`` rows.  The prefix join is on the
    partitioning the running sums have anyway."""
    keys = list(keys)
    out = _local_sums(rows, keys, value, weights).join(prefix_totals(rows, keys, weights), ["_part", *keys])
    return out.select(*[c for c in rows.columns if c != "_part"],
                      *[(F.col(f"_loc_{w}") + F.col(f"_off_{w}")).alias(f"cum_{w}") for w in weights])


def value_counts_long(long: DataFrame, keys: Sequence[str], value: str = "v",
                      weight: str | None = None) -> DataFrame:
    """One row per (keys, value) with its multiplicity ``n`` (or the sum of
    an integer ``weight`` column: a row standing for ``weight`` rows)."""
    n = F.sum(weight).cast("bigint") if weight else F.count(F.lit(1))
    return long.groupBy(*keys, value).agg(n.alias("n"))


def quantiles_ranged(rows: DataFrame, keys: Sequence[str], probs: Sequence[float],
                     value: str = "v", max_groups: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles of ``ranged`` counts with weight ``n``.

    ``max_groups`` bounds the number of distinct ``keys``.  The prefix table
    names the partition of each rank; running sums are made in those only.
    """
    keys = list(keys)
    prefix = prefix_totals(rows, keys, ["n"])
    whole = Window.partitionBy(*keys)
    ranks = (prefix.withColumn("_N", F.sum("_tot_n").over(whole))
             .withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
             .withColumn("_h", (F.col("_N") - 1) * F.col("p"))
             .withColumn("_side", F.explode(F.array(F.lit("lo"), F.lit("hi"))))
             .withColumn("_r", F.when(F.col("_side") == "lo", F.floor("_h")).otherwise(F.ceil("_h")) - F.col("_off_n"))
             .where((F.col("_r") >= 0) & (F.col("_r") < F.col("_tot_n")))
             .select(*keys, "_part", "p", "_side", "_r", (F.col("_h") - F.floor("_h")).alias("_frac")))
    wanted = small_side(ranks, None if max_groups is None else 2 * max_groups * len(probs))
    held = rows.join(wanted.select("_part", *keys).distinct(), ["_part", *keys], "left_semi")
    hit = _local_sums(held, keys, value, ["n"]).join(wanted, ["_part", *keys])
    hit = hit.where((F.col("_loc_n") - F.col("n") <= F.col("_r")) & (F.col("_r") < F.col("_loc_n")))
    return (hit.groupBy(*keys, "p")
            .agg(F.max(F.when(F.col("_side") == "lo", F.col(value))).alias("_vlo"),
                 F.max(F.when(F.col("_side") == "hi", F.col(value))).alias("_vhi"),
                 F.first("_frac").alias("_frac"))
            .select(*keys, "p",
                    (F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo"))).alias("q")))


def quantiles_long(long: DataFrame, keys: Sequence[str], probs: Sequence[float],
                   value: str = "v", weight: str | None = None, max_groups: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (numpy / R type 7 / Spark
    ``percentile`` / DuckDB ``quantile_cont``) per group of ``keys``.

    ``weight`` (integer) makes each row count as that many rows, which lets
    a caller pre-aggregate.  Returns (keys..., p, q); groups with no values
    produce no rows.
    """
    rows = ranged(value_counts_long(long, keys, value, weight), keys, value)
    return quantiles_ranged(rows, keys, probs, value, max_groups)


def column_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One pass over ``df``: (col_name, v, n) per distinct value of every
    column, the null value included as its own row (NaN counts as null), in
    range partitions.  Quantiles, moments, NA counts and fence counts can
    all be derived from it without touching ``df`` again."""
    cast = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = cast.unpivot([], list(columns), "col_name", "v") \
               .withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return ranged(long.groupBy("col_name", "v").agg(F.count(F.lit(1)).alias("n")), ["col_name"], "v")


def quantiles_from_counts(counts: DataFrame, probs: Sequence[float], max_groups: int) -> DataFrame:
    """Exact quantiles per col_name from ``column_value_counts`` output."""
    return quantiles_ranged(counts.where(F.col("v").isNotNull()), ["col_name"], probs, "v", max_groups)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles of several columns: (column, p, q)."""
    return quantiles_long(unpivot_values(df, columns), ["col_name"], probs, "v", max_groups=len(columns))


def quantile_array(quantiles: DataFrame, keys: Sequence[str], name: str = "qs") -> DataFrame:
    """(keys, p, q) rows -> one row per keys with the quantiles as an array in p order."""
    return (quantiles.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct("p", "q"))).alias("_pq"))
            .select(*keys, F.transform("_pq", lambda s: s["q"]).alias(name)))


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column as driver scalars (one small row per column)."""
    rows = exact_quantiles(df, columns, [0.5]).collect()
    got = {r["col_name"]: r["q"] for r in rows}
    return {c: got.get(c) for c in columns}


def value_at_rank(df: DataFrame, column: str, share: float | None = None, rank: int | None = None,
                  accuracy: int = SKETCH_ACCURACY):
    """Value of the row at 0-based position ``rank``, or ``floor(share * rows)``,
    in the order of ``column`` (not null); None when out of range.

    One pass counts and sketches, a second one collapses the rows inside the
    sketch's bracket and counts those below; if the bracket should miss the
    rank, all rows are selected from.
    """
    if share is None:
        n = df.count()
        share = (rank + 0.5) / n if n else 0.0
    slack = 2.0 / accuracy
    ends = [min(max(x, 0.0), 1.0) for x in (share - slack, share + slack)]
    n, got = df.agg(F.count(column), F.percentile_approx(column, ends, accuracy)).first()
    rank = int(share * n) if rank is None else rank
    if not 0 <= rank < n:
        return None
    for lo, hi in (got, (None, None)):
        rows, inside = df, F.lit(True)
        if lo is not None:
            rows, inside = df.where(F.col(column) <= F.lit(hi)), F.col(column) >= F.lit(lo)
        counts = rows.groupBy(F.when(inside, F.col(column)).alias("v")).agg(F.count(column).alias("n"))
        held = ranged(counts.withColumn("_g", F.lit(0)), ["_g"], "v")  # the null group is what lies below; nulls sort first
        cdf = running_totals(held, ["_g"], "v", ["n"])
        hit = cdf.where((F.col("cum_n") - F.col("n") <= rank) & (F.lit(rank) < F.col("cum_n"))).select("v").first()
        if hit is not None and hit["v"] is not None:
            return hit["v"]
    return None


def _orderable(df: DataFrame, order_col: str):
    """Numeric stand-in for an order column: dates and timestamps become day /
    microsecond numbers, so the sketch keeps them exact."""
    dt = df.schema[order_col].dataType
    if isinstance(dt, T.DateType):
        return F.unix_date(F.col(order_col))
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(order_col))
    return F.col(order_col)


def split_by_position(df: DataFrame, order_col: str, accuracy: int = SKETCH_ACCURACY):
    """First half / second half by position in ``order_col`` order (G4):
    reference = the first ``n // 2`` rows, current = the rest.
    ``order_col`` must be unique (an event id, a date of a daily table)."""
    key = _orderable(df, order_col)
    cut = value_at_rank(df.select(key.alias("_ord")), "_ord", share=0.5, accuracy=accuracy)
    if cut is None:
        return df.limit(0), df
    return df.filter(key < F.lit(cut)), df.filter(key >= F.lit(cut))
