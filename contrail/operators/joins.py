"""Star-schema joins and post-join cleaning (inventory D1-D10).

All reference joins are equi left-outer joins of a large fact to small
dimensions.  No join carries a hint: Catalyst broadcasts a dimension whose
size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE decides again
with the real sizes.  Fact rows are never dropped by a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from contrail.functions.features import date_from_parts


class RepeatedKeys(ValueError):
    """A dimension with a key on several rows would multiply the fact's rows."""


def repeated_keys(dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """D1-D3 precondition: (dim, key, n) of every non-null key on more than one row;
    ``dims`` maps a name to the dimension and its key column.  One aggregate over the keys."""
    rows = None
    for name, (dim, key) in dims.items():
        one = dim.select(F.lit(name).alias("dim"), F.col(key).cast("string").alias("key")).where(F.col("key").isNotNull())
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("dim", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def require_unique_keys(dims: dict[str, tuple[DataFrame, str]]) -> None:
    """Raises ``RepeatedKeys`` with the number of repeated keys per dimension and one example."""
    bad = repeated_keys(dims).groupBy("dim").agg(F.count(F.lit(1)).alias("keys"), F.min("key").alias("example")).orderBy("dim").collect()
    if bad:
        raise RepeatedKeys("; ".join(f"{r['dim']}: {r['keys']} repeated keys, one is {r['example']}" for r in bad))


class RowInvariant:
    """Row counts of a plan's input and output, gathered by the job that runs anyway.

    ``before`` and ``after`` observe a DataFrame on its way; once an action
    on the result has run, ``check`` compares the counts."""

    def __init__(self, name: str = "rows"):
        self._in, self._out = Observation(f"{name}-in"), Observation(f"{name}-out")

    def before(self, df: DataFrame) -> DataFrame:
        return df.observe(self._in, F.count(F.lit(1)).alias("n"))

    def after(self, df: DataFrame) -> DataFrame:
        return df.observe(self._out, F.count(F.lit(1)).alias("n"))

    def counts(self) -> tuple[int, int]:
        return self._in.get["n"], self._out.get["n"]

    def check(self) -> int:
        n_in, n_out = self.counts()
        if n_in != n_out:
            raise RepeatedKeys(f"{n_in} rows went into the joins, {n_out} came out")
        return n_out


def enrich(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           prefix: str = "", keep: Sequence[str] | None = None) -> DataFrame:
    """Left join one dimension.

    ``prefix`` renames the dimension's columns, which is how one dimension
    plays two roles (origin and destination locations).  The dimension key
    is dropped after the join; the fact key stays.
    """
    cols = [c for c in (keep or dim.columns) if c != dim_key]
    d = dim.select(F.col(dim_key).alias("_dk"), *[F.col(c).alias(prefix + c) for c in cols])
    return fact.join(d, fact[fact_key] == d["_dk"], "left").drop("_dk")


def enrich_star(fact: DataFrame, carriers: DataFrame, locations: DataFrame,
                carrier_key: str = "carrier", origin_key: str = "origin",
                dest_key: str = "dest") -> DataFrame:
    """Carrier name, then the location dimension twice (ORIGIN_ / DEST_)."""
    out = enrich(fact, carriers, carrier_key, "carrier_key")
    out = enrich(out, locations, origin_key, "loc_key", prefix="origin_")
    return enrich(out, locations, dest_key, "loc_key", prefix="dest_")


def join_holidays(fact: DataFrame, holidays: DataFrame, date_col: str | None = None,
                  ymd: tuple[str, str, str] = ("year", "month", "day")) -> DataFrame:
    """Build the date from Y/M/D (or use ``date_col``), left join the
    holiday calendar; is_holiday null -> 0, holiday_name null -> 'None'."""
    out = fact if date_col else fact.withColumn("date", date_from_parts(*ymd))
    key = date_col or "date"
    h = holidays.select(F.col("date").alias("_hd"), "holiday_name", "is_holiday")
    out = out.join(h, out[key] == F.col("_hd"), "left").drop("_hd")
    return out.withColumns({
        "is_holiday": F.coalesce(F.col("is_holiday"), F.lit(0)).cast("int"),
        "holiday_name": F.coalesce(F.col("holiday_name"), F.lit("None")),
    })


def join_daily_and_fill(fact: DataFrame, daily: DataFrame, fact_date: str,
                        daily_date: str, fill_cols: Sequence[str]) -> DataFrame:
    """Left join a daily table, then fill nulls of ``fill_cols`` with
    the median over the *joined* rows (flight-weighted, before any target
    drop).

    The joined value of a column is the daily value of the row's date, so
    the median over joined rows is the median of the daily values weighted
    by the number of fact rows per date.  Only ``groupBy(date).count()``
    touches the fact (map-side combined).  The weighted medians then run on
    a table with one row per calendar day -- bounded by the time span, not
    by the data volume -- so Spark's exact ``percentile`` with a frequency
    column is safe there; the medians come back as a few scalars."""
    per_date = fact.groupBy(F.col(fact_date).alias("_dd")).agg(F.count(F.lit(1)).alias("_w"))
    d = daily.withColumnRenamed(daily_date, "_dd")
    weighted = per_date.join(d, "_dd", "left")
    row = weighted.agg(*[F.percentile(F.col(c).cast("double"), F.lit(0.5), F.col("_w")).alias(c)
                         for c in fill_cols]).first()
    med = {c: row[c] for c in fill_cols}
    joined = fact.join(d, fact[fact_date] == F.col("_dd"), "left").drop("_dd")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(med[c]).cast("double"))
                               for c in fill_cols if med.get(c) is not None})


def clean_joined(df: DataFrame, target: str, fill: dict | None = None,
                 drop_cols: Sequence[str] = (), dedupe: bool = True) -> DataFrame:
    """Drop rows with a null target, drop spare columns, fill
    defaults, drop duplicate rows (NULL equals NULL, as in pandas)."""
    out = df.na.drop(subset=[target]).drop(*drop_cols)
    if fill:
        out = out.na.fill(fill)
    return out.dropDuplicates() if dedupe else out


def attach_group_stats(fact: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join aggregated group statistics back to the fact (left).

    The stats table has one row per group.  No hint: when its shuffle stage
    finishes AQE sees the real size and broadcasts it if it is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``; a high-cardinality
    key (routes at scale) stays a shuffle join."""
    return fact.join(stats, list(keys), "left")
