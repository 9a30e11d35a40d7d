"""Data-quality profile (inventory C1-C10).

Every profile is one scan: all columns are aggregated in a single ``agg``
(or unpivoted once and grouped by column name) instead of one job per
column as the reference does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators import baseline as B
from contrail.session import cut_lineage

# The reference's plausibility bounds for date parts.
YEAR_BOUNDS = (2000, 2030)
MONTH_BOUNDS = (1, 12)
DAY_BOUNDS = (1, 31)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None,
                only_missing: bool = True, critical: Sequence[str] = ()) -> DataFrame:
    """Per column the null count and round(100 * n / N, 2).

    One aggregate computes every column's count; the one-row result is
    unpivoted to (column, missing_count, missing_pct, total_rows, critical).
    ``only_missing`` keeps columns with at least one null (C1); C9 keeps all.
    """
    cols = list(columns or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_N"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot(["_N"], cols, "col_name", "missing_count")
    out = long.select(
        "col_name",
        F.col("missing_count").cast("bigint").alias("missing_count"),
        F.when(F.col("_N") > 0, F.round(F.col("missing_count") * 100.0 / F.col("_N"), 2))
         .otherwise(F.lit(0.0)).alias("missing_pct"),
        F.col("_N").cast("bigint").alias("total_rows"),
        F.col("col_name").isin(*critical).alias("critical") if critical else F.lit(False).alias("critical"),
    )
    return out.where(F.col("missing_count") > 0) if only_missing else out


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Total rows, rows that repeat an earlier row, percentage (0 when empty).

    ``groupBy(all columns).count()`` combines map-side, so a heavily
    duplicated row collapses before the shuffle."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return groups.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint").alias("duplicate_count"),
    ).select("total_rows", "duplicate_count",
             F.when(F.col("total_rows") > 0,
                    F.round(F.col("duplicate_count") * 100.0 / F.col("total_rows"), 2))
              .otherwise(F.lit(0.0)).alias("duplicate_percentage"))


def _fk_codes(fact: DataFrame, fks: Sequence[str], dim: DataFrame, dim_key: str) -> DataFrame:
    """Distinct (fk_column, code) pairs of the fact with a validity flag."""
    keys = dim.select(F.col(dim_key).cast("string").alias("_k")).distinct()
    codes = (fact.select(*[F.col(c).cast("string").alias(c) for c in fks])
             .unpivot([], list(fks), "fk_column", "code").distinct())
    return codes.join(keys, codes.code == keys._k, "left") \
                .select("fk_column", "code", F.col("_k").isNotNull().alias("valid"))


def referential_check(fact: DataFrame, fks: Sequence[str], dim: DataFrame, dim_key: str) -> DataFrame:
    """C3 summary: per foreign-key column the distinct codes and how many are
    absent from the dimension (a null code counts as invalid, as the pandas
    set difference keeps NaN), plus the size of the valid key set.

    Codes are made distinct per column before the key lookup,
    so the join sees distinct codes, not fact rows."""
    n_valid = dim.select(dim_key).distinct().count()
    return (_fk_codes(fact, fks, dim, dim_key).groupBy("fk_column")
            .agg(F.count(F.lit(1)).cast("bigint").alias("unique_codes"),
                 F.count_if(~F.col("valid")).cast("bigint").alias("invalid_count"))
            .withColumn("valid_codes_count", F.lit(n_valid).cast("bigint")))


def invalid_codes(fact: DataFrame, fks: Sequence[str], dim: DataFrame, dim_key: str) -> DataFrame:
    """C3 detail: one row per (fk_column, invalid code); a null code is
    reported as null.  Rows, not a collected list, so it never funnels
    through one task."""
    return _fk_codes(fact, fks, dim, dim_key).where(~F.col("valid")).drop("valid")


def date_part_ranges(df: DataFrame, year: str = "year", month: str = "month", day: str = "day",
                     year_bounds=YEAR_BOUNDS, month_bounds=MONTH_BOUNDS, day_bounds=DAY_BOUNDS) -> DataFrame:
    """C4: min-max strings of the date parts and the three validity flags."""
    m = df.agg(*[F.min(c).alias(f"_min_{c}") for c in (year, month, day)],
               *[F.max(c).alias(f"_max_{c}") for c in (year, month, day)])

    def rng(c):
        return F.concat(F.col(f"_min_{c}").cast("string"), F.lit("-"), F.col(f"_max_{c}").cast("string"))

    def ok(c, b):
        return (F.col(f"_min_{c}") >= b[0]) & (F.col(f"_max_{c}") <= b[1])

    return m.select(rng(year).alias("year_range"), rng(month).alias("month_range"),
                    rng(day).alias("day_range"),
                    ok(year, year_bounds).alias("valid_year_range"),
                    ok(month, month_bounds).alias("valid_month_range"),
                    ok(day, day_bounds).alias("valid_day_range"))


def calendar_violations(df: DataFrame, year: str = "year", month: str = "month", day: str = "day") -> DataFrame:
    """C4 extra mode: rows whose Y/M/D is not a real calendar date."""
    return df.where(F.try_make_timestamp(F.col(year), F.col(month), F.col(day),
                                         F.lit(0), F.lit(0), F.lit(0)).isNull())


def range_violations(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Per column the count outside [lo, hi] and a "min to max" string at 2 dp, in one scan."""
    aggs = [F.count(F.lit(1)).alias("_N")]
    for c, (lo, hi) in bounds.items():
        aggs += [F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"_bad_{c}"),
                 F.min(c).alias(f"_min_{c}"), F.max(c).alias(f"_max_{c}")]
    one = df.agg(*aggs)
    rows = [F.struct(
        F.lit(c).alias("col_name"), F.col("_N").cast("bigint").alias("total_rows"),
        F.col(f"_bad_{c}").cast("bigint").alias("invalid_count"),
        F.concat(F.format_string("%.2f", F.col(f"_min_{c}").cast("double")), F.lit(" to "),
                 F.format_string("%.2f", F.col(f"_max_{c}").cast("double"))).alias("value_range")) for c in bounds]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def quality_score(current: DataFrame, baseline: DataFrame, features: Sequence[str]) -> DataFrame:
    """C7 of a batch against raw baseline rows; with a stored profile use
    ``baseline.quality_of(baseline.measure(...))``, which this does."""
    profile = cut_lineage(B.baseline_profile(baseline, features)) if features else baseline.sparkSession.createDataFrame([], B.PROFILE)
    return B.quality_of(B.measure(current, profile, features))


R_CLASS = {T.IntegerType: "integer", T.LongType: "integer", T.ShortType: "integer",
           T.DoubleType: "numeric", T.FloatType: "numeric", T.DecimalType: "numeric",
           T.StringType: "character", T.BooleanType: "logical", T.DateType: "Date",
           T.TimestampType: "POSIXct", T.TimestampNTZType: "POSIXct"}


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column its class, distinct values counting NA as a value,
    missing count and pct (2 dp).

    Unpivot once to (column, value as string), collapse (column, value)
    map-side, then count per column -- one shuffle for all columns."""
    cols = list(columns or df.columns)
    klass = {c: next((v for k, v in R_CLASS.items() if isinstance(df.schema[c].dataType, k)), "other")
             for c in cols}
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]) \
             .unpivot([], cols, "col_name", "value")
    per_value = long.groupBy("col_name", "value").agg(F.count(F.lit(1)).alias("_c"))
    prof = per_value.groupBy("col_name").agg(
        F.count(F.lit(1)).cast("bigint").alias("unique_values"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("_c"))), F.lit(0)).cast("bigint").alias("missing_count"),
        F.sum("_c").alias("_N"))
    class_map = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(klass[c]))])
    return prof.select("col_name", class_map[F.col("col_name")].alias("col_class"),
                       "unique_values", "missing_count",
                       F.round(F.col("missing_count") * 100.0 / F.col("_N"), 2).alias("missing_pct"))


def key_set_mismatch(dim: DataFrame, dim_key: str, fact: DataFrame, fact_key: str) -> DataFrame:
    """Keys present on only one side (full outer join of the two
    distinct key sets); equality of the sets <=> no rows."""
    a = dim.select(F.col(dim_key).alias("key")).distinct().withColumn("in_dim", F.lit(True))
    b = fact.select(F.col(fact_key).alias("key")).distinct().withColumn("in_fact", F.lit(True))
    j = a.join(b, "key", "full")
    return j.select("key", F.coalesce("in_dim", F.lit(False)).alias("in_dim"),
                    F.coalesce("in_fact", F.lit(False)).alias("in_fact")) \
            .where(~(F.col("in_dim") & F.col("in_fact")))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """C10 companion: exact distinct count per column, one row per column."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "col_name", "value")
    return (long.where(F.col("value").isNotNull()).groupBy("col_name", "value").agg(F.lit(1).alias("_o"))
            .groupBy("col_name").agg(F.count(F.lit(1)).cast("bigint").alias("distinct_count")))


def validation_status(presence: DataFrame, nulls: DataFrame, fk: DataFrame,
                      dates: DataFrame, ranges: DataFrame) -> DataFrame:
    """One (check_name, passed) row per check plus ``overall`` =
    every check passed.  The status is data; gating on it is the caller's
    choice (the reference only logs it)."""
    rows = (presence.select(F.concat(F.lit("required_columns:"), "dataset").alias("check_name"),
                            F.col("all_required_present").alias("passed"))
            .unionByName(nulls.select(F.concat(F.lit("critical_nulls:"), "col_name").alias("check_name"),
                                      (F.col("missing_count") == 0).alias("passed")))
            .unionByName(fk.select(F.concat(F.lit("fk:"), "fk_column").alias("check_name"),
                                   (F.col("invalid_count") == 0).alias("passed")))
            .unionByName(dates.select(F.explode(F.array(
                F.struct(F.lit("date_range:year").alias("check_name"), F.col("valid_year_range").alias("passed")),
                F.struct(F.lit("date_range:month").alias("check_name"), F.col("valid_month_range").alias("passed")),
                F.struct(F.lit("date_range:day").alias("check_name"), F.col("valid_day_range").alias("passed"))))
                .alias("s")).select("s.*"))
            .unionByName(ranges.select(F.concat(F.lit("range:"), "col_name").alias("check_name"),
                                       (F.col("invalid_count") == 0).alias("passed"))))
    rows = cut_lineage(rows)   # a row per check; the checks must not run again for the overall row
    overall = rows.agg(F.lit("overall").alias("check_name"), F.bool_and("passed").alias("passed"))
    return rows.unionByName(overall)
