"""Features as of a moment, and rolling ones (inventory E4, H21, W1).

* ``as_of_join``: every row takes the latest right row of its key before its
  own time.  Both sides are put into one stream per (key, time bucket), ordered
  by time, and a row takes the last right row before it; what lies in earlier
  buckets is carried over by a table of one row per (key, bucket).  A key with a
  third of all rows is spread over its buckets, and the big side is shuffled
  once: the carry join is on the partitioning the window has anyway.
* ``cumulative_stats``: per (key, date) the statistics up to and including it;
  joined as of, strictly before, they are the leakage-safe statistics (E4) for
  any row, also on dates without a statistics row (scoring).
* ``rolling_stats``: frames in days over per-day aggregates, cut into time
  segments that overlap by the frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.features import DELAY_THRESHOLD, delay_flag


def _number(df: DataFrame, column: str) -> Column:
    """Days of a date, microseconds of a timestamp, else the value itself."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(column)).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column).cast("long")


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, right_time: str,
               columns: Sequence[str], bucket: int, strict: bool = True) -> DataFrame:
    """``left`` with ``columns`` of the latest ``right`` row of the same keys whose
    time is before (``strict``) or not after the row's.  No row of ``left`` is lost
    or repeated.  A null time or key finds nothing; of several right rows at one
    time the largest counts.  ``bucket`` is in units of the time (days for a date,
    microseconds for a timestamp).
    """
    keys, columns = list(keys), list(columns)
    kept = [f"_k{i}" for i in range(len(keys))]
    as_keys = [F.col(k).alias(n) for k, n in zip(keys, kept)]
    rows = left.select(*as_keys, _number(left, time).alias("_t"), F.struct(*left.columns).alias("_left"))
    facts = right.select(*as_keys, _number(right, right_time).alias("_t"), F.struct(*columns).alias("_right")).where(F.col("_t").isNotNull())
    slot = F.floor(F.col("_t") / bucket)
    whole = F.lit(True)
    for c in ("_t", *kept):
        whole = whole & F.col(c).isNotNull()
    facts = facts.where(whole).withColumn("_bucket", slot)
    # Rows without a key or time find nothing and are spread by their content, however many they are.
    rows = rows.withColumn("_whole", whole).withColumn("_bucket", F.when(whole, slot).otherwise(F.xxhash64("_left") % 4096))
    # Rights sort behind the rows of their own time if only earlier ones count.
    both = rows.withColumn("_side", F.lit(1)).unionByName(facts.withColumn("_side", F.lit(2 if strict else 0)), allowMissingColumns=True)
    inside = Window.partitionBy(*kept, "_bucket").orderBy("_t", "_side", "_right").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("_found", F.last("_right", ignorenulls=True).over(inside)).where(F.col("_side") == 1)
    ends = facts.groupBy(*kept, "_bucket").agg(F.max_by("_right", F.struct("_t", "_right")).alias("_end"))
    slots = ends.unionByName(rows.select(*kept, "_bucket").distinct(), allowMissingColumns=True).groupBy(*kept, "_bucket").agg(F.first("_end", ignorenulls=True).alias("_end"))
    before = Window.partitionBy(*kept).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = slots.select(*kept, "_bucket", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    out = seen.join(carry, [*kept, "_bucket"], "left")
    found = F.when(F.col("_whole"), F.coalesce("_found", "_carried"))
    return out.select(*[F.col("_left")[c].alias(c) for c in left.columns], *[found[c].alias(c) for c in columns])


def cumulative_stats(df: DataFrame, keys: Sequence[str], date: str, target: str, prefix: str,
                     threshold: float = DELAY_THRESHOLD) -> DataFrame:
    """Per (keys, date): n, mean, sample std and late rate of all rows up to that date.
    The window runs over one row per date, never over raw rows."""
    daily = df.groupBy(*keys, date).agg(
        F.count(target).alias("_n"), F.sum(target).alias("_s"), F.sum(F.col(target) * F.col(target)).alias("_ss"),
        F.sum(delay_flag(target, threshold)).alias("_late"), F.count(F.lit(1)).alias("_rows"))
    upto = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n, s, ss, late, rows = (F.sum(c).over(upto) for c in ("_n", "_s", "_ss", "_late", "_rows"))
    return daily.select(*keys, date, n.alias(f"{prefix}_prior_n"), F.when(n > 0, s / n).alias(f"{prefix}_prior_avg"),
                        F.when(n > 1, F.sqrt(F.greatest((ss - s * s / n) / (n - 1), F.lit(0.0)))).alias(f"{prefix}_prior_std"),
                        (late / rows).alias(f"{prefix}_prior_rate"))


def prior_columns(prefix: str) -> list[str]:
    return [f"{prefix}_prior_{c}" for c in ("n", "avg", "std", "rate")]


def rolling_stats(df: DataFrame, keys: Sequence[str], date: str, target: str, days: int = 7, segment: int = 365) -> DataFrame:
    """W1 per (keys, date): ``rolling_avg`` (mean target of the ``days`` days before), ``rolling_n``,
    ``lag_avg`` (mean of the day before), ``congestion`` (rows of the day) and
    ``congestion_ratio`` (against the mean rows of the days before, days without rows counting 0).
    """
    daily = df.where(F.col(date).isNotNull()).groupBy(*keys, date).agg(F.count(target).alias("_n"), F.sum(target).alias("_s"), F.count(F.lit(1)).alias("congestion"))
    day = F.unix_date(F.col(date))
    own = F.floor(day / segment)
    # The last days of a segment are also context for the next one.
    also = F.floor((day + days) / segment)
    rows = daily.withColumn("_day", day).withColumn("_own", own).withColumn("_seg", F.explode(F.array_distinct(F.array(own, also))))

    def over(first, last):
        return Window.partitionBy(*keys, "_seg").orderBy("_day").rangeBetween(first, last)
    past, yesterday = over(-days, -1), over(-1, -1)
    n, s = F.coalesce(F.sum("_n").over(past), F.lit(0)), F.sum("_s").over(past)
    out = rows.select(
        *keys, date, "_own", "_seg", F.when(n > 0, s / n).alias("rolling_avg"), n.alias("rolling_n"),
        F.try_divide(F.sum("_s").over(yesterday), F.sum("_n").over(yesterday)).alias("lag_avg"), "congestion",
        F.try_divide(F.col("congestion") * F.lit(float(days)), F.sum("congestion").over(past)).alias("congestion_ratio"))
    return out.where(F.col("_seg") == F.col("_own")).drop("_seg", "_own")
