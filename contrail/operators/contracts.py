"""Schema contracts and row predicates (inventory B1-B11).

A contract check reads only ``df.schema`` -- no Spark job runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    name: str
    required: tuple[str, ...]
    numeric: tuple[str, ...] = field(default_factory=tuple)


# The reference's five contracts (required columns, numeric checks).
FLIGHTS = Contract("flights", (
    "YEAR", "MONTH", "DAY", "DAY_OF_WEEK",
    "AIRLINE", "FLIGHT_NUMBER",
    "ORIGIN_AIRPORT", "DESTINATION_AIRPORT",
    "SCHEDULED_DEPARTURE", "DEPARTURE_TIME", "DEPARTURE_DELAY",
    "SCHEDULED_ARRIVAL", "ARRIVAL_TIME", "ARRIVAL_DELAY",
    "DISTANCE"), ("ARRIVAL_DELAY", "DISTANCE"))
AIRPORTS = Contract("airports", ("IATA_CODE", "AIRPORT", "CITY", "STATE", "COUNTRY",
                                 "LATITUDE", "LONGITUDE"), ("LATITUDE", "LONGITUDE"))
AIRLINES = Contract("airlines", ("IATA_CODE", "AIRLINE"))
HOLIDAYS = Contract("holidays", ("date", "holiday_name", "is_holiday"))
WEATHER = Contract("weather", ("date", "AWND", "TMAX", "TMIN", "PRCP"))
REFERENCE_CONTRACTS = (FLIGHTS, AIRPORTS, AIRLINES, HOLIDAYS, WEATHER)


class ContractError(ValueError):
    pass


def check_contract(df: DataFrame, contract: Contract) -> bool:
    """Raise on the first violation (missing columns, then a
    required-numeric column that is not numeric); True otherwise."""
    missing = [c for c in contract.required if c not in df.columns]
    if missing:
        raise ContractError(f"{contract.name}: missing required columns: {missing}")
    for c in contract.numeric:
        if not isinstance(df.schema[c].dataType, T.NumericType):
            raise ContractError(f"{contract.name}: {c} must be numeric")
    return True


def check_all(frames: dict[str, DataFrame], contracts: Sequence[Contract]) -> bool:
    """Every contract at once, failing fast before any job runs.

    All violations are named in one error: a missing table, its missing
    required columns and its required-numeric columns of another type."""
    problems = []
    for contract in contracts:
        df = frames.get(contract.name)
        if df is None:
            problems.append(f"{contract.name}: no such table")
            continue
        missing = [c for c in contract.required if c not in df.columns]
        if missing:
            problems.append(f"{contract.name}: missing required columns: {missing}")
        problems += [f"{contract.name}: {c} must be numeric" for c in contract.numeric
                     if c in df.columns and not isinstance(df.schema[c].dataType, T.NumericType)]
    if problems:
        raise ContractError("; ".join(problems))
    return True


PRESENCE_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("required_columns_count", T.LongType()),
    T.StructField("existing_columns_count", T.LongType()),
    T.StructField("missing_columns", T.StringType()),
    T.StructField("missing_columns_count", T.LongType()),
    T.StructField("extra_columns", T.StringType()),
    T.StructField("all_required_present", T.BooleanType()),
])


def presence_row(df: DataFrame, name: str, required: Sequence[str]) -> tuple:
    have, need = set(df.columns), set(required)
    missing, extra = sorted(need - have), sorted(have - need)
    return (name, len(need), len(have), ",".join(missing), len(missing), ",".join(extra), not missing)


def column_presence(spark: SparkSession, frames: dict[str, DataFrame],
                    required: dict[str, Sequence[str]]) -> DataFrame:
    """One report row per table; never raises.  Lists are sorted and
    comma-joined so the report is deterministic."""
    rows = [presence_row(frames[n], n, cols) for n, cols in required.items()]
    return spark.createDataFrame(rows, PRESENCE_SCHEMA)


def out_of_range(c: Column | str, lo: float, hi: float) -> Column:
    """Strictly outside [lo, hi]; null is *not* out of range."""
    x = F.col(c) if isinstance(c, str) else c
    return F.coalesce((x < lo) | (x > hi), F.lit(False))


def project_features(df: DataFrame, features: Sequence[str], target: str) -> tuple[DataFrame, list[str]]:
    """The available subset of ``features`` plus the target, and the
    list of requested features that are missing."""
    have = [c for c in features if c in df.columns]
    missing = [c for c in features if c not in df.columns]
    return df.select(*have, target), missing


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """B10 log line as data: mean, exact median, sample std of the target.
    The median comes from the distributed order statistics (a scalar)."""
    from contrail.operators.ordered import medians
    med = medians(df, [target])[target]
    return df.agg(F.avg(target).alias("target_mean"),
                  F.lit(med).cast("double").alias("target_median"),
                  F.stddev_samp(target).alias("target_std"))


def drop_role_duplicates(df: DataFrame, marker: str, keep: str) -> DataFrame:
    """Drop every column containing ``marker`` except ``keep``."""
    return df.drop(*[c for c in df.columns if marker in c and c != keep])
