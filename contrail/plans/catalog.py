"""Registry of named queries (one per inventory operator) and their ANSI SQL
oracles.  ``__spark_entry__`` exposes both to the driver.

Every query reads the driver's tables from ``sf_dir`` and runs over whole
tables.  Doubles are rounded to 6 places on both sides so that summation
order does not change the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DIGITS = 6


def query(name: str, sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(Tables(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (and doubles inside arrays)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.DoubleType):
            out.append(F.transform(F.col(f.name), lambda x: F.round(x, digits)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
