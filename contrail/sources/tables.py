"""Scans and sinks (inventory A1-A9).

Scans are lazy; nothing here triggers a job except the sinks.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")


def load_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet scan of one table (``{base}/{name}.parquet``), NaN read as missing."""
    return nan_to_null(spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet"))


class Tables(dict):
    """Lazy multi-source scan (A2): ``tables["orders"]`` scans on first use."""

    def __init__(self, spark: SparkSession, base: str):
        super().__init__()
        self.spark = spark
        self.base = base

    def __missing__(self, name: str) -> DataFrame:
        df = load_table(self.spark, self.base, name)
        self[name] = df
        return df

    def stream(self, name: str) -> DataFrame:
        """The same table as a file stream, with the schema of the scan."""
        path = f"{self.base.rstrip('/')}/{name}.parque[t]"  # a pattern, as a stream may not name a single file
        return nan_to_null(self.spark.readStream.schema(self[name].schema).parquet(path))

    def derived(self, name: str, build) -> DataFrame:
        """A DataFrame derived from these tables, built once and reused."""
        key = f"__{name}"
        if key not in self:
            self[key] = build(self)
        return self[key]


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """pandas reads blank and the text ``NaN`` as one missing marker; Spark
    keeps NaN as a value (and ``NaN > 15`` is true).  Map NaN to NULL on
    every floating column so later predicates follow the null rules."""
    fl = (T.DoubleType, T.FloatType)
    targets = [f.name for f in df.schema.fields
               if isinstance(f.dataType, fl) and (columns is None or f.name in columns)]
    if not targets:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType))
                           for c in targets})


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   header: bool = True) -> DataFrame:
    """CSV scan with header and an explicit schema (A1).

    No schema inference (that is a full extra pass over the files); text
    ``NaN`` is parsed as NaN and then mapped to NULL.
    """
    df = (spark.read.schema(schema)
          .option("header", str(header).lower())
          .option("mode", "PERMISSIVE")
          .option("nanValue", "NaN")
          .csv(path))
    return nan_to_null(df)


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = (),
                fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Table sink (A3, A6).  Partition columns let later reads prune."""
    w = df.write.mode(mode).format(fmt)
    parts = list(partition_by)
    if parts:
        w = w.partitionBy(*parts)
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(path)
    return path


def route_rows(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """Row-level quarantine (A4): rows passing ``rule`` and the rest.

    A NULL rule result counts as failing, so nothing is lost.
    """
    ok = F.coalesce(rule, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def quarantine_rows(df: DataFrame, rules: dict[str, Column], path: str) -> dict[str, int]:
    """Row quarantine in one pass (A4): all rows go to ``path``, partitioned by
    ``quality`` (``validated`` / ``invalidated``), with the names of the broken
    rules in ``broken``.  Returns the counts of both and per rule, observed by
    the writing job itself.  A NULL rule result counts as broken.
    """
    from pyspark.sql import Observation
    seen = Observation("quarantine")
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()]))
    rows = df.withColumn("broken", F.array_join(broken, ","))
    rows = rows.withColumn("quality", F.when(F.col("broken") == "", "validated").otherwise("invalidated"))
    counts = [F.count_if(F.col("broken") == "").alias("validated"), F.count_if(F.col("broken") != "").alias("invalidated"),
              *[F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()]]
    rows.observe(seen, *counts).write.mode("overwrite").partitionBy("quality").parquet(path)
    return {k: int(v) for k, v in seen.get.items()}


def write_clustered(df: DataFrame, path: str, partition_by: Iterable[str], order_by: Iterable[str] = (), watched=lambda rows: rows) -> str:
    """Partitioned table whose rows were dealt out by ranges of the partition
    columns first (A3, A6): about one file per folder and task instead of one
    per folder in every task, and a large folder is still written by many tasks.
    ``watched`` may observe the rows as they are written (below the range
    exchange they also pass its sampling job, and would count twice).
    """
    parts = list(partition_by)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    watched(df.repartitionByRange(n, *parts, *order_by)).write.mode("overwrite").partitionBy(*parts).parquet(path)
    return path


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Table bucketed and sorted by ``key`` (A3): joins of two such tables on the key need no exchange."""
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .format("parquet").saveAsTable(table))
    return df.sparkSession.table(table)


def route_dataset(df: DataFrame, is_valid: bool, base: str, name: str,
                  fmt: str = "parquet") -> str:
    """Whole-dataset routing to ``validated/`` or ``invalidated/`` (A4)."""
    sub = "validated" if is_valid else "invalidated"
    return write_table(df, f"{base.rstrip('/')}/{sub}/{name}", fmt=fmt)


def head_sample(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows by an explicit order key (A5, A7 preview).

    Spark has no file row order, so the order key is required.  The plan is
    a TakeOrderedAndProject: each task keeps its own top ``n``.
    """
    return df.orderBy(*order_by).limit(n)


def export_ordered(df: DataFrame, path: str, order_by: str, fmt: str = "csv") -> str:
    """Export every row ordered by ``order_by`` (A9).  Range partitioned
    sort, so the files are globally ordered part by part."""
    w = df.orderBy(order_by).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(path)
    return path


def report_sink(report: DataFrame, path: str) -> str:
    """Reports are DataFrames; persist them as JSON lines (A8).  A report of any size keeps its partitions."""
    report.write.mode("overwrite").json(path)
    return path
