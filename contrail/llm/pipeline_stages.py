"""Stages of the corpus pipeline over tables shaped like ``documents``.

All stages but the last return the columns of their input.  Rows that agree in
id and text stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.dart_minhash import classes_by_text
from contrail.llm.decontamination import drop_leaks
from contrail.llm.mixture import mix_sources
from contrail.llm.quality_rules import judge
from contrail.llm.queries import table
from contrail.llm.substring_dedup import remove_repeated_passages


def _without(docs: DataFrame, gone: DataFrame, **keys) -> DataFrame:
    """Rows of docs whose keys (name: column of docs) aren't in ``gone``; only the keys of the few are built into tables."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(k) for k, c in keys.items()])
    kept = d.join(gone.select(*keys).distinct().hint("shuffle_hash"), list(keys), "left_anti")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the base rules or the robust outlier test reject; rows equal in id, text, language and source share a verdict."""
    judged = ("doc_id", "text", "lang", "source")
    key = F.xxhash64(*judged)
    verdict = judge(docs.select(*judged, key.alias("row_key")))
    return _without(docs, verdict.where(~F.col("kept")).select("rest.row_key"), row_key=key)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each class; of an id with several texts only those that are copies go."""
    classes = classes_by_text(docs).where("doc_id <> class_id")
    return _without(docs, classes, doc_id=F.col("doc_id"), text_key=F.xxhash64("text"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that start in an earlier document; untouched texts stay byte for byte."""
    kept = remove_repeated_passages(docs, n=13, single_spaced=False)
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.select(*[(columns[c] if c in columns else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mixture takes, repeats included."""
    return mix_sources(docs)
