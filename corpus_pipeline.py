"""Corpus pipeline: quality rules, near-duplicates, substrings, benchmark leaks, mixture.

``STAGES`` lists the stages in order.  Each takes ``(spark, docs, sf_dir)``
and returns what it keeps; ``run`` writes each result as Parquet into the
shared checkpoint folder and rereads it as the next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import pipeline_stages as P
from contrail.session import ensure_checkpoint_dir

STAGES = [
    ("quality_rules", P.quality_rules),
    ("near_duplicates", P.near_duplicates),
    ("substring_dedup", P.substring_dedup),
    ("benchmark_decontamination", P.benchmark_decontamination),
    ("mixture", P.mixture),
]

# Robust covariance iterations, verified MinHash candidates and BM25 retrieval are not SQL;
# tests/llm compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
