"""Registry of the subpackage: one query per operator, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MODULES = ("q_substring", "q_mixture", "q_quality_rules", "q_minhash", "q_decontamination", "q_quality_classifier", "q_chat_format", "q_toxicity", "q_html", "q_language_model", "q_phrases", "q_exact", "q_trie")


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load() -> tuple[dict, dict]:
    for m in MODULES:
        importlib.import_module(f"contrail.llm.{m}")
    return QUERIES, ORACLE
