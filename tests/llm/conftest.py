import random

import pytest

from llm_texts import prose

# Names of columns that operators make for themselves.
CLASHING = ("marks", "rest", "row", "text_key", "g", "salt", "key", "bucket", "size", "kept", "x", "label", "score", "part", "n_words", "class_id")


@pytest.fixture(scope="session")
def hard_rows():
    """Documents with nulls, empty and long texts, copies, repeated rows and ties."""
    rng = random.Random(4)
    base = prose(rng, 120)
    passage = prose(rng, 30)
    near = base.split()
    near[60] = "changed"
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (3, " ".join(near), "en", "b"), (4, None, "en", "a"), (5, "", None, "b"),
            (6, " \n\t ", "en", None), (None, base, "en", "a"), (7, "one two", "de", "b"), (8, passage + " " + prose(rng, 40), "de", "b"),
            (9, prose(rng, 25) + "\n" + passage, "de", None), (9, prose(rng, 25) + "\n" + passage, "de", None), (10, prose(rng, 30_000), "en", "a"),
            (11, " ".join(["again"] * 50), "en", "c"), (12, "[INST] </s> \\ <s>", None, None), (13, "é" * 40 + " ü ß " + prose(rng, 15), "fr", "c")]
    rows += [(20 + i, prose(rng, 60), "en", "abc"[i % 3]) for i in range(12)]
    return rows


@pytest.fixture(scope="session")
def hard_docs(spark, hard_rows):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(hard_rows, "doc_id long, text string, lang string, source string").repartition(3)
    return docs.select("*", F.length("text").cast("long").alias("n_chars"), *[F.lit("x").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(hard_docs):
    return hard_docs.limit(0)
