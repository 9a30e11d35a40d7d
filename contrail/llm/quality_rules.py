"""Quality rules and robust multivariate outliers per language and source.

Four statistics of a text (word length, symbols, repeated lines, repeated
words) are turned into rates shrunk towards a typical value, so a short text
is not extreme by chance, then into logarithms and square roots.  For every
(language, source) the minimum-covariance-determinant estimate of centre and
covariance is found by concentration steps: keep the share ``h`` of documents
with the smallest Mahalanobis distances, re-estimate, repeat until no group's
determinant moves.  A document is rejected if a base rule fails or if its
distance to its group's estimate is over ``cutoff(tail)``, which a normal
vector exceeds with the probability ``tail``: by default less than one clean
document in 10^11.  Only DataFrame functions are used.

Every (language, source) has an estimate of its own.  The documents kept of
its language weigh in it like ``prior`` documents, and those of the whole table
like ``prior`` documents in the language's: with few documents it is close to
its language's, with many nearly its own, without a switch between.  A floor
under every variance (``FLOORS``) keeps groups of clean documents, whose rates
hardly vary, from rejecting a text for one symbol or one repeated line.

Tables with a row per group are checkpointed in a file per ``GROUPS_A_FILE``
groups, not one per shuffle partition: on a local file system without Hadoop's
native library every file costs a process, started from the executor.

Defined results: a null or empty text has no words and fails the base rules.
Null languages and sources are groups of their own.  Rows with equal values
get equal verdicts.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.mixture import SYMBOLS
from contrail.session import cut_lineage

SPACES = r"[\x20\x09-\x0D]+"
GRAM = 5
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VECTOR = ("x1", "x2", "x3", "x4")
# Least standard deviation of each entry of the vector: differences below this are no evidence.
FLOORS = (0.06, 0.12, 0.12, 0.08)
# Of the covariance of the 75 % of a 4-variate normal closest to its centre, so that it estimates the whole.
CONSISTENCY = 1.49
SALTS = 64
GROUPS_A_FILE = 20_000


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` without its text, with the base statistics (long) of each text."""
    keep = [c for c in docs.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    cut = docs.select(*keep, F.array_remove(F.split(text, SPACES), "").alias("words"),
                      F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
                      F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    hashed = cut.select(*keep, "n_symbols", F.size("words").cast("long").alias("n_words"),
                        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                        F.transform("words", lambda x: F.xxhash64(x)).alias("hashes"))
    h = F.col("hashes")
    grams = F.when(F.size(h) >= GRAM, F.transform(
        F.slice(h, 1, F.size(h) - (GRAM - 1)), lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, GRAM)])))
    grammed = hashed.select(*keep, "n_symbols", "n_words", "word_chars", "n_dup_lines", grams.alias("grams"))
    some = F.size("grams") > F.size(F.array_distinct("grams"))  # most texts repeat nothing: no sort for them
    ordered = grammed.select(*keep, "n_symbols", "n_words", "word_chars", "n_dup_lines", F.when(some, F.sort_array(
        F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))).alias("by_gram"))
    b = F.col("by_gram")
    starts = F.sort_array(F.transform(F.filter(b, lambda x, k: F.coalesce(
        F.get(b, k - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get(b, k + 1)["g"] == x["g"], F.lit(False))), lambda x: x["i"]))
    started = ordered.select(*keep, "n_symbols", "n_words", "word_chars", "n_dup_lines", starts.alias("starts"))
    s = F.col("starts")
    covered = F.aggregate(F.transform(s, lambda x, k: F.least(F.lit(GRAM), F.coalesce(F.get(s, k + 1) - x, F.lit(GRAM)))),
                          F.lit(0), lambda a, x: a + x)
    return started.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def vector() -> list[Column]:
    """Shrunk and transformed rates; 100 words of a typical text stand in for what a short one lacks."""
    words = F.col("n_words") + 100
    return [F.log((F.col("word_chars") + 500) / words).alias("x1"),
            F.log1p(20 * F.col("n_symbols") / words).alias("x2"),
            F.log1p(20 * F.col("n_dup_lines") / words).alias("x3"),
            F.sqrt(F.col("n_repeat_words") / words).alias("x4")]


PAIRS = [(i, j) for i in range(4) for j in range(i + 1)]
MOMENTS = [f"m{i}" for i in range(4)] + [f"s{i}{j}" for i, j in PAIRS]


def cutoff(tail: float) -> float:
    """The squared distance that a 4-variate normal vector exceeds with the probability ``tail``."""
    low, high = 0.0, 2000.0
    for _ in range(100):
        x = (low + high) / 2
        low, high = (x, high) if math.exp(-x / 2) * (1 + x / 2) > tail else (low, x)
    return high


def _cut_groups(df: DataFrame, files: int) -> DataFrame:
    """``df``, a row per group, checkpointed in ``files`` files; it is computed before, in all partitions."""
    return cut_lineage(df.repartition(files))


def _estimates(rows: DataFrame, groups: DataFrame, prior: float, files: int) -> DataFrame:
    """Centre, lower Cholesky factor of the floored covariance and log determinant of each of ``groups`` (g, l).

    ``rows`` are the documents kept.  Their moments are mixed by numbers of
    documents: a group's with its language's, a language's with the table's.
    """
    x = [F.col(c) for c in VECTOR]
    sums = [F.sum(c).alias(f"m{i}") for i, c in enumerate(x)] + [F.sum(x[i] * x[j]).alias(f"s{i}{j}") for i, j in PAIRS]
    own = _cut_groups(rows.groupBy("g").agg(F.count("*").alias("n"), *sums), files)
    own = groups.join(own, "g", "left").fillna(0, ["n", *MOMENTS])
    langs = own.groupBy("l").agg(*[F.sum(c).alias(c) for c in ("n", *MOMENTS)])
    every = langs.agg(*[(F.sum(c) / F.nullif(F.sum("n"), F.lit(0))).alias(c) for c in MOMENTS]).first()
    langs = langs.select("l", *[((F.col(c) + prior * F.lit(every[c]).cast("double")) / (F.col("n") + prior)).alias(f"{c}_l") for c in MOMENTS])
    moments = own.join(langs, "l").select(
        "g", *[((F.col(c) + prior * F.col(f"{c}_l")) / (F.col("n") + prior)).alias(c) for c in MOMENTS])
    for i, j in PAIRS:
        cov = CONSISTENCY * (F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}"))
        done = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        if i == j:
            new = F.sqrt(F.greatest(F.greatest(cov, F.lit(0.0)) + F.lit(FLOORS[i] ** 2) - done, F.lit((FLOORS[i] / 10) ** 2)))
        else:
            new = (cov - done) / F.col(f"l{j}{j}")
        moments = moments.withColumn(f"l{i}{j}", new)
    det = sum((2 * F.log(f"l{i}{i}") for i in range(4)), F.lit(0.0))
    return moments.select("g", *[f"m{i}" for i in range(4)], *[f"l{i}{j}" for i, j in PAIRS], det.alias("det"))


def _with_distance(rows: DataFrame, est: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance of each row to its group's estimate, by forward substitution.

    The few estimates are repeated per salt, so a group with a third of all
    rows meets them in many tasks.
    """
    salted = est.drop("det").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = rows.join(salted, ["g", "salt"])
    z: list[Column] = []
    for i, c in enumerate(VECTOR):
        joined = joined.withColumn(f"z{i}", (F.col(c) - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * z[k] for k in range(i)), F.lit(0.0))) / F.col(f"l{i}{i}"))
        z.append(F.col(f"z{i}"))
    return joined.withColumn("distance", sum((v * v for v in z), F.lit(0.0))).select(*rows.columns, "distance")


def _group_keys(stats: DataFrame) -> DataFrame:
    """Adds ``g``, the (language, source) of a row, ``l``, its language, and a salt."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    salt = F.pmod(F.xxhash64(*STATS, "doc_id"), F.lit(SALTS)).cast("int")
    return stats.select("*", F.concat_ws("\n", F.length(name("lang")), name("lang"), name("source")).alias("g"), name("lang").alias("l"), salt.alias("salt"))


def judge(docs: DataFrame, h: float = 0.75, tail: float = 1e-11, prior: float = 100.0, still: float = 0.02, max_steps: int = 12) -> DataFrame:
    """Statistics, ``base_failed``, ``distance`` and ``kept`` of every row, its text left out.

    Documents that fail a base rule take no part in the estimates.  The steps
    end when no group's log determinant moves by more than ``still``, or after
    ``max_steps``.  Columns besides ``doc_id, text, lang, source`` come back in
    a struct ``rest``, so none can clash with a name used here.
    """
    named = ("doc_id", "text", "lang", "source")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in named]
    docs = docs.select(*named, *([F.struct(*others).alias("rest")] if others else []))
    rows = text_statistics(docs).withColumn("base_failed", base_failed()).select("*", *vector())
    rows = cut_lineage(_group_keys(rows))
    groups = rows.select("g", "l").distinct()
    files = 1 + groups.count() // GROUPS_A_FILE
    groups = _cut_groups(groups, files)
    sound = rows.where(~F.col("base_failed")).select("g", "salt", *VECTOR)
    # The first subset lies closest to the medians.
    middle = sound.groupBy("g").agg(*[F.percentile_approx(c, 0.5, 1000).alias(f"m{i}") for i, c in enumerate(VECTOR)])
    est = _cut_groups(middle.select("*", *[F.lit(FLOORS[i] if i == j else 0.0).alias(f"l{i}{j}") for i, j in PAIRS], F.lit(None).cast("double").alias("det")), files)
    for _ in range(max_steps):
        near = _with_distance(sound, est)
        limits = _cut_groups(near.groupBy("g").agg(F.percentile_approx("distance", h, 1000).alias("limit")), files)
        salted = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        new = _cut_groups(_estimates(near.join(salted, ["g", "salt"]).where("distance <= limit"), groups, prior, files), files)
        moved = new.join(est.select("g", F.col("det").alias("before")), "g").agg(F.max(F.coalesce(F.abs(F.col("det") - F.col("before")), F.lit(1e9)))).first()[0]
        est = new
        if moved is None or moved <= still:
            break
    judged = _with_distance(rows, est)
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff(tail), F.lit(False))).drop("g", "l", "salt", *VECTOR)
