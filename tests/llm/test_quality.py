import collections
import pathlib
import random

import numpy as np
import pytest
from llm_texts import prose, words
from pyspark.sql import functions as F

from contrail.llm import quality_classifier as Q
from contrail.llm.quality_rules import STATS, cutoff, judge

SF = "/root/testdata/sf0.01"


def statistics(t):
    w = words(t)
    n = len(w)
    grams = [tuple(w[i:i + 5]) for i in range(n - 4)]
    seen, covered = collections.Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (t or "").split("\n") if words(x)]
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered)


def mcd(groups, h=0.75, prior=100):
    """Squared distances of the rows of each (lang, source), with exact order statistics and many steps."""
    floor = np.diag(np.square([0.06, 0.12, 0.12, 0.08]))
    at = lambda v, p: np.sort(v)[max(0, int(np.ceil(p * len(v))) - 1)]
    far = lambda x, m, s: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
    est = {g: (np.array([at(c, 0.5) for c in x.T]), floor) for g, x in groups.items()}
    for _ in range(40):
        near = {g: x[far(x, *est[g]) <= at(far(x, *est[g]), h)] for g, x in groups.items()}
        total = lambda xs: (sum(len(x) for x in xs), sum(x.sum(0) for x in xs), sum(x.T @ x for x in xs))
        n0, m0, s0 = total(list(near.values()))
        est = {}
        for g, x in near.items():
            n, m, s = total([y for k, y in near.items() if k[0] == g[0]])
            m, s = (m + prior * m0 / n0) / (n + prior), (s + prior * s0 / n0) / (n + prior)
            m, s = (x.sum(0) + prior * m) / (len(x) + prior), (x.T @ x + prior * s) / (len(x) + prior)
            est[g] = m, 1.49 * (s - np.outer(m, m)) + floor
    return {g: far(x, *est[g]) for g, x in groups.items()}


def vectors(part):
    s = np.array([[r[c] for c in STATS] for r in part], dtype=float)
    n = s[:, 0] + 100
    return np.stack([np.log((s[:, 1] + 500) / n), np.log1p(20 * s[:, 2] / n), np.log1p(20 * s[:, 3] / n), np.sqrt(s[:, 4] / n)], axis=1)


def test_statistics_and_rules(hard_docs, hard_rows):
    got = sorted((tuple(r[c] for c in ("doc_id", *STATS)) for r in judge(hard_docs.select("doc_id", "text", "lang", "source")).collect()), key=repr)
    assert got == sorted(((d, *statistics(t)) for d, t, *_ in hard_rows), key=repr)


def test_rejects_outliers_as_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randint(30, 90)).replace(" ", "### " if i % 25 == 0 else " "), "en", "a") for i in range(300)]
    rows += [(1000 + i, "\n".join([prose(rng, 3)] * 1 + [prose(rng, 60)]), "de", None) for i in range(150)]
    got = {r["doc_id"]: r for r in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(r["base_failed"] for r in got.values())
    parts = {("en", "a"): [got[i] for i in range(300)], ("de", None): [got[i] for i in range(1000, 1150)]}
    want = mcd({g: vectors(part) for g, part in parts.items()})
    for g, part in parts.items():
        assert np.allclose([r["distance"] for r in part], want[g], rtol=0.05, atol=0.05)
    assert {i for i, r in got.items() if not r["kept"]} == {i for i in range(0, 300, 25)}


def test_group_tables_are_few_files(spark):
    """A file is a process on a local file system: shuffle partitions and steps must not multiply them."""
    rng = random.Random(8)
    rows = [(i, prose(rng, 30 + i), "en" if i % 3 else "de", "ab"[i % 2]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(2)
    folder = pathlib.Path(spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:"))
    parts = lambda: {x for x in folder.rglob("part-*")}
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    before = parts()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = judge(docs, max_steps=3).count()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert got == 60
    assert 0 < len(parts() - before) <= 2 + 2 + 3 * 3


def test_small_groups_have_estimates_of_their_own(spark):
    """Each source of eight documents has symbols in most of its texts; a text with as many stands out elsewhere, and more so the more documents are plain."""
    rng = random.Random(2)
    symbols = lambda: prose(rng, 60).replace(" ", " # ", 12)
    rows = [(i, symbols() if i < 8 else prose(rng, 60), "en", "few" if i < 8 else "many") for i in range(400)] + [(900, symbols(), "en", "many")]
    rows += [(500 + i, prose(rng, 60), "de", None) for i in range(5)]
    got = {r["doc_id"]: r["distance"] for r in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert max(got[i] for i in range(8)) < got[900]
    groups = {("en", "few"): range(8), ("en", "many"): [*range(8, 400), 900], ("de", None): range(500, 505)}
    stats = {d: (statistics(t)) for d, t, *_ in rows}
    want = mcd({g: vectors([dict(zip(STATS, stats[d])) for d in ids]) for g, ids in groups.items()})
    for g, ids in groups.items():
        assert np.allclose([got[d] for d in ids], want[g], rtol=0.08, atol=0.08)


def test_cutoff_is_the_quantile():
    x = (np.random.default_rng(1).normal(size=(400_000, 4)) ** 2).sum(1)
    for tail in (0.2, 0.05, 0.01):
        assert abs((x > cutoff(tail)).mean() - tail) < 0.05 * tail + 5e-4


def test_other_columns_come_back_whatever_their_names(hard_docs):
    """Every row of the table with clashing names gets the verdict it gets without them."""
    plain = judge(hard_docs.select("doc_id", "text", "lang", "source"))
    named = judge(hard_docs)
    cols = ["doc_id", *STATS, "base_failed", "kept"]
    assert sorted(map(repr, named.select(cols).collect())) == sorted(map(repr, plain.select(cols).collect()))
    assert named.select("rest.*").columns == [c for c in hard_docs.columns if c not in ("doc_id", "text", "lang", "source")]


def test_judge_empty(no_docs):
    assert judge(no_docs.select("doc_id", "text", "lang", "source")).count() == 0


def test_isotonic():
    x, y = np.arange(6.0), np.array([0, 1, 0, 1, 1, 0.5])
    knots, values = Q.isotonic(x, y, np.ones(6))
    fitted = np.interp(x, knots, values)
    assert (np.diff(fitted) >= 0).all() and np.allclose(fitted, [0, 0.5, 0.5, 2.5 / 3, 2.5 / 3, 2.5 / 3])


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = Q.score_quality(spark.read.parquet(f"{SF}/documents.parquet"), labels.select("doc_id", F.col("quality").alias("label")))
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50 and np.mean([(r["score"] >= 0.3) == (r["quality"] == 1) for r in rows]) >= 0.95


@pytest.mark.parametrize("label", [None, 1])
def test_few_labels(spark, hard_docs, hard_rows, label):
    labels = spark.createDataFrame([(i, label) for i in range(1, 30)], "doc_id long, label int")
    rows = Q.score_quality(hard_docs, labels).collect()
    assert len(rows) == len(hard_rows) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0.5 for r in rows) if label is None else all(r["score"] > 0.9 for r in rows)
    assert all(r["held_out"] for r in rows if r["doc_id"] is None)


def test_no_documents(spark, no_docs):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, label int")
    assert Q.score_quality(no_docs, labels).count() == 0


def test_kernel_approximation():
    f = Q.Fourier(np.zeros(4), np.ones(4), 6000, 2.0, 1)
    x, y = np.array([[0.1, 0.2, -1, 0.5]]), np.array([[1, 0.2, -0.5, 0.0]])
    assert abs((f(x)[:, :-1] @ f(y)[:, :-1].T)[0, 0] - np.exp(-((x - y) ** 2).sum() / 8)) < 0.05
