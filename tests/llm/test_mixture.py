import hashlib
import math

import pytest
from llm_texts import words
from pyspark.sql import functions as F

from contrail.llm.mixture import mix_sources


def targets(sizes, weights=(5, 2, 1), most=3):
    """Water filling as it is told: share, stop at the caps, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, free, total = {}, set(order), sum(sizes.values())
    while free:
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return fixed | share
        fixed |= {s: float(most * sizes[s]) for s in over}
        free -= over
    return fixed


def brute(rows):
    def symbols(t):
        return sum(c in "#*$%&|<>" for c in t)
    sized = [(d, s, len(words(t)), max(0.05, 1 - 4 * symbols(t) / len(t)) if t else 1.0) for d, t, _, s in rows]
    sizes = {}
    for _, s, n, _ in sized:
        sizes[s] = sizes.get(s, 0) + n
    goal, out = targets(sizes), []
    for s in sizes:
        mine = []
        for d, s2, n, w in sized:
            if s2 == s:
                u = (int(hashlib.md5(f"{'' if d is None else d}:mix".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
                mine.append((-math.log(u) / w, d is not None, d or 0, n, d))
        epochs = min(3, int(goal[s] // sizes[s])) if sizes[s] else 0
        rest = goal[s] - epochs * sizes[s]
        mine.sort(key=lambda x: x[:4])
        done = [False] * len(mine)
        for _ in range(4):  # the sample, then three fills with what still fits
            gap, filled = rest - sum(x[3] for x, d in zip(mine, done) if d), 0
            for i, (*_, n, _d) in enumerate(mine):
                if not done[i] and n <= gap:
                    filled += n
                    done[i] = filled <= gap
        for (*_, n, d), taken in zip(mine, done):
            out.append((d, s, n, sizes[s], round(goal[s], 4), epochs * n + (n if taken else 0)))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r)[:4] + (round(r["target"], 4), r["taken"]) for r in df.collect()), key=repr)


def test_matches_brute_force(hard_docs, hard_rows):
    got = result(mix_sources(hard_docs))
    assert got == brute(hard_rows) == result(mix_sources(hard_docs.repartition(7)))


@pytest.mark.parametrize("rows_per_step", [1, 100_000])
def test_many_documents(spark, rows_per_step):
    rows = [(i, " ".join(["w"] * (1 + i * 7919 % 50)) + " #" * (i % 9), "en", f"s{min(i % 10, 4)}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mix_sources(docs, rows_per_step=rows_per_step)
    assert result(got) == brute(rows)
    for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("longest")).collect():
        assert abs(r["taken"] - r["target"]) <= r["longest"]
    assert got.where("taken > 3 * size").count() == 0


def test_near_its_target_with_very_long_documents(spark):
    rows = [(i, " ".join(["w"] * (4000 if i % 40 == 0 else 20 + i * 31 % 60)), "en", f"s{i % 3}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mix_sources(docs)
    assert result(got) == brute(rows)
    for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert 0 <= r["target"] - r["taken"] <= max(0.002 * r["target"], 25)


def test_empty(spark, no_docs):
    assert mix_sources(no_docs).count() == 0
    nothing = spark.createDataFrame([(1, None, "en", "a"), (2, "", "en", None)], "doc_id long, text string, lang string, source string")
    assert [(r["target"], r["taken"]) for r in mix_sources(nothing).collect()] == [(0.0, 0)] * 2
