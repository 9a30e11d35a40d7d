import collections
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import prose, words

from contrail.llm import dart_minhash as M
from contrail.llm.words import U64, split_words


def shingles(t):
    w = tuple(words(t))
    return frozenset(w[i:i + 5] for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([w])


def brute(rows, similarity=0.8):
    """Class of every row by all pairs of different texts."""
    rep = {}
    for d, t, *_ in sorted((r for r in rows if r[0] is not None and words(r[1])), key=lambda r: r[0]):
        rep.setdefault(tuple(words(t)), d)
    sets, parent = {d: shingles(" ".join(w)) for w, d in rep.items()}, {d: d for d in rep.values()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return sorted(((d, d if d is None or not words(t) else find(rep[tuple(words(t))])) for d, t, *_ in rows), key=repr)


def classes(docs, **more):
    return sorted(((r["doc_id"], r["class_id"]) for r in M.near_duplicate_classes(docs, **more).collect()), key=repr)


def test_matches_brute_force(hard_docs, hard_rows):
    assert classes(hard_docs) == brute(hard_rows)


@pytest.mark.parametrize("with_original", [True, False])
def test_large_group_and_chains(spark, with_original):
    """Near copies of one original that aren't near each other, and chains of small changes."""
    rng = random.Random(8)
    original = prose(rng, 146).split()
    rows = [(1000, " ".join(original))] if with_original else []
    for i in range(150):
        w = list(original)
        for k in rng.sample(range(len(w)), 1 + i % 5):
            w[k] = f"new{i}x{k}" if i % 7 else f"same{k}"  # some copies make the same change
        rows.append((i, " ".join(w)))
    chain = prose(rng, 150).split()
    for i in range(30):
        chain[5 * i % 150] = f"step{i}"
        rows.append((2000 - i, " ".join(chain)))
    rows += [(3000 + i, prose(rng, 50)) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert classes(docs) == brute(rows)


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    elements = rng.integers(0, 1 << 62, 60).astype(U64)
    a, b = rng.choice([0, 0.3, 1, 2.5, 7], 60), rng.choice([0, 0.3, 1, 2.5, 7], 60)
    rows = np.repeat([0, 1], [int((a > 0).sum()), int((b > 0).sum())])
    sig = M.signatures(rows, np.concatenate([elements[a > 0], elements[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 3, 4000)
    exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.04 and not sig[2].any()


def test_shingle_sets():
    texts = ["a b c d e f a b c d e", "x y", None, "", "x y"]
    rows, grams, counts = M.shingle_sets(split_words(pa.array(texts)), 5)
    assert collections.Counter(rows.tolist()) == {0: 6, 1: 1, 4: 1} and sorted(counts[rows == 0].tolist()) == [1, 1, 1, 1, 1, 2]
    assert grams[rows == 1] == grams[rows == 4]


def test_empty(no_docs, spark):
    assert M.near_duplicate_classes(no_docs).count() == 0
    lonely = spark.createDataFrame([(1, None), (2, ""), (None, "a")], "doc_id long, text string")
    assert classes(lonely) == [(1, 1), (2, 2), (None, None)]


def test_texts_pasted_several_times(spark):
    """The similarity is that of sets: a text is a near copy of itself pasted in a row."""
    rng = random.Random(12)
    rows = []
    for i, times in enumerate([2, 3, 4, 8] * 5):
        text = prose(rng, 104)
        rows += [(2 * i, text), (2 * i + 1, " ".join([text] * times))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = classes(docs)
    assert got == brute(rows) and all(c == d - d % 2 for d, c in got)


def test_spanning_links(spark):
    """The links reported are those that held the class together: fewer than all near pairs, at least a tree."""
    rng = random.Random(6)
    base = prose(rng, 120).split()
    rows = [(i, " ".join([*base[:60], f"new{i}", *base[61:]])) for i in range(20)]
    got = M.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "class_id", "n_spanning_links"]
    links = [r["n_spanning_links"] for r in got.collect()]
    assert min(links) >= 1 and 2 * 19 <= sum(links) < 20 * 19
