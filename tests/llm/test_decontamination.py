import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import prose, words

from contrail.llm import decontamination as D

SF = "/root/testdata/sf0.01"
ITEM = "id long, item_id long, text string"


def plain(text):
    return words("".join(c.lower() if c.isalnum() or ord(c) > 127 else " " for c in text or ""))


def test_retrieval_finds_all_passages_over_the_threshold():
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randint(8, 90))) for i in range(60)]
    texts = [prose(rng, rng.randint(0, 300)) for _ in range(40)]
    for k in range(0, 40, 4):
        texts[k] += " " + items[k][1] + " " + prose(rng, 20)
    ix = D.build_index(items)
    w = D.plain_words(pa.array(texts))
    h = w.hashes()
    rows, segments, scores = D.retrieve(ix, w, h, 0.4)
    got = collections.defaultdict(float)
    for r, s, x in zip(rows.tolist(), segments.tolist(), scores.tolist()):
        got[r, s] = max(got[r, s], x)
    impact = collections.defaultdict(dict)  # by segment
    for t in range(len(ix.terms)):
        for p in range(ix.post_at[t], ix.post_at[t + 1]):
            impact[int(ix.post_segment[p])][int(ix.terms[t])] = ix.post_impact[p]
    want = {}
    for r in range(len(texts)):
        mine = h[w.first[r]: w.first[r + 1]].tolist()
        for at in range(0, max(1, len(mine)), D.CHUNK):
            terms = set(mine[at: at + 2 * D.CHUNK])
            for s, of in impact.items():
                score = sum(v for t, v in of.items() if t in terms)
                if score >= 0.4:
                    want[r, s] = max(score, want.get((r, s), 0))
    assert want and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert all(abs(sum(of.values()) - 1) < 1e-9 for of in impact.values())


def test_given_benchmark_as_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    grams = lambda t: {tuple(x[i:i + 5]) for x in [plain(t)] for i in range(len(x) - 4)}
    wanted = {r["item_id"]: grams(r["text"]) for r in items.collect()}
    truth = {(r["doc_id"], i) for r in docs.collect() for g in [grams(r["text"])] for i, x in wanted.items() if len(x & g) >= 0.5 * len(x)}
    got = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, items, items_per_pass=7).collect()}
    assert got == truth and len(got) > 10
    leaky = {d for d, _ in truth}
    assert {r["doc_id"] for r in D.drop_leaks(docs, items).collect()} == {r["doc_id"] for r in docs.collect()} - leaky


def test_half_an_item_is_no_leak(spark):
    rng = random.Random(3)
    question, answer = prose(rng, 20), prose(rng, 12)
    items = spark.createDataFrame([(5, f"{question}\n{answer}"), (5, f"{question}\n{answer}"), (6, None), (7, ""), (8, "Ab")], "item_id long, text string")
    texts = [f"x {question.upper()}! {answer} y", question, answer, None, "", prose(rng, 5000) + f" {question} {answer}"]
    docs = spark.createDataFrame([(i if i else None, t, "z") for i, t in enumerate(texts)] + [(5, texts[5], "z")], "doc_id long, text string, item_id string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, items).collect()), key=repr)
    assert got == [(5, 5), (None, 5)]
    kept = D.drop_leaks(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4]


@pytest.mark.parametrize("empty", ["docs", "items"])
def test_empty(spark, hard_docs, no_docs, hard_rows, empty):
    items = spark.createDataFrame([(1, "some test item of a few words")] if empty == "docs" else [], "item_id long, text string")
    docs = no_docs if empty == "docs" else hard_docs
    assert D.find_leaks(docs, items).count() == 0
    assert D.drop_leaks(docs, items).count() == (0 if empty == "docs" else len(hard_rows))


def test_question_and_answer():
    assert D.question_and_answer("a b c d e f\ng h i j k") == ("a b c d e f", "g h i j k")
    assert D.question_and_answer("Is it a b c? Yes it is d e.") == ("Is it a b c?", "Yes it is d e.")
    assert D.question_and_answer("a b c. d") == ("a b", "c. d")
    assert np.all(D._grams([""])[0] == np.zeros(0))
