import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import phrase_mining as P


def brute(rows, least, share, top, max_words=3):
    """Phrases by counting every contiguous run in Python, with integers of any size."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                for i in range(len(w) - m + 1):
                    count[lang, tuple(w[i:i + m])] += 1
    out = {}
    for lang in {k[0] for k in count}:
        often = {p: a for (g, p), a in count.items() if g == lang and a >= least}
        rows = []
        for p, a in often.items():
            if len(p) < 2:
                continue
            inside = [b for q, b in often.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= share * a for b in inside):
                continue
            score, _, left, right = min((1_000_000 * a * a // (often[p[:k]] * often[p[k:]]), k, often[p[:k]], often[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out[lang, rank] = (phrase.decode(), -a, left, right, n[lang], -score)
    return out


def mined(docs, **kw):
    return {(r.lang, r.rank): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in P.mine_phrases(docs, **kw).collect()}


TEXTS = [("the red fox. The red fox! a fox", "en"), ("the red fox, the red fox\nthe red\tfox", "en"), ("new york city  new york city", None), ("new york city;york", "und"),
         (None, "en"), ("", None), (" \t\n", "de"), ("..,;", "en"), ("a a a a a a", "de"), ("a a a a", "de"), ("É é É é É é", "fr"), ("x" * 5000 + " the red fox", "en")]


@pytest.mark.parametrize("least,share,top,bytes_", [(2, 50, 50, 1 << 20), (2, 100, 3, 16), (1, 50, 9, 40), (3, 1, 2000, 7)])
def test_matches_counting_every_run(spark, least, share, top, bytes_, monkeypatch):
    monkeypatch.setattr(P, "frequent_phrases", lambda d, m, n, _f=P.frequent_phrases: _f(d, m, n, slice_bytes=bytes_, shard_rows=20))
    docs = spark.createDataFrame(TEXTS * 2, "text string, lang string").repartition(3)
    assert mined(docs, least=least, share=share, top=top) == brute(TEXTS * 2, least, share, top)


def test_longer_phrases(spark):
    rows = [("one two three four five six. two three four five", "en"), ("two three four five; one two three four five six", "en")] * 2
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert mined(docs, max_words=5, least=2, share=60, top=20) == brute(rows, 2, 60, 20, max_words=5)


def test_hard_rows(spark, hard_docs, hard_rows, no_docs):
    rows = [(r[1], r[2]) for r in hard_rows]
    assert mined(hard_docs, least=2) == brute(rows, 2, 50, 2000)
    empty = P.mine_phrases(no_docs)
    assert empty.count() == 0 and "score" in empty.columns


def test_products_beyond_64_bits(spark):
    big = 2_000_000_000_000
    phrases = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big), ("en", 2, "a b", big - 1)], "lang string, n_words int, phrase string, a long")
    r = P.scored(phrases).first()
    assert r.score == 1_000_000 * (big - 1) ** 2 // big ** 2 == 999_999


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 62), max_size=50))
def test_packing_round_trip(values):
    x = np.array(values, dtype=np.int64)
    assert P.unpack(P.pack(x)).tolist() == values
    assert P.unpack_sorted(P.pack_sorted(np.sort(x))).tolist() == sorted(values)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .,\n\té", max_size=60))
def test_positions_skip_a_number_at_a_new_piece(text):
    words, at = P.located_words(np.frombuffer(text.encode(), np.uint8))
    want, place = [], 0
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
        found = re.findall(r"[^\x20\x09]+", piece)
        want += [(w, place + i) for i, w in enumerate(found)]
        place += len(found) + 1 if found else 0
    assert list(zip(words.to_pylist(), at.tolist())) == want
