import hashlib

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contrail.llm import substring_dedup as S
from contrail.llm.words import pack_gaps, pack_small, ranges, slices, split_words, unpack_gaps, unpack_small, window_hashes, window_starts

TEXT = st.lists(st.text(alphabet="ab é\n\t\x0b ", max_size=12), max_size=6)


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_split_and_hash(texts):
    w = split_words(pa.array(texts, pa.string()))
    raw = w.data.tobytes()
    got = [raw[a:b].decode() for a, b in zip(w.starts, w.ends)]
    assert got == [x for t in texts for x in words(t)]
    assert np.diff(w.first).tolist() == [len(words(t)) for t in texts]
    by_word = {}
    for x, h in zip(got, w.hashes().tolist()):
        assert by_word.setdefault(x, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_windows_stay_in_their_row():
    w = split_words(pa.array(["a b c d", None, "b c d", "a b"]))
    h = window_hashes(w.hashes(), 3)
    at = window_starts(w, 3)
    assert at.tolist() == [0, 1, 4] and h[1] == h[4] and h[0] != h[1]


def test_slices_keep_all_rows():
    b = pa.record_batch({"text": pa.array(["x" * n for n in (5, 0, 900, 3, 3, 3)])})
    parts = list(slices(b, "text", 10))
    assert pa.concat_arrays([p.column(0) for p in parts]).to_pylist() == b.column(0).to_pylist()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 200_000), max_size=50))
def test_packing(values):
    x = np.array(values, dtype=np.int64)
    assert unpack_small(pack_small(x)).tolist() == values
    assert unpack_gaps(pack_gaps(np.sort(x))).tolist() == sorted(values)
    where, of = ranges(x[:5], np.minimum(x[:5], 4))
    assert len(where) == len(of) == int(np.minimum(x[:5], 4).sum())


def brute(rows, n):
    first = {}
    for d, t, *_ in rows:
        w = words(t)
        for i in range(len(w) - n + 1):
            if d is not None:
                k = tuple(w[i:i + n])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if d is not None and first[tuple(w[i:i + n])] < d:
                gone[i:i + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [{}, {"max_bits": 20, "shards": 3}])
def test_removal_matches_brute_force(hard_docs, hard_rows, sizes):
    out = S.remove_repeated_passages(hard_docs, 13, **sizes)
    got = out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(hard_rows, 13)


def test_small_windows_many_flushes(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * j) % 11}" for j in range(1, 40))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(S, "FLUSH", 50)
    out = S.remove_repeated_passages(docs, 3).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256)).collect()
    assert sorted(map(tuple, out), key=repr) == brute(rows, 3)


def test_untouched_texts_stay(hard_docs, hard_rows):
    got = {(r["doc_id"], r["kept_text"]) for r in S.remove_repeated_passages(hard_docs, 13, single_spaced=False).where("n_removed = 0").collect()}
    assert got <= {(d, t or "") for d, t, *_ in hard_rows}


def test_empty(no_docs):
    assert S.remove_repeated_passages(no_docs).count() == 0


def test_sketch_never_underestimates(spark):
    texts = spark.createDataFrame([(" ".join(f"a{i % 7}" for i in range(k, k + 30)),) for k in range(20)], "text string").repartition(4)
    maps = S.merged_sketch(texts, 5, 20, 2)
    w = split_words(pa.array([r["text"] for r in texts.collect()]))
    h = window_hashes(w.hashes(), 5)[window_starts(w, 5)]
    x, n = np.unique(h, return_counts=True)
    assert S._estimated_twice(x[n >= 2], maps, 20).all()
