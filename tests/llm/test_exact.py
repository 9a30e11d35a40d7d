from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import cuckoo_dedup as C


def brute(rows):
    """Sorted (doc_id, keep_id, group_size, kept) by a dictionary of texts."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    low = lambda x: (x is not None, x or 0)
    out = []
    for ids in groups.values():
        ids.sort(key=low)
        out += [(i, ids[-1], len(ids), n == len(ids) - 1) for n, i in enumerate(ids)]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=repr)


@pytest.mark.parametrize("key_bytes", [32, 1])
def test_matches_grouping_by_text(hard_docs, hard_rows, key_bytes):
    """With digests of one byte nearly every hit is another text and must be split by content."""
    assert found(C.exact_duplicates(hard_docs, key_bytes)) == brute([r[:2] for r in hard_rows])


def test_empty_table(no_docs):
    out = C.exact_duplicates(no_docs)
    assert out.count() == 0 and out.columns == ["doc_id", "keep_id", "group_size", "kept", "key"]


@pytest.mark.parametrize("key_bytes,shard_rows", [(32, 250_000), (1, 250_000), (32, 3)])
def test_batches_and_removal_equal_a_new_index(spark, key_bytes, shard_rows):
    rows = [(i, f"text {i % 13}") for i in range(60)] + [(100 + i, f"lone {i}") for i in range(40)] + [(None, "text 1"), (7, "text 2"), (900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    index = C.add_documents(C.empty_index(spark, key_bytes), docs.where("coalesce(doc_id, 0) % 3 = 0"), shard_rows)
    index = C.add_documents(index, docs.where("doc_id % 3 > 0"), shard_rows)
    assert found(C.resolved(index)) == brute(rows)
    gone = {7, 59, 100, 101, 105, 901, 12, 25, 38, 51}  # duplicates, whole groups, keepers, single texts
    index = C.remove_documents(index, spark.createDataFrame([(i,) for i in gone] + [(None,), (12345,)], "doc_id long"))
    left = [r for r in rows if r[0] not in gone]
    assert found(C.resolved(index)) == brute(left)
    again = [(59, "text 7"), (5000, "lone 1"), (5001, "fresh"), (5002, "fresh")]
    index = C.add_documents(index, spark.createDataFrame(again, "doc_id long, text string"), shard_rows)
    assert found(C.resolved(index)) == brute(left + again)


def test_removed_digests_leave_the_filter(spark):
    docs = spark.createDataFrame([(i, f"t{i // 2}") for i in range(20)], "doc_id long, text string")
    index = C.add_documents(C.empty_index(spark), docs)
    full = lambda x: sum(int((C.CuckooFilter.load(bytes(r.slots)).slots > 0).sum()) for r in x.filters.collect())
    assert full(index) == 10
    index = C.remove_documents(index, docs.where("doc_id < 5").select("doc_id"))  # t0 and t1 whole, one row of t2
    assert full(index) == 8 and index.live.count() == 8


def test_a_common_text_has_one_answer_per_partition(spark):
    rows = [(i, "the same" if i % 3 else f"other {i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    index = C.add_documents(C.empty_index(spark), docs)
    pairs = C._involved(index.content.select("part", "row", "doc_id", "key"), index.repeated).collect()
    assert len(pairs) == 7 and sum(r.n for r in pairs) == 400
    assert found(C.resolved(index)) == brute(rows)


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2 ** 63 - 1), min_size=1, max_size=400), st.data())
def test_filter_keeps_what_was_inserted_and_not_deleted(hashes, data):
    h = np.array(sorted(hashes), dtype=np.int64)
    held = C.with_inserted(C.CuckooFilter(4), h, lambda: h[:0])  # overflows and grows
    assert held.contains(h).all()
    assert C.CuckooFilter.load(held.dump()).contains(h).all()
    gone = np.array(data.draw(st.lists(st.booleans(), min_size=len(h), max_size=len(h))))
    held.delete(h[gone])
    assert held.contains(h[~gone]).all()
    assert int((held.slots > 0).sum()) == int((~gone).sum())


def test_filter_false_hits_are_rare_and_overflow_is_reported():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2 ** 63 - 1, 60_000)
    held = C.with_inserted(C.CuckooFilter.for_items(50_000), h[:50_000], lambda: h[:0])
    assert held.buckets == C.CuckooFilter.for_items(50_000).buckets
    assert held.contains(h[50_000:]).mean() < 0.002
    assert not C.CuckooFilter(4).insert(h[:17])
