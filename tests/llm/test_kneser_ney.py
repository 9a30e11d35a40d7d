import collections
import math

import pytest
from llm_texts import words
from pyspark.sql import functions as F

from contrail.llm import kneser_ney as K


def tokens(t):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words(t)] + ["\n"]  # no word holds white space


def model(train):
    uni, bi, ctx = collections.Counter(), collections.Counter(), collections.Counter()
    for t in train:
        x = tokens(t)
        uni.update(x)
        bi.update(zip(["\t", *x[:-1]], x))
        ctx.update(["\t", *x[:-1]])
    total, kinds, types = sum(uni.values()), len(uni), len(bi)
    n = collections.Counter(bi.values())
    d = K.discounts(n[1], n[2], n[3], n[4])
    left = collections.Counter(w for _, w in bi)
    m = collections.Counter(left.values())
    e = K.discounts(m[1], m[2], m[3], m[4])
    reserve = sum(e[min(c, 3) - 1] for c in left.values()) / types if types else 1.0
    mass = collections.defaultdict(float)
    for (u, w), c in bi.items():
        if c >= 2:
            mass[u] += (c - d[min(c, 3) - 1]) / ctx[u]

    def p1(w):
        return (max(left[w] - e[min(left[w], 3) - 1], 0) / types if left[w] else 0.0) + reserve / (kinds + 1)

    def p2(w, u):
        c = bi[u, w]
        return (max(1 - mass[u], 1e-12) if u in ctx else 1.0) * p1(w) + ((c - d[min(c, 3) - 1]) / ctx[u] if c >= 2 else 0.0)

    return uni, total, kinds, p1, p2, reserve


def check(rows, scored):
    train = [t for d, t in rows if d is not None and d % 3 != 2]
    uni, total, kinds, p1, p2, _ = model(train)
    want = []
    for d, t in rows:
        x = tokens(t)
        base = sum(math.log10((uni[w] + 1) / (total + kinds + 1)) for w in x)
        score = sum(math.log10(p2(w, u)) for u, w in zip(["\t", *x[:-1]], x))
        want.append((d, d is None or d % 3 == 2, len(x), sum(uni[w] > 0 for w in x), total, base, score))
    got = sorted(map(tuple, scored.collect()), key=repr)
    want.sort(key=repr)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: repr(r[:5]) + repr(round(r[5], 3))), sorted(want, key=lambda r: repr(r[:5]) + repr(round(r[5], 3)))):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-8 * max(1, abs(w[5])) and abs(g[6] - w[6]) < 1e-5 * max(1, w[2])


def held():
    return F.coalesce(F.col("doc_id") % 3 == 2, F.lit(True))


@pytest.mark.parametrize("flush", [2_000_000, 100])
def test_matches_brute_force(spark, hard_docs, hard_rows, monkeypatch, flush):
    monkeypatch.setattr(K, "FLUSH", flush)
    docs = hard_docs.select("doc_id", "text")
    check([r[:2] for r in hard_rows], K.score_texts(docs, docs.where(~held()), held()))


def test_repetitive_corpus(spark):
    rows = [(i, " ".join(f"W{(i * j) % 13}" for j in range(1, 60))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(rows, K.score_texts(docs, docs.where(~held()), held()))


def test_probabilities_sum_to_one():
    uni, _, kinds, p1, p2, reserve = model(["a b a b c", "a b d", "b a c c", "a b"])
    assert abs(sum(p1(w) for w in uni) + reserve / (kinds + 1) - 1) < 1e-12
    for u in ("a", "b", "\t"):
        g = p2("unseen", u) / p1("unseen")
        assert abs(sum(p2(w, u) for w in uni) + g * reserve / (kinds + 1) - 1) < 1e-12


def test_nothing_to_learn_or_score(spark):
    docs = spark.createDataFrame([(2, "a b"), (None, None)], "doc_id long, text string")
    rows = K.score_texts(docs, docs.limit(0), held()).collect()
    assert sorted(r["n_tokens"] for r in rows) == [1, 3] and all(r["score"] == r["base_score"] == 0 and r["train_tokens"] == 0 for r in rows)
    assert K.score_texts(docs.limit(0), docs.limit(0), held()).count() == 0


def test_discounts_without_counts():
    assert K.discounts(0, 0, 0, 0) == (0.0, 0.0, 0.0) or K.discounts(0, 0, 0, 0)[0] >= 0


def unpruned(train, order):
    """p(w | x, u) of an interpolated modified Kneser-Ney model that keeps every n-gram; x is None behind the start."""
    raw2, c3 = collections.Counter(), collections.Counter()
    for t in train:
        y = ["\t", *tokens(t)]
        raw2.update(zip(y, y[1:]))
        c3.update(zip(y, y[1:], y[2:]))
    left2 = collections.Counter((u, w) for _, u, w in c3)
    c2 = raw2 if order == 2 else {(u, w): c if u == "\t" else left2[u, w] for (u, w), c in raw2.items()}
    c1 = collections.Counter(w for _, w in raw2)

    def level(counts):
        n = collections.Counter(counts.values())
        d = K.discounts(n[1], n[2], n[3], n[4])
        total, own = collections.Counter(), {}
        for g, c in counts.items():
            total[g[:-1]] += c
        mass = collections.Counter()
        for g, c in counts.items():
            own[g] = (c - d[min(c, 3) - 1]) / total[g[:-1]]
            mass[g[:-1]] += own[g]
        return own, mass

    (own1, mass1), (own2, mass2), (own3, mass3) = level({(w,): c for w, c in c1.items()}), level(c2), level(c3)
    left = lambda mass, context: max(1 - mass[context], 1e-12) if context in mass else 1.0

    def p(w, u, x=None):
        low = own1.get((w,), 0.0) + (1 - mass1[()]) / (len(c1) + 1)
        mid = own2.get((u, w), 0.0) + left(mass2, (u,)) * low
        return mid if order == 2 or x is None else own3.get((x, u, w), 0.0) + left(mass3, (x, u)) * mid

    return p, c1


@pytest.mark.parametrize("order, flush", [(2, 2_000_000), (3, 2_000_000), (3, 100)])
def test_matches_unpruned_model(spark, hard_docs, hard_rows, monkeypatch, order, flush):
    monkeypatch.setattr(K, "FLUSH", flush)
    docs, rows = hard_docs.select("doc_id", "text"), [r[:2] for r in hard_rows]
    p, _ = unpruned([t for d, t in rows if d is not None and d % 3 != 2], order)
    want = []
    for d, t in rows:
        y = ["\t", *tokens(t)]
        want.append((repr(d), len(y) - 1, sum(math.log10(p(y[i], y[i - 1], y[i - 2] if i > 1 else None)) for i in range(1, len(y)))))
    got = [(repr(r["doc_id"]), r["n_tokens"], r["score"]) for r in K.score_texts(docs, docs.where(~held()), held(), order=order, least=1).collect()]
    assert len(got) == len(want)
    for g, w in zip(sorted(got), sorted(want)):
        assert g[:2] == w[:2] and abs(g[2] - w[2]) < 1e-5 * max(1, w[1])


def test_unpruned_probabilities_sum_to_one():
    p, known = unpruned(["a b a b c", "a b d", "b a c c", "a b"], 3)
    for x, u in ((None, "\t"), ("\t", "a"), ("a", "b"), ("c", "a")):
        assert abs(sum(p(w, u, x) for w in known) + p("unseen", u, x) - 1) < 1e-12


def test_singletons_count(spark):
    """N-grams seen once in training score better than the same words in an order never seen."""
    rows = [(0, "a b c d"), (1, "d c b a"), (3, "x b y d"), (2, "a b c d"), (5, "b d a c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in K.score_texts(docs, docs.where(~held()), held(), order=3, least=1).collect()}
    assert got[2] > got[5]
    none = K.score_texts(docs, docs.limit(0), held(), order=3, least=1).collect()
    assert len(none) == 5 and all(r["score"] == 0 for r in none)
    assert K.score_texts(docs.limit(0), docs.limit(0), held(), order=3, least=1).count() == 0


def test_a_flush_gives_up_what_it_has_used(monkeypatch):
    """Peak bytes a token while texts ask for their trigrams: parts and sorted arrays do not outlive their use."""
    import random
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    rng = random.Random(5)
    size = 300_000
    monkeypatch.setattr(K, "FLUSH", size)
    monkeypatch.setattr(K, "SLICE", 1 << 17)
    monkeypatch.setattr(K, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [" ".join(str(int(rng.paretovariate(0.6)) % 50_000) for _ in range(999)) for _ in range(size // 1000)]
    ids = list(range(len(texts)))
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([False] * len(ids)), pa.array(texts)], ["doc_id", "held_out", "text"])
    asked = lambda: sum(r.num_rows for r in K._ask_trigrams(4)(iter([batch])))
    assert asked() == 17
    tracemalloc.start()
    asked()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak / size < 90


def test_a_book_changes_sizes_not_words():
    import numpy as np

    from contrail.llm import code_book as B
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    for book in (K._book(), K._book(words[:200], np.arange(200)), K._book(words, np.arange(500))):
        some = words[rng.integers(0, 500, 2000)]
        assert (book.unpack_words(B.pack_words(book.word_codes(some), some)) == some).all()
        names = np.append(K.short(some), np.uint64(0))
        assert (book.unpack_names(B.pack_names(book.codes(names), names)) == names).all()
    for x in (np.zeros(0, np.int64), np.zeros(9, np.int64), np.array([0, 255, 256, 1 << 40]), rng.integers(0, 9, 5000)):
        assert (B.unpack(B.pack(x)) == x).all()
    doubles = np.append(rng.normal(size=100), [0.0, -0.0, -1e300])
    assert (B.unpack_doubles(B.pack(doubles)) == doubles).all()


def test_orders_that_fit_no_key():
    import numpy as np
    u, w, x = np.random.default_rng(4).integers(0, 4, (3, 300)).astype(np.int32)
    assert (K._order(u, w, x, 5) == K._order(u, w, x, 1 << 30)).all() and (K._order(u, w, None, 5) == K._order(u, w, None, 1 << 40)).all()


def test_asked_trigrams_are_small(monkeypatch):
    """Bytes a token that a flush sends: frequent words have codes, and all numbers are packed."""
    import random
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa
    rng = random.Random(5)
    monkeypatch.setattr(K, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [" ".join(str(int(rng.paretovariate(0.6)) % 50_000) for _ in range(999)) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array([False] * 300), pa.array(texts)], ["doc_id", "held_out", "text"])
    words, counts = np.unique(K.tokens(pa.array(texts))[1], return_counts=True)
    book = K._book(words[counts > 1], counts[counts > 1])
    size = sum(r.nbytes for r in K._ask_trigrams(4, SimpleNamespace(value=book), 10)(iter([batch])))
    assert size / 300_000 < 8


def test_the_model_is_not_shuffled_again(spark, hard_docs):
    """Only what the texts ask is sent to the shards of the model; jobs before remove the files of their shuffles."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    docs = hard_docs.select("doc_id", "text")
    plan = K.score_texts(docs, docs.where(~held()), held(), order=3, least=1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(shard") == 1 and plan.count("Exchange hashpartitioning(flush") == 1
    assert spark.conf.get(key, None) == before


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_keys_are_looked_up_by_their_top_bits(n):
    import numpy as np
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
    values = rng.random(len(keys)).astype(np.float32)
    x = np.concatenate([keys, rng.integers(0, 1 << 64, 3000, dtype=np.uint64), np.array([0, (1 << 64) - 1], np.uint64)])
    have = dict(zip(keys.tolist(), values.tolist()))
    assert K._looked_up(keys, values, K._bucket_starts(keys), x).tolist() == [have.get(k, 0.0) for k in x.tolist()]


def small_texts(n):
    import pyarrow as pa
    texts = [f"w{i} v{i % 7}" for i in range(n)]
    return pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([False] * n), pa.array(texts)], ["doc_id", "held_out", "text"])


@pytest.mark.parametrize("bits", [2, 9])
def test_shards_return_only_texts_they_know_of(monkeypatch, bits):
    """Sums that all shards return for a flush: one for each text that asks there, not one for each text and shard."""
    from types import SimpleNamespace

    import pandas as pd
    monkeypatch.setattr(K, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    asked = pd.concat([b.to_pandas() for b in K._ask_trigrams(bits)(iter([small_texts(500)]))]).assign(n=None)
    run = K._answer_trigrams(K.Totals(bits, 10, 3, 0, (0.5, 1.0, 1.5), 0, least=1, order=3), SimpleNamespace(value=K._book()))
    parts = pd.concat([run((shard,), rows, pd.DataFrame(columns=[*K._ARRAYS])) for shard, rows in asked.groupby("shard")])
    returned = sum(len(K.unpack_doubles(x)) for x in parts["score"] if x is not None)
    assert 500 <= returned <= 500 * 3  # at most one for each token
    whole = K._texts_of_flush(K.Totals(bits, 10, 3, 2, (), 0), 0.0)(parts)
    assert whole["doc_id"].tolist() == list(range(500)) and (whole["n_tokens"] == 3).all() and (whole["score"] < 0).all()


@pytest.mark.parametrize("n", [6, 1 << 20, 1 << 30])
def test_sums_and_texts_of_trigrams(n):
    """The same whether a row fits one key (small n) or not."""
    import numpy as np
    rng = np.random.default_rng(6)
    for size in (0, 1, 400):
        u, w, x = rng.integers(0, 6, (3, size)).astype(np.int32)
        doc, c = np.sort(rng.integers(0, 20, size)).astype(np.int32), rng.integers(1, 1 << 20, size)
        summed, often, texts = collections.Counter(), collections.Counter(), collections.Counter(zip(u.tolist(), w.tolist(), x.tolist(), doc.tolist()))
        for k, v in zip(zip(u.tolist(), w.tolist(), x.tolist()), c.tolist()):
            summed[k] += v
            often[k] += 1
        for got, want in ((K._summed(u, w, x, c, (n, n)), summed), (K._summed(u, w, x, None, (n, n)), often)):
            assert list(zip(*(a.tolist() for a in got))) == [(*k, v) for k, v in sorted(want.items())]
        pu, pw, nx, px, nd, docs, times = K._texts_by_trigram(u, w, x, doc, n, 20)
        of = np.repeat(np.repeat(np.arange(len(pu)), nx), nd)
        got = list(zip(pu[of].tolist(), pw[of].tolist(), np.repeat(px, nd).tolist(), docs.tolist(), times.tolist()))
        assert got == [(*k, v) for k, v in sorted(texts.items())]


def test_answers_do_not_depend_on_how_many_rows_are_looked_up_at_once(spark, hard_docs, monkeypatch):
    docs, got = hard_docs.select("doc_id", "text"), []
    for most in (1, 1 << 22):
        monkeypatch.setattr(K, "FLUSH", 300)
        monkeypatch.setattr(K, "ANSWERED", most)
        rows = K.score_texts(docs, docs.where(~held()), held(), order=3, least=1).collect()
        got.append(sorted((repr(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 8), round(r["score"], 8)) for r in rows))
    assert got[0] == got[1]


def test_places_of_names():
    import numpy as np

    from contrail.llm import code_book as B
    rng = np.random.default_rng(7)
    words = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for book in (K._book(), K._book(words[:100], np.arange(100))):
        names = K.short(words[:200])[rng.integers(0, 200, 900)]
        held = B.Names(book, B.read_names([B.pack_names(book.codes(names[a:a + 300]), names[a:a + 300]) for a in (0, 300, 600)]))
        assert (held.names == np.unique(names)).all() and (book.names[held.codes[held.codes > 0]] == held.names[held.codes > 0]).all()
        asked = K.short(words)
        at = held.places(book.codes(asked), asked[book.codes(asked) == 0])
        assert at.tolist() == [int(np.searchsorted(held.names, v)) if v in names else len(held) for v in asked]
        again = B.pack_places(at[at < len(held)], held.codes, held.names)
        assert (book.unpack_names(again) == asked[at < len(held)]).all()
    empty = B.Names(K._book(), B.read_names([]), B.read_names([b""]))
    assert len(empty) == 0 and empty.places(np.array([0, 2]), np.array([7], np.uint64)).tolist() == [0, 0]
