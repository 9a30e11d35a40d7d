"""Interpolated modified Kneser-Ney models of order 2 or 3 over sorted hash arrays.

Words are hashed; the top bits of a word's hash name its shard, so a shard
holds all counts of its words as contexts.  Tasks count their bigrams in
flushes sorted by (context, word) and send packed arrays, not rows.  With
``least`` 1 every bigram is kept.  With ``least`` 2 those seen once are counted
but not kept: with T bigram tokens, ``n1 = T - sum of kept counts``, and a
word's number of left neighbours is its kept types plus its count less its kept
counts, so all statistics stay exact and the mass of what is not kept goes to
the back-off weight:

    p(w|u) = (c(uw) - D) / c(u) [kept] + g(u) p1(w),   g(u) = 1 - sum of kept (c - D) / c(u)

p1 is the interpolated continuation distribution over the known words and one
unknown.  In logarithms a text's score is a sum over its tokens of
``log p1(w) + log g(w)`` and over its kept bigrams of what they add, so every
lookup concerns one key.

Order 3 keeps every n-gram.  A trigram xuw lies in the shard of its middle
word u, where its context xu, its lower bigram uw and the number of its left
neighbours are at home too.  Bigrams then count their left neighbours, those
behind the start of a text their occurrences.  A token adds to the above
``log g(xu)`` if xu is known and what a known trigram adds; the model's arrays
are made where they are looked up and not stored.  Its n-grams stand in the
order of the hashes of their words and name each word by its place in the
shard's sorted array of hashes, as the counts do.

Shards of the model are sorted arrays of hashes and
values; a scoring task spools its shard to an unlinked file, maps it into
memory and looks up the tokens of all texts that were sent there, those of many
flushes at once.  Sums come back per flush, for the texts that asked there.  At order 2 texts leave out the bigrams that a bounded
bitmap of the kept ones rules out.  No task and no driver holds the whole model.

Defined results: a null or empty text is one end token.  A null id is held
out.  Repeated rows are learnt and scored as often as they stand there.
Without training rows every probability is 1 of the one unknown word.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.code_book import Book, Names, pack, pack_names, pack_places, pack_words, read_names, read_words, unpack, unpack_doubles
from contrail.llm.words import U64, mix, pack_gaps, pack_small, ranges, slices, split_words, unpack_gaps, unpack_small
from contrail.session import ensure_checkpoint_dir

SLICE = 1 << 20
FLUSH = 2_000_000    # tokens
CHUNK_BITS = 22
ANSWERED = 1 << 22   # bytes of asked trigrams looked up at once
BOOK = 1 << 18       # words of the code book; their number changes sizes, not results
# Hashes of the two marks; the first only stands before a text, the other is a token.
BEGIN, END = U64(0x0123456789ABCDEF), U64(0xFEDCBA9876543210)
_C = U64(0x9E3779B97F4A7C15)


def _lower(data: np.ndarray) -> np.ndarray:
    return data + ((data - np.uint8(65) < 26) * np.uint8(32))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, token, row) of every token of every text, its end included."""
    w = split_words(texts)
    n = len(w.first) - 1
    h = w.hashes(0, _lower(w.data))
    row = w.rows
    token = np.empty(len(h) + n, dtype=U64)
    where = np.arange(len(h)) + row
    ends = w.first[1:] + np.arange(n)
    token[where], token[ends] = h, END
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[w.first[:-1] + np.arange(n)] = BEGIN
    rows = np.empty(len(token), dtype=np.int64)
    rows[where], rows[ends] = row, np.arange(n)
    return context, token, rows


def short(h: np.ndarray) -> np.ndarray:
    """48 bits name a word after a known context."""
    return h >> U64(16)


def bigram_keys(context: np.ndarray, word48: np.ndarray) -> np.ndarray:
    return mix(context * _C + word48)


def befores(context: np.ndarray) -> np.ndarray:
    """48 bits of the word before each context; 0 before the start of a text."""
    out = np.zeros_like(context)
    out[1:] = context[:-1]
    out[context == BEGIN] = 0
    return short(out)


def _ranked(context: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct words, and the places there of each token's context, of it and of the word before the context.

    The place behind the last stands for the 0 before the start of a text.
    """
    start = context == BEGIN
    w, names = pd.factorize(np.append(token, BEGIN))
    order = np.argsort(names)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    names, w = names[order], rank[w]
    begin, w = w[-1], w[:-1]
    u, x = np.empty_like(w), np.empty_like(w)
    u[1:] = w[:-1]
    u[start] = begin
    x[1:] = u[:-1]
    x[start] = len(names)
    return names, u, w, x


def _key(bits: list[int], *columns: np.ndarray) -> np.ndarray | None:
    """The columns in one number each row, the first one highest, if their bits allow it."""
    if sum(bits) > 63:
        return None
    key = columns[0].astype(np.int64)
    for n, c in zip(bits[1:], columns[1:], strict=True):
        key <<= n
        key |= c
    return key


def _order(u: np.ndarray, w: np.ndarray, x: np.ndarray | None, n: int) -> np.ndarray:
    """Stable order by (u, w, x), all of them below n; keys that end in places are sorted, which is faster than to sort the places."""
    b, p, at = (n - 1).bit_length(), len(u).bit_length(), np.arange(len(u), dtype=np.int32)
    key = _key([b, b, p], u, w, at) if x is None else _key([b, b, b, p], u, w, x, at)
    if key is None and x is not None and (key := _key([b, b, p], u, w, at)) is not None:
        key.sort()
        order, key = (key & ((1 << p) - 1)).astype(np.int32), key >> p
        pair = np.zeros(len(key), np.int32)
        np.cumsum(key[1:] != key[:-1], out=pair[1:])
        del key
        if (key := _key([p, b, p], pair, x[order], at)) is not None:
            key.sort()
            return order[key & ((1 << p) - 1)]
    if key is None:
        return np.lexsort((w, u) if x is None else (x, w, u))
    key.sort()
    key &= (1 << p) - 1
    return key


def _summed(u: np.ndarray, w: np.ndarray, x: np.ndarray | None, c: np.ndarray | None, most: tuple[int, int]) -> tuple:
    """The distinct (u, w, x) in order and the sums of their c, or how often they occur; u is below most[0], w and x are below most[1]."""
    b, d = ((m - 1).bit_length() for m in most)
    columns, bits = ((u, w), [b, d]) if x is None else ((u, w, x), [b, d, d])
    e = 0 if c is None else int(c.max(initial=0)).bit_length()
    if c is not None and (key := _key([*bits, e], *columns, c)) is not None:  # counts ride in the lowest bits
        key.sort()
        c, key = key & ((1 << e) - 1), key >> e
    elif (key := _key(bits, *columns)) is not None:
        if c is None:
            key.sort()
        else:
            order = np.argsort(key)
            key, c = key[order], c[order]
    else:
        order = np.lexsort(columns[::-1])
        columns, c = [v[order] for v in columns], None if c is None else c[order]
    at = _heads(*columns) if key is None else _heads(key)
    c = np.diff(np.append(at, len(u))) if c is None else _summed_runs(c, at)
    if key is None:
        return *(v[at] for v in columns), c
    key, out = key[at], []
    for n in bits[:0:-1]:
        out.append((key & ((1 << n) - 1)).astype(np.int32))
        key >>= n
    return key.astype(np.int32), *out[::-1], c


def _texts_by_trigram(u: np.ndarray, w: np.ndarray, x: np.ndarray, doc: np.ndarray, n: int, texts: int) -> tuple:
    """The distinct (u, w), how many x each has, these, how many texts each has, these, and how often; u, w and x are below n."""
    b, d, p = (n - 1).bit_length(), texts.bit_length(), len(u).bit_length()
    key = _key([b, b, p], u, w, np.arange(len(u), dtype=np.int32)) if p + b + d <= 63 else None
    if key is None:
        order = _order(u, w, x, n)
        u, w, x, doc = u[order], w[order], x[order], doc[order]
        at = _heads(u, w, x, doc)
        times, docs = np.diff(np.append(at, len(u))), doc[at]
        u, w, x = u[at], w[at], x[at]
        at = _heads(u, w, x)
        nd, u, w, x = np.diff(np.append(at, len(docs))), u[at], w[at], x[at]
        at = _heads(u, w)
        return u[at], w[at], np.diff(np.append(at, len(x))), x, nd, docs, times
    key.sort()
    order = (key & ((1 << p) - 1)).astype(np.int32)
    key >>= p
    new = np.zeros(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    key = key[_heads(key)]
    u, w = (key >> b).astype(np.int32), (key & ((1 << b) - 1)).astype(np.int32)
    key = _key([p, b, d], np.cumsum(new, dtype=np.int32), x[order], doc[order])
    del new, order
    key.sort()
    at = _heads(key)
    times, key = np.diff(np.append(at, len(key))).astype(np.int32), key[at]
    docs = (key & ((1 << d) - 1)).astype(np.int32)
    key >>= d
    at = _heads(key)
    nd, key = np.diff(np.append(at, len(key))), key[at]
    return u, w, np.bincount(key >> b, minlength=len(u)), (key & ((1 << b) - 1)).astype(np.int32), nd, docs, times


def trigram_keys(before48: np.ndarray, context: np.ndarray, word48: np.ndarray) -> np.ndarray:
    return mix(bigram_keys(context, word48) * _C + before48)


def pair_keys(before48: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Keys of trigram contexts."""
    return mix(bigram_keys(context, before48) ^ _C)


def _pack48(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, dtype=np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :6] = raw
    return out.reshape(-1).view("<u8").astype(U64) if len(raw) else np.zeros(0, U64)


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal keys."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _summed_runs(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, heads) if len(heads) else np.zeros(0, values.dtype)


def _shards(us: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(shard, start, end) of the non-empty shards of sorted hashes."""
    if not bits:
        if len(us):
            yield 0, 0, len(us)
        return
    shard = (us >> U64(64 - bits)).astype(np.int64)
    heads = _heads(shard)
    yield from zip(shard[heads].tolist(), heads.tolist(), np.append(heads[1:], len(us)).tolist())


def _flushes(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...] = ()) -> Iterator[tuple]:
    """(contexts, tokens, rows, columns) of runs of texts of about FLUSH tokens."""
    held, more, size, rows = [], [], 0, 0
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            u, w, r = tokens(part.column("text"))
            held.append((u, w, (r + rows).astype(np.int32))), more.append([part.column(c) for c in columns])
            size, rows = size + len(u), rows + part.num_rows
            if size >= FLUSH:
                yield _joined(held, more)
                size, rows = 0, 0
    if rows:
        yield _joined(held, more)


def _joined(held: list, more: list) -> tuple:
    """The parts of a flush in one; they are given up before the flush is worked on."""
    u, w, r = ([x[i] for x in held] for i in range(3))
    held.clear()
    out = []
    for parts in (u, w, r):
        out.append(np.concatenate(parts))
        parts.clear()
    columns = [pa.concat_arrays(c) for c in zip(*more)]
    more.clear()
    return (*out, columns)


# --- code book

_WORDS = "shard int, us binary, n binary"


def _distinct_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, w, _, _ in _flushes(batches):
            names, n = np.unique(w[w != END], return_counts=True)
            if len(names):
                yield _record(_WORDS, [(shard, names[a:b].tobytes(), pack(n[a:b])) for shard, a, b in _shards(names, bits)], [pa.int32(), pa.binary(), pa.binary()])

    return run


def _most_frequent(most: int):
    """The ``most`` most frequent words of one shard and how often they occur."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        us, n = np.concatenate([np.frombuffer(x, dtype=U64) for x in frame["us"]]), np.concatenate([unpack(x) for x in frame["n"]])
        order = np.argsort(us, kind="stable")
        at = _heads(us[order])
        us, n = us[order][at], _summed_runs(n[order], at)
        top = np.argsort(-n, kind="stable")[:most]
        return pd.DataFrame([(frame["shard"].iloc[0], us[top].tobytes(), pack(n[top]))], columns=["shard", "us", "n"])

    return run


def code_book(train: DataFrame, bits: int) -> Book:
    """About the BOOK most frequent words of ``train``, an equal number from every shard, with their exact counts."""
    words = train.select("text").mapInArrow(_distinct_words(bits), _WORDS).groupBy("shard").applyInPandas(_most_frequent(max(1, BOOK >> bits)), _WORDS)
    rows = words.collect()
    us = np.concatenate([np.zeros(0, U64)] + [np.frombuffer(r["us"], dtype=U64) for r in rows])
    n = np.concatenate([np.zeros(0, np.int64)] + [unpack(r["n"]) for r in rows])
    order = np.lexsort((us, -n))
    return _book(us[order], n[order])


def _book(words: np.ndarray | tuple = (), counts: np.ndarray | tuple = ()) -> Book:
    """A book of the marks and of words; the marks have no counts."""
    return Book(np.concatenate([np.array([0, BEGIN, END], U64), np.asarray(words, U64)]), np.concatenate([np.zeros(3, np.int64), np.asarray(counts, np.int64)]))


# --- counting

_COUNTS = "shard int, us binary, cu binary, nb binary, w binary, cw binary, nx binary, x binary, cx binary"


def _record(names: str, rows: list[tuple], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], [x.split()[0] for x in names.split(", ")])


def _count_partition(bits: int, n: int, shared):
    """Counts of a flush; x, cx and nx are the words before each bigram, their counts and how many there are (order 3)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        for u, w, _, _ in _flushes(batches):
            names, u, w, x = _ranked(u, w)
            cx = np.zeros(0, np.int64)
            if n == 3:
                u, w, x, cx = _summed(u, w, x, None, (len(names) + 1,) * 2)
                at = _heads(u, w)
                u, w, c, x_at = u[at], w[at], _summed_runs(cx, at), np.append(at, len(u))
            else:
                u, w, c = _summed(u, w, None, None, (len(names) + 1,) * 2)
                x_at = np.zeros(len(u) + 1, np.int64)
            nx = np.diff(x_at)
            first = _heads(u)
            us, nb, cu = names[u[first]], np.diff(np.append(first, len(u))), _summed_runs(c, first)
            codes, named = book.word_codes(us), np.append(short(names), U64(0))
            coded = book.codes(named)
            rows = []
            for shard, a, b in _shards(us, bits):
                lo, hi = first[a], first[b] if b < len(first) else len(u)
                t = slice(x_at[lo], x_at[hi])
                more = (b"", pack(nx[lo:hi]), pack_places(x[t], coded, named), pack(cx[t])) if n == 3 else (pack(c[lo:hi]), b"", b"", b"")
                rows.append((shard, pack_words(codes[a:b], us[a:b]), pack(cu[a:b]), pack(nb[a:b]), pack_places(w[lo:hi], coded, named), *more))
            yield _record(_COUNTS, rows, [pa.int32()] + [pa.binary()] * 8)

    return run


_SUMS = ("words", "tokens", "kept", "kept_tokens", "n1", "n2", "n3", "n4", "texts", "m1", "m2", "m3", "m4")
_ARRAYS = ("us", "cu", "nb", "w", "cw", "nx", "x", "cx")
_MERGED = "shard int, " + ", ".join([f"{c} binary" for c in _ARRAYS] + [f"{c} long" for c in _SUMS])


def _merge_counts(least: int, n: int, shared):
    """Counts of one shard: all contexts, the bigrams seen ``least`` times or more, and at order 3 all trigrams."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        book = shared.value
        us = np.concatenate([book.unpack_words(b) for b in frame["us"]])
        read = lambda column: np.concatenate([unpack(b) for b in frame[column]])
        cu, nb, nx = read("cu"), read("nb"), read("nx")
        order = np.argsort(us, kind="stable")
        at = _heads(us[order])
        u = np.empty(len(us), np.int32)
        u[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(us))))
        cu, us, u = _summed_runs(cu[order], at), us[order][at], np.repeat(u, nb)
        del order, nb
        w, x = read_names(frame["w"]), read_names(frame["x"])
        named = Names(book, w, x)
        w, x = named.places(*w), named.places(*x)
        most = len(us), len(named)
        if n == 3:
            u, w, x, cx = _summed(np.repeat(u, nx), np.repeat(w, nx), x, read("cx"), most)
            at = _heads(u, w)
            begin = (us == BEGIN)[u]
            m = [int((cx[~begin] == k).sum()) for k in (1, 2, 3, 4)]
            nx = np.diff(np.append(at, len(u)))
            u, w, begin = u[at], w[at], begin[at]
            c = np.where(begin, _summed_runs(cx, at), nx)
        else:
            u, w, c = _summed(u, w, None, read("cw"), most)
            cx, m = nx, [0] * 4
        keep = c >= least
        u, w, c = u[keep], w[keep], c[keep]
        nb = np.bincount(u, minlength=len(us))
        word = us != BEGIN
        return pd.DataFrame([(frame["shard"].iloc[0], pack_words(book.word_codes(us), us), pack(cu), pack(nb), pack_places(w, named.codes, named.names), pack(c),
                              pack(nx), pack_places(x, named.codes, named.names), pack(cx), int(word.sum()), int(cu[word].sum()), len(c), int(c.sum()),
                              *(int((c == k).sum()) for k in (1, 2, 3, 4)), int(cu[~word].sum()), *m)], columns=["shard", *_ARRAYS, *_SUMS])

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more; kept within their counts."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
    ratio = lambda a, b: a / b if b else 0.0
    return tuple(float(np.clip(k - (k + 1) * y * ratio(b, a), 0.0, 0.95 * k)) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


@dataclass
class Totals:
    bits: int
    tokens: int          # N
    words: int           # V
    texts: int
    d: tuple             # discounts of bigrams
    kept: int
    lower: tuple = ()    # discounts of continuation counts
    types: int = 0       # bigram types
    reserve: float = 1.0  # mass of the uniform distribution below
    least: int = 2
    order: int = 2
    d3: tuple = ()       # discounts of trigrams

    def discounted(self, c: np.ndarray) -> np.ndarray:
        return c - np.array([0, *self.d])[np.minimum(c, 3)]

    def p1(self, n: np.ndarray) -> np.ndarray:
        """Continuation probability of words with n left neighbours; 0 for the unknown word."""
        less = np.maximum(n - np.array([0, *(self.lower or (0, 0, 0))])[np.minimum(n, 3)], 0)
        return less / max(1, self.types) + self.reserve / (self.words + 1)


def _sent_words(t: Totals, shared):
    """Per kept bigram list: to each word's shard its words, types and, if some bigrams are not kept, tokens."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book = shared.value
        for frame in frames:
            for r in frame.itertuples():
                w, rows = read_names([r.w]), []
                named = Names(book, w)
                w = named.places(*w)
                types, tokens = np.bincount(w, minlength=len(named)), None if t.least == 1 else np.bincount(w, unpack(r.cw), len(named)).astype(np.int64)
                for shard, a, b in _shards(named.names << U64(16), t.bits):
                    rows.append((shard, r.shard, pack_names(named.codes[a:b], named.names[a:b]), pack(types[a:b]), b"" if tokens is None else pack(tokens[a:b])))
                yield pd.DataFrame(rows, columns=["shard", "origin", "w", "types", "tokens"])

    return run


_SENT = "shard int, origin int, w binary, types binary, tokens binary"


def _own_words(merged: pd.DataFrame, t: Totals, shard: int, book: Book) -> tuple[np.ndarray, np.ndarray]:
    """Sorted word hashes of a shard as tokens, and their counts: the end mark included, the other not."""
    us, cu = np.zeros(0, U64), np.zeros(0, np.int64)
    for r in merged.itertuples():
        us, cu = book.unpack_words(r.us), unpack(r.cu)
    keep = us != BEGIN
    us, cu = us[keep], cu[keep]
    if t.texts and shard == _end_shard(t.bits):
        at = int(np.searchsorted(us, END))
        us, cu = np.insert(us, at, END), np.insert(cu, at, t.texts)
    return us, cu


def _neighbours(sent: pd.DataFrame, us: np.ndarray, cu: np.ndarray, t: Totals, book: Book) -> np.ndarray:
    """Left neighbours of each word: kept types, and one for each of its other tokens."""
    n = np.zeros(len(us), np.int64) if t.least == 1 else cu.astype(np.int64).copy()
    w48 = short(us)
    for r in sent.itertuples():
        at = np.searchsorted(w48, book.unpack_names(r.w))
        n[at] += unpack(r.types) - (0 if t.least == 1 else unpack(r.tokens))  # a row has a word once
    return n


def _replies(t: Totals, shared):
    """Numbers of left neighbours back to the shards that sent words, and to the own one (origin -1) with their statistics."""

    def run(key, sent: pd.DataFrame, merged: pd.DataFrame) -> pd.DataFrame:
        book = shared.value
        us, cu = _own_words(merged, t, int(key[0]), book)
        n = _neighbours(sent, us, cu, t, book)
        w48 = short(us)
        rows = [(r.origin, int(key[0]), pack(n[np.searchsorted(w48, book.unpack_names(r.w))]), *[0] * 5) for r in sent.itertuples()]
        rows.append((int(key[0]), -1, pack(n), int(n.sum()), *(int((n == k).sum()) for k in (1, 2, 3, 4))))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in _REPLIES.split(", ")])

    return run


_REPLIES = "shard int, origin int, n binary, types long, n1 long, n2 long, n3 long, n4 long"
_MODEL = "shard int, us binary, cu binary, value binary, keys binary, adds binary"


@dataclass
class Bigrams:
    """What a shard of the model knows of words and of the bigrams behind them."""
    words: np.ndarray    # sorted hashes
    counts: np.ndarray
    value: np.ndarray    # log p1 + log g
    us: np.ndarray       # sorted hashes of the contexts
    names: Names         # of the words behind them and, at order 3, before them
    rank: np.ndarray     # of a bigram's context
    w: np.ndarray        # place of its word
    p: np.ndarray        # its probability
    below: np.ndarray    # what of it comes from its word alone


def _bigrams(t: Totals, shard: int, merged: pd.DataFrame, replies: pd.DataFrame, book: Book) -> Bigrams:
    words, counts = _own_words(merged, t, shard, book)
    got = {int(r.origin): t.p1(unpack(r.n)) for r in replies.itertuples()}
    value = np.log10(got.get(-1, np.zeros(0)))
    column = lambda c: merged[c].iloc[0] if len(merged) else b""
    us, cu, c, w, x = book.unpack_words(column("us")), unpack(column("cu")), unpack(column("cw")), read_names([column("w")]), read_names([column("x")])
    names = Names(book, w, x)
    rank, w = np.repeat(np.arange(len(us), dtype=np.int32), unpack(column("nb"))), names.places(*w)
    total = np.bincount(rank, c, minlength=len(us)) if t.least == 1 else cu
    own = t.discounted(c) / total[rank]
    g = np.maximum(1 - np.bincount(rank, own, minlength=len(us)), 1e-12)
    there = np.bincount(w, minlength=len(names)) > 0  # words in the order of their names are asked of one shard after the other
    p = np.concatenate([np.zeros(0), *[got[o] for o in sorted(got) if o >= 0]])
    below = g[rank] * p[(np.cumsum(there) - 1)[w]]
    if len(words):
        inside = us != BEGIN
        value[np.searchsorted(words, us)[inside]] += np.log10(g[inside])
    if (start := us == BEGIN).any():  # its weight stands under its own hash, without a count
        at = int(np.searchsorted(words, BEGIN))
        words, counts, value = np.insert(words, at, BEGIN), np.insert(counts, at, 0), np.insert(value, at, np.log10(g[start][0]))
    return Bigrams(words, counts.astype(np.int64), value, us, names, rank, w, own + below, below)


def _gain(p: np.ndarray, below: np.ndarray) -> np.ndarray:
    return np.log10(p / below).astype(np.float32)


def _model_arrays(t: Totals, shard: int, merged: pd.DataFrame, replies: pd.DataFrame, book: Book) -> tuple:
    """Per word count and log p1 + log g; sorted keys of bigrams and what each adds."""
    b = _bigrams(t, shard, merged, replies, book)
    keys = bigram_keys(b.us[b.rank], b.names.names[b.w])
    order = np.argsort(keys)
    return b.words, b.counts, b.value, keys[order], _gain(b.p, b.below)[order]


class Trigrams:
    """A shard of a model of order 3: n-grams in the order of the hashes of their words, found by the places of these in their sorted arrays."""

    def __init__(self, t: Totals, shard: int, merged: pd.DataFrame, replies: pd.DataFrame, book: Book):
        b = _bigrams(t, shard, merged, replies, book)
        self.unknown, self.names = np.log10(t.p1(np.zeros(1, np.int64)))[0], b.names
        column = lambda c: merged[c].iloc[0] if len(merged) else b""
        of, x, cx = np.repeat(np.arange(len(b.w)), unpack(column("nx"))), b.names.places(*read_names([column("x")])), unpack(column("cx"))
        inner = (b.us != BEGIN)[b.rank[of]]
        of, x, cx = of[inner], x[inner], cx[inner]
        u, self.n = b.rank[of], len(b.names) + 1  # one more for all unknown words
        order = _order(u, x, None, max(self.n, len(b.us)))
        at = _heads(u[order], x[order])
        pair = np.empty(len(order), np.int32)
        pair[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(order))))
        pairs = u[order][at].astype(np.int64) * self.n + x[order][at]
        own = (cx - np.array([0, *t.d3])[np.minimum(cx, 3)]) / np.bincount(pair, cx, minlength=len(pairs))[pair]
        g = np.maximum(1 - np.bincount(pair, own, minlength=len(pairs)), 1e-12)
        below = g[pair] * b.p[of]
        arrays = (b.words, b.counts, b.value, b.us, b.rank.astype(np.int64) * self.n + b.w, _gain(b.p, b.below),
                  of * self.n + x, _gain(own + below, below), pairs, np.log10(g).astype(np.float32))
        self.words, self.counts, self.value, self.us, self.bigrams, self.adds2, self.trigrams, self.adds3, self.pairs, self.weights = _mapped(*arrays)

    def word_values(self, us: np.ndarray) -> np.ndarray:
        at, there = _place(self.words, us)
        return np.where(there, self.value[at], np.where(us == BEGIN, 0.0, self.unknown)) if len(self.words) else np.where(us == BEGIN, 0.0, self.unknown)

    def word_counts(self, us: np.ndarray) -> np.ndarray:
        at, there = _place(self.words, us)
        return np.where(there, self.counts[at], 0) if len(self.words) else np.zeros(len(us), np.int64)

    def added(self, us: np.ndarray, nb: np.ndarray, w: np.ndarray, nx: np.ndarray, x: np.ndarray) -> np.ndarray:
        """log p of each asked trigram: nb words w behind each context, nx words x before each bigram, w and x by their places."""
        at, there = _place(self.us, us)
        u = np.repeat(np.where(there, at, len(self.us)), nb)
        at, there = _place(self.bigrams, u * self.n + w)
        out = np.repeat(self.word_values(us), nb)
        out[there] += self.adds2[at[there]]
        out, of = np.repeat(out, nx), np.repeat(np.where(there, at, -1), nx)
        for table, values, first in ((self.trigrams, self.adds3, of), (self.pairs, self.weights, np.repeat(u, nx))):
            asked = np.flatnonzero((first >= 0) & (x < self.n - 1))
            at, there = _place(table, first[asked] * self.n + x[asked])
            out[asked[there]] += values[at[there]]
        return out


def _place(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where x stand in a sorted table, and whether they do."""
    if not len(table):
        return np.zeros(len(x), np.int64), np.zeros(len(x), dtype=bool)
    p = len(x).bit_length()
    key = _key([int(x.max(initial=0)).bit_length(), p], x, np.arange(len(x), dtype=np.int32)) if x.dtype == np.int64 else None
    if key is None:
        at = np.searchsorted(table, x)
    else:  # looked up in their order, steps lead through memory that is at hand
        key.sort()
        at = np.empty(len(x), np.int64)
        at[key & ((1 << p) - 1)] = np.searchsorted(table, key >> p)
    at = np.minimum(at, len(table) - 1)
    return at, table[at] == x


def _valued(t: Totals, shared):
    """The model arrays of a shard."""

    def run(key, merged: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(int(key[0]), *(x.tobytes() for x in _model_arrays(t, int(key[0]), merged, replies, shared.value)))], columns=[x.split()[0] for x in _MODEL.split(", ")])

    return run


def _bitmap_cells(bits: int):
    chunk_bits = min(CHUNK_BITS, bits)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for blob in frame["keys"]:
                cells = np.unique(np.frombuffer(blob, dtype=U64) >> U64(64 - bits)).astype(np.int64)
                heads = _heads(cells >> chunk_bits)
                rows = [(int(x[0] >> chunk_bits), pack_gaps(x & ((1 << chunk_bits) - 1))) for x in np.split(cells, heads[1:]) if len(x)]
                yield pd.DataFrame(rows, columns=["chunk", "cells"])

    return run


def _bitmap_chunk(bits: int):
    size = 1 << min(CHUNK_BITS, bits)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        on = np.zeros(size, dtype=bool)
        for blob in frame["cells"]:
            on[unpack_gaps(blob)] = True
        return pd.DataFrame({"chunk": frame["chunk"].iloc[:1], "bitmap": [np.packbits(on, bitorder="little").tobytes()]})

    return run


def kept_bitmap(model: DataFrame, kept: int, most: int = 30) -> tuple[np.ndarray, int]:
    """One bit per cell of the kept bigrams' keys, eight cells or more per key, 2**most bits at most."""
    bits = int(min(most, max(16, np.ceil(np.log2(max(1, 8 * kept))))))
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    step = (1 << min(CHUNK_BITS, bits)) // 8
    cells = model.select("keys").mapInPandas(_bitmap_cells(bits), "chunk int, cells binary")
    for r in cells.groupBy("chunk").applyInPandas(_bitmap_chunk(bits), "chunk int, bitmap binary").toLocalIterator():
        out[r["chunk"] * step: (r["chunk"] + 1) * step] = np.frombuffer(r["bitmap"], dtype=np.uint8)
    return out, bits


# --- scoring

_ASKED = "shard int, flush long, texts int, us binary, nd binary, docs binary, times binary, nb binary, w binary, bd binary, bdocs binary, btimes binary, ids binary, held binary, size binary"


def _references(key_runs: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of occurrences in order of (run, doc): texts per run, the texts, times in each."""
    at = _heads(key_runs, docs)
    times = np.diff(np.append(at, len(docs)))
    first = _heads(key_runs[at])
    return np.diff(np.append(first, len(at))), docs[at], times


def _gaps(docs: np.ndarray, runs: np.ndarray) -> np.ndarray:
    gaps = np.diff(docs, prepend=0)
    heads = np.cumsum(runs) - runs
    gaps[heads] = docs[heads]
    return gaps


def _from_gaps(gaps: np.ndarray, runs: np.ndarray) -> np.ndarray:
    walked, heads = np.cumsum(gaps), np.cumsum(runs) - runs
    return walked - np.repeat(walked[heads] - gaps[heads], runs)


def _ask_partition(bits: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, map_bits = shared.value
        base = TaskContext.get().partitionId() << 24
        for number, (u, w, doc, (ids, held)) in enumerate(_flushes(batches, ("doc_id", "held_out"))):
            w = short(w)
            order = np.argsort(u, kind="stable")
            su = u[order]
            us = su[_heads(su)]
            nd, docs, times = _references(su, doc[order])
            cell = bigram_keys(u, w) >> U64(64 - map_bits)
            likely = ((bitmap[cell >> U64(3)] >> (cell & U64(7)).astype(np.uint8)) & 1).astype(bool)
            bu, bw, bdoc = u[likely], w[likely], doc[likely]
            order = np.lexsort((bw, bu))
            bu, bw, bdoc = bu[order], bw[order], bdoc[order]
            at = _heads(bu, bw)
            run_no = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(bu))))
            bd, bdocs, btimes = _references(run_no, bdoc)
            bu, bw = bu[at], bw[at]
            nb = np.bincount(np.searchsorted(us, bu), minlength=len(us))
            u_at, b_at = np.concatenate(([0], np.cumsum(nd))), np.concatenate(([0], np.cumsum(nb)))
            r_at = np.concatenate(([0], np.cumsum(bd)))
            gaps, bgaps = _gaps(docs, nd), _gaps(bdocs, bd)
            n, rows = len(ids), []
            for shard, a, b in _shards(us, bits):
                d, e = slice(u_at[a], u_at[b]), slice(b_at[a], b_at[b])
                f = slice(r_at[e.start], r_at[e.stop])
                rows.append((shard, base + number, n, us[a:b].tobytes(), pack_small(nd[a:b]), pack_small(gaps[d]), pack_small(times[d]),
                             pack_small(nb[a:b]), _pack48(bw[e]), pack_small(bd[e]), pack_small(bgaps[f]), pack_small(btimes[f]), None, None, None))
            size = np.bincount(doc, minlength=n).astype(np.int64)
            known_ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flags = held.to_numpy(zero_copy_only=False).astype(np.uint8) + 2 * np.asarray(ids.is_null().to_numpy(zero_copy_only=False), dtype=np.uint8)
            rows.append((number % (1 << bits), base + number, n, *[None] * 9, known_ids.tobytes(), flags.tobytes(), size.tobytes()))
            yield _record(_ASKED, rows, [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 12)

    return run


_ASKED3 = "shard int, flush long, texts int, us binary, nb binary, w binary, nx binary, x binary, nd binary, docs binary, times binary, ids binary, held binary, size binary, base binary, known binary"


def _ask_trigrams(bits: int, shared=None, mass: int = 1):
    """Per flush and shard the distinct trigrams and the texts that have them.

    Words of the book have their counts there; their add-one parts (``mass``:
    what counts are divided by) are summed here, per text of the flush.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value if shared else _book()
        base = TaskContext.get().partitionId() << 24
        number = -1  # not enumerate(), which keeps its last item
        for u, w, doc, (ids, held) in _flushes(batches, ("doc_id", "held_out")):
            number += 1
            n = len(ids)
            size = np.bincount(doc, minlength=n).astype(np.int64)
            names, u, w, x = _ranked(u, w)
            codes, named = book.word_codes(names), np.append(short(names), U64(0))
            coded, c = book.codes(named), book.counts[codes]
            starts = np.cumsum(size) - size  # every text has a token, its end
            plain = _summed_runs(np.where(c > 0, np.log10((c + 1) / mass), 0.0)[w], starts)
            known = _summed_runs((c > 0).astype(np.int64)[w], starts)
            u, w, nx, x, nd, docs, times = _texts_by_trigram(u, w, x, doc, len(names) + 1, n)
            del doc
            gaps, r_at = _gaps(docs, nd), np.concatenate(([0], np.cumsum(nd)))
            del docs
            x_at, first = np.concatenate(([0], np.cumsum(nx))), _heads(u)
            us, codes, b_at = names[u[first]], codes[u[first]], np.append(first, len(u))
            nb, rows = np.diff(b_at), []
            for shard, a, b in _shards(us, bits):
                e = slice(b_at[a], b_at[b])
                d = slice(x_at[e.start], x_at[e.stop])
                f = slice(r_at[d.start], r_at[d.stop])
                rows.append((shard, base + number, n, pack_words(codes[a:b], us[a:b]), pack(nb[a:b]), pack_places(w[e], coded, named), pack(nx[e]),
                             pack_places(x[d], coded, named), pack(nd[d]), pack(gaps[f]), pack(times[f]), None, None, None, None, None))
            known_ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flags = held.to_numpy(zero_copy_only=False).astype(np.uint8) + 2 * np.asarray(ids.is_null().to_numpy(zero_copy_only=False), dtype=np.uint8)
            rows.append((number % (1 << bits), base + number, n, *[None] * 8, known_ids.tobytes(), flags.tobytes(), size.tobytes(), pack(plain), pack(known)))
            yield _record(_ASKED3, rows, [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 13)

    return run


def _mapped(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as read-only maps of one unlinked temporary file."""
    with tempfile.TemporaryFile() as f:
        places = []
        for a in arrays:
            places.append(f.tell())
            f.write(a.tobytes())
        f.flush()
        return [np.asarray(np.memmap(f, dtype=a.dtype, mode="r", offset=at, shape=a.shape)) if len(a) else a for a, at in zip(arrays, places)]


def _bucket_starts(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Where sorted mixed keys with the same top bits begin, about one key to a value of these bits, and how many other bits there are."""
    bits = max(1, len(keys).bit_length())
    sizes = np.bincount((keys >> U64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.cumsum(sizes) - sizes, 64 - bits


def _looked_up(keys: np.ndarray, values: np.ndarray, starts: tuple[np.ndarray, int], x: np.ndarray) -> np.ndarray:
    """The values of keys, 0 for one that is not there; mixed keys lie evenly, so few steps lead from a start to the key."""
    if not len(keys):
        return np.zeros(len(x))
    first, shift = starts
    last = len(keys) - 1
    at = np.minimum(first[(x >> U64(shift)).astype(np.int64)], last)
    left = np.flatnonzero(keys[at] < x)
    while len(left):
        at[left] += 1
        left = left[at[left] <= last]
        left = left[keys[at[left]] < x[left]]
    at = np.minimum(at, last)
    return np.where(keys[at] == x, values[at], 0.0).astype(np.float64)


# docs and rare are the texts that score, base and known are of; none: all texts of the flush.
_PARTS = "flush long, texts int, docs binary, score binary, rare binary, base binary, known binary, ids binary, held binary, size binary"


def _answer(t: Totals):
    """Sums per text of what one shard knows about the texts of each flush."""
    unknown = np.log10(t.p1(np.zeros(1, np.int64)))[0]

    def run(key, asked: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        parts = [np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, U64), np.zeros(0, np.float32)]
        for r in model.itertuples():
            parts = [np.frombuffer(x, dtype=k) for x, k in ((r.us, U64), (r.cu, np.int64), (r.value, np.float64), (r.keys, U64), (r.adds, np.float32))]
        words, counts, value, keys, adds = _mapped(*parts)
        starts, rows = _bucket_starts(keys), []
        for r in asked.itertuples():
            if r.ids is not None:
                rows.append((r.flush, r.texts, *[None] * 5, r.ids, r.held, r.size))
                continue
            us, nd = np.frombuffer(r.us, dtype=U64), unpack_small(r.nd)
            docs, times = _from_gaps(unpack_small(r.docs), nd), unpack_small(r.times)
            at = np.minimum(np.searchsorted(words, us), max(0, len(words) - 1))
            there = words[at] == us if len(words) else np.zeros(len(us), dtype=bool)
            c = np.where(there, counts[at], 0) if len(words) else np.zeros(len(us), np.int64)
            v = np.where(there, value[at], unknown) if len(words) else np.full(len(us), unknown)
            v = np.where(us == BEGIN, np.where(there, v, 0.0), v)
            plain = np.where(us == BEGIN, 0.0, np.log10((c + 1) / (t.tokens + t.words + 1)))
            score = np.bincount(docs, times * np.repeat(v, nd), minlength=r.texts)
            base = np.bincount(docs, times * np.repeat(plain, nd), minlength=r.texts)
            known = np.bincount(docs, times * np.repeat((c > 0) & (us != BEGIN), nd), minlength=r.texts)
            if len(keys):
                k = bigram_keys(np.repeat(us, unpack_small(r.nb)), _unpack48(r.w))
                bd = unpack_small(r.bd)
                add = _looked_up(keys, adds, starts, k)
                score += np.bincount(_from_gaps(unpack_small(r.bdocs), bd), unpack_small(r.btimes) * np.repeat(add, bd), minlength=r.texts)
            rows.append((r.flush, r.texts, None, pack(score), None, pack(base), pack(known.astype(np.int64)), None, None, None))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in _PARTS.split(", ")])

    return run


def _answer_trigrams(t: Totals, shared):
    """As ``_answer``, with every token asked by its trigram; the shard's arrays are made of its counts and of the replies, which come among the asked."""

    def run(key, asked: pd.DataFrame, merged: pd.DataFrame) -> pd.DataFrame:
        book, reply = shared.value, asked["n"].notna()
        model, rows = Trigrams(t, int(key[0]), merged, asked[reply], book), []
        asked = asked[~reply].astype({"flush": "int64", "texts": "int64"})  # nulls beside them made them doubles
        whole = asked["ids"].notna()
        for r in asked[whole].itertuples():
            rows.append((r.flush, r.texts, None, None, None, r.base, r.known, r.ids, r.held, r.size))
        asked = asked[~whole]
        size = np.array([len(a) + len(b) for a, b in zip(asked["x"], asked["docs"])], np.int64) + 8 * asked["texts"].to_numpy()
        for _, some in asked.groupby(np.cumsum(size) // ANSWERED, sort=False):
            rows += _answered(some, model, t, book)
        return pd.DataFrame(rows, columns=[x.split()[0] for x in _PARTS.split(", ")])

    return run


def _answered(asked: pd.DataFrame, model: Trigrams, t: Totals, book: Book) -> list[tuple]:
    """Sums per text of some rows, looked up at once: what a row costs besides does not grow with the number of shards."""
    read = lambda column: np.concatenate([unpack(b) for b in asked[column]])
    nb, nx, nd, times = read("nb"), read("nx"), read("nd"), read("times")
    contexts = [read_words([b]) for b in asked["us"]]
    codes, others = (np.concatenate(x) for x in zip(*contexts))
    us = book.words[codes]
    us[codes == 0] = others
    first = np.cumsum([0, *asked["texts"]])  # the texts of all flushes in a row
    add = model.added(us, nb, model.names.places(*read_names(asked["w"])), nx, model.names.places(*read_names(asked["x"])))
    end = np.concatenate(([0], np.cumsum(nd)))[np.concatenate(([0], np.cumsum(nx)))[np.concatenate(([0], np.cumsum(nb)))]]
    start, count = end[:-1], np.diff(end)  # of each context's texts
    docs = _from_gaps(read("docs"), nd) + np.repeat(np.repeat(first[:-1], [len(c) for c, _ in contexts]), count)
    rare = np.flatnonzero((book.counts[codes] == 0) & (us != BEGIN))  # the others are summed where they are asked
    c = model.word_counts(us[rare])
    at, of = ranges(start[rare], count[rare])
    scores = _per_text(docs, first, times * np.repeat(add, nd))
    bases = _per_text(docs[at], first, times[at] * np.log10((c + 1) / (t.tokens + t.words + 1))[of], times[at] * (c > 0)[of])
    return [(flush, texts, *a, *b, None, None, None) for flush, texts, a, b in zip(asked["flush"], asked["texts"], scores, bases)]


def _per_text(docs: np.ndarray, first: np.ndarray, values: np.ndarray, counts: np.ndarray | None = None) -> Iterator[tuple]:
    """Per flush the texts that occur in docs, packed by their gaps, and their sums of values and of counts."""
    n = int(first[-1])
    there = np.flatnonzero(np.bincount(docs, minlength=n))
    values, counts = np.bincount(docs, values, n)[there], None if counts is None else np.bincount(docs, counts, n)[there].astype(np.int64)
    edges = np.searchsorted(there, first)
    for a, b, start in zip(edges[:-1].tolist(), edges[1:].tolist(), first.tolist()):
        yield pack(np.diff(there[a:b] - start, prepend=0)), pack(values[a:b]), *(() if counts is None else (pack(counts[a:b]),))


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _texts_of_flush(t: Totals, end_value: float):
    """Adds the parts of one flush; the end token of each text has the same value everywhere."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        n = int(frame["texts"].iloc[0])
        score, base, known = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
        for r in frame.itertuples():
            if r.ids is not None:
                ids, flags, size = np.frombuffer(r.ids, dtype=np.int64), np.frombuffer(r.held, dtype=np.uint8), np.frombuffer(r.size, dtype=np.int64)
            if r.score is not None:
                score[_texts(r.docs)] += unpack_doubles(r.score)
            if r.base is not None:
                base[_texts(r.rare)] += unpack_doubles(r.base)
                known[_texts(r.rare)] += unpack(r.known)
        doc_id = pd.array(ids, dtype="Int64")
        doc_id[flags >= 2] = pd.NA
        return pd.DataFrame({"doc_id": doc_id, "held_out": flags % 2 == 1, "n_tokens": size, "n_known": known + (t.texts > 0),
                             "base_score": base + np.log10((t.texts + 1) / (t.tokens + t.words + 1)), "score": score + end_value})

    return run


def _texts(gaps: bytes | None) -> np.ndarray | slice:
    return slice(None) if gaps is None else np.cumsum(unpack(gaps))


def _stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def _by_shard(df: DataFrame, folder: str, name: str, bits: int) -> DataFrame:
    """As ``_stored``, in buckets of shards, so that what is grouped by shard later is not shuffled again."""
    table = f"kneser_ney_{uuid.uuid4().hex}"
    df.write.bucketBy(min(1 << bits, 1 << 16), "shard").option("path", f"{folder}/{name}").saveAsTable(table)
    return df.sparkSession.table(table)


@contextmanager
def _shuffles_given_up(spark):
    """Jobs started inside remove the files of their shuffles when they end; what they return is stored or small."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _end_shard(bits: int) -> int:
    return int(END) >> (64 - bits) if bits else 0


def fit(train: DataFrame, folder: str, bits: int, order: int, least: int, shared) -> tuple[DataFrame, DataFrame, Totals]:
    """The counts of the model's shards, the numbers of left neighbours each needs, and the totals, learnt from the texts of ``train``."""
    counted = train.select("text").mapInArrow(_count_partition(bits, order, shared), _COUNTS)
    # the shards of the end mark and of nothing have a row of counts in any case
    least_rows = train.sparkSession.range(1 << bits).where(F.col("id").isin(0, _end_shard(bits)))
    counted = counted.unionByName(least_rows.select(F.col("id").cast("int").alias("shard"), *[F.lit(b"").alias(c) for c in _ARRAYS]))
    merged = _by_shard(counted.groupBy("shard").applyInPandas(_merge_counts(least, order, shared), _MERGED), folder, "counts", bits)
    s = merged.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SUMS]).first()
    n = s["tokens"] + s["texts"]
    t = Totals(bits, n, s["words"] + (s["texts"] > 0), s["texts"], discounts(s["n1"] if least == 1 else n - s["kept_tokens"], s["n2"], s["n3"], s["n4"]), s["kept"],
               least=least, order=order, d3=discounts(s["m1"], s["m2"], s["m3"], s["m4"]))
    sent = merged.select("shard", "w", "cw").mapInPandas(_sent_words(t, shared), _SENT)
    both = sent.groupBy("shard").cogroup(merged.select("shard", "us", "cu").groupBy("shard"))
    replies = _stored(both.applyInPandas(_replies(t, shared), _REPLIES), folder, "replies")
    m = replies.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("types", "n1", "n2", "n3", "n4")]).first()
    t.types = m["types"]
    t.lower = discounts(m["n1"], m["n2"], m["n3"], m["n4"])
    more = t.words - m["n1"] - m["n2"]
    t.reserve = (t.lower[0] * m["n1"] + t.lower[1] * m["n2"] + t.lower[2] * more) / t.types if t.types else 1.0
    return merged, replies.select("shard", "origin", "n"), t


def score_texts(docs: DataFrame, train: DataFrame, held_out, shard_tokens: int = 3_000_000, order: int = 2, least: int = 2) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns the texts of ``train``; ``held_out`` is the column of docs handed on.
    Order 2 keeps bigrams seen ``least`` times or more; order 3 keeps all and needs ``least`` 1.
    """
    if order not in (2, 3) or least not in (1, 2) or (order, least) == (3, 2):
        raise ValueError("order 2 with least 1 or 2, or order 3 with least 1")
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/kneser-ney-{uuid.uuid4().hex}"
    size = train.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = int(np.ceil(np.log2(max(1, partitions, size / 6 / shard_tokens * (order - 1)))))
    with _shuffles_given_up(spark):
        shared = spark.sparkContext.broadcast(code_book(train, bits))
        merged, replies, t = fit(train, folder, bits, order, least, shared)
        if order == 2:
            model = _stored(merged.groupBy("shard").cogroup(replies.groupBy("shard")).applyInPandas(_valued(t, shared), _MODEL), folder, "model")
            bitmap, end = spark.sparkContext.broadcast(kept_bitmap(model, t.kept)), _end_value(model, t)
        else:
            end = _end_reply(merged, replies, t, shared.value)
    texts = docs.select("doc_id", held_out.alias("held_out"), "text")
    if order == 3:
        asked = texts.mapInArrow(_ask_trigrams(bits, shared, t.tokens + t.words + 1), _ASKED3).unionByName(replies, allowMissingColumns=True)
        parts = asked.groupBy("shard").cogroup(merged.select("shard", *_ARRAYS).groupBy("shard")).applyInPandas(_answer_trigrams(t, shared), _PARTS)
    else:
        parts = texts.mapInArrow(_ask_partition(bits, bitmap), _ASKED).groupBy("shard").cogroup(model.groupBy("shard")).applyInPandas(_answer(t), _PARTS)
    scored = parts.groupBy("flush").applyInPandas(_texts_of_flush(t, end), _SCORED)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(t.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def _end_value(model: DataFrame, t: Totals) -> float:
    """log10 p1 of the end mark, from its shard."""
    r = model.where(F.col("shard") == _end_shard(t.bits)).first()
    if r is not None:
        us = np.frombuffer(r["us"], dtype=U64)
        at = int(np.searchsorted(us, END))
        if at < len(us) and us[at] == END:
            return float(np.frombuffer(r["value"], dtype=np.float64)[at])
    return float(np.log10(t.p1(np.zeros(1, np.int64)))[0])


def _end_reply(merged: DataFrame, replies: DataFrame, t: Totals, book: Book) -> float:
    """log10 p1 of the end mark, from the counts and the reply of its shard to itself."""
    shard = _end_shard(t.bits)
    if not t.texts:
        return float(np.log10(t.p1(np.zeros(1, np.int64)))[0])
    words, _ = _own_words(merged.where(F.col("shard") == shard).select("us", "cu").toPandas(), t, shard, book)
    p = t.p1(unpack(replies.where((F.col("shard") == shard) & (F.col("origin") == -1)).first()["n"]))
    return float(np.log10(p[np.searchsorted(words, END)]))
