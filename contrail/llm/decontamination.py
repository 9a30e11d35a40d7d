"""Benchmark leaks: BM25 over test items with block-max pruning, then overlap of question and answer.

The test items are indexed, in passes of at most ``items_per_pass`` items, so
the broadcast index is bounded.  Long items are cut into segments; impacts
are divided by the segment's own score, so 1 is a passage holding all its
terms.  Postings are grouped in blocks of segments with the largest impact of
each term.  Documents are cut into chunks; two neighbouring chunks make a
passage, and every passage is a query: the sum of block maxima bounds the
score of all segments of a block, blocks below the threshold are skipped, and
the segments of the others are scored exactly.  So every passage meets all
segments that reach the threshold.  A hit counts if the document holds enough
of the word triples of both the question and the answer of the item: its last
line (or last sentence, or second half) is the answer, what precedes it the
question.

Defined results: null or empty texts and items match nothing.  A row with a
null id is judged like any other.  Items with one id give one row per
document at most, equal rows equal results.  Letters A-Z count as a-z, ASCII punctuation as white space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.words import Words, ranges, slices, split_buffer, text_buffer, window_hashes

CHUNK = 64       # words; a passage has two chunks
SEGMENT = 48     # words of an indexed segment at most: each lies within one passage
BLOCK = 16       # segments of a block
GRAM = 3
PART = 5         # words of a question or answer at least; else the item is cut in the middle
K1, B = 1.2, 0.75
SLICE = 1 << 20


# Bytes compared: letters A-Z count as a-z, ASCII punctuation as white space.
_COMPARED = np.array([b + 32 if 65 <= b <= 90 else b if chr(b).isalnum() or b >= 128 else 32 for b in range(256)], dtype=np.uint8)


def plain_words(texts: pa.Array) -> Words:
    data, off = text_buffer(texts)
    return split_buffer(_COMPARED[data], off)


def question_and_answer(text: str) -> tuple[str, str]:
    """The answer is the last line, else the last sentence, else the second half of the words."""
    for pattern in (r"\n+", r"(?<=[.?!])\s+"):
        parts = [p for p in re.split(pattern, text.strip()) if p.strip()]
        if len(parts) > 1 and len(parts[-1].split()) >= PART and sum(len(p.split()) for p in parts[:-1]) >= PART:
            return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    return " ".join(words[: len(words) // 2]), " ".join(words[len(words) // 2:])


def _grams(texts: list[str]) -> list[np.ndarray]:
    """Distinct word triples of each text; a shorter text is one gram."""
    w = plain_words(pa.array(texts, pa.string()))
    h = w.hashes()
    out = []
    for a, b in zip(w.first[:-1], w.first[1:]):
        out.append(np.unique(window_hashes(h[a:b], min(GRAM, b - a))) if b > a else np.zeros(0, np.uint64))
    return out


@dataclass
class Index:
    item_ids: list
    questions: list      # gram hashes of each item
    answers: list
    item_of: np.ndarray  # item of each segment
    terms: np.ndarray    # sorted term hashes
    post_at: np.ndarray  # per term, start of its postings (segment, impact)
    post_segment: np.ndarray
    post_impact: np.ndarray
    block_at: np.ndarray  # per term, start of its blocks (block, largest impact)
    block_no: np.ndarray
    block_max: np.ndarray
    blocks: int


def build_index(items: list[tuple]) -> Index | None:
    """Index of (id, text) items; None if no item has a word."""
    items = [(i, t) for i, t in items if len(plain_words(pa.array([t], pa.string())).starts)]
    if not items:
        return None
    w = plain_words(pa.array([t for _, t in items], pa.string()))
    h = w.hashes()
    segment = np.zeros(len(h), np.int64)
    item_of = []
    for k, (a, b) in enumerate(zip(w.first[:-1], w.first[1:])):
        pieces = -(-(b - a) // SEGMENT)
        segment[a:b] = len(item_of) + np.arange(b - a) * pieces // (b - a)
        item_of += [k] * int(pieces)
    n = len(item_of)
    terms, term = np.unique(h, return_inverse=True)
    pair, tf = np.unique(term * n + segment, return_counts=True)
    t, s = pair // n, pair % n
    length = np.bincount(segment, minlength=n)
    df = np.bincount(t, minlength=len(terms))
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    impact = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[s] / length.mean()))
    impact = impact / np.bincount(s, impact, minlength=n)[s]
    block = s // BLOCK
    blocks = n // BLOCK + 1
    key, at = np.unique(t * blocks + block, return_index=True)
    parts = [question_and_answer(x) for _, x in items]
    return Index([i for i, _ in items], _grams([q for q, _ in parts]), _grams([a for _, a in parts]), np.array(item_of), terms,
                 np.searchsorted(t, np.arange(len(terms) + 1)), s, impact,
                 np.searchsorted(key // blocks, np.arange(len(terms) + 1)), key % blocks, np.maximum.reduceat(impact, at), blocks)


def retrieve(ix: Index, w: Words, h: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, segment, score) of all passages and segments that reach the threshold."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    at = np.searchsorted(ix.terms, h)
    at[at == len(ix.terms)] = 0
    known = np.flatnonzero(ix.terms[at] == h)
    if not len(known):
        return none
    rows = w.rows
    lengths = np.diff(w.first)
    chunks = -(-lengths // CHUNK)
    first_chunk = np.cumsum(chunks) - chunks
    chunk = first_chunk[rows[known]] + (known - w.first[rows[known]]) // CHUNK
    n_chunks = int(chunks.sum())
    pair = np.unique(chunk * len(ix.terms) + at[known])
    chunk, term = pair // len(ix.terms), pair % len(ix.terms)
    # upper bounds of (chunk, block), then of passages of two chunks of one row
    where, of = ranges(ix.block_at[term], ix.block_at[term + 1] - ix.block_at[term])
    bound = np.bincount(chunk[of] * ix.blocks + ix.block_no[where], ix.block_max[where], minlength=n_chunks * ix.blocks).reshape(n_chunks, ix.blocks)
    chunk_row = np.repeat(np.arange(len(lengths)), chunks)
    has_next = np.zeros(n_chunks, dtype=bool)
    has_next[:-1] = chunk_row[1:] == chunk_row[:-1]
    passage = bound.copy()
    passage[:-1][has_next[:-1]] += bound[1:][has_next[:-1]]
    open_blocks = passage >= threshold - 1e-9
    alive = np.flatnonzero(open_blocks.any(axis=1))
    if not len(alive):
        return none
    # exact scores of the open blocks: distinct terms of both chunks
    start, end = np.searchsorted(chunk, alive), np.searchsorted(chunk, alive + 1 + has_next[alive])
    got, of = ranges(start, end - start)
    pair = np.unique(of * len(ix.terms) + term[got])
    of, term = pair // len(ix.terms), pair % len(ix.terms)
    where, back = ranges(ix.post_at[term], ix.post_at[term + 1] - ix.post_at[term])
    of, segment = of[back], ix.post_segment[where]
    keep = open_blocks[alive[of], segment // BLOCK]
    cell = of[keep] * len(ix.item_of) + segment[keep]
    cells, back = np.unique(cell, return_inverse=True)
    score = np.bincount(back, ix.post_impact[where][keep])
    hit = score >= threshold
    return chunk_row[alive[cells[hit] // len(ix.item_of)]], cells[hit] % len(ix.item_of), score[hit]


def leaks_of(ix: Index, w: Words, threshold: float, overlap: float) -> list[tuple[int, int, float, float, float]]:
    """(row, item, score, question overlap, answer overlap) of the verified hits of a slice."""
    h = w.hashes()
    rows, segments, scores = retrieve(ix, w, h, threshold)
    best: dict[tuple[int, int], float] = {}
    for r, k, s in zip(rows.tolist(), ix.item_of[segments].tolist(), scores.tolist()):
        best[r, k] = max(s, best.get((r, k), 0.0))
    out, grams, last = [], None, -1
    for (r, k), s in sorted(best.items()):
        if r != last:
            mine = h[w.first[r]: w.first[r + 1]]
            grams, last = np.concatenate([window_hashes(mine, n) for n in range(1, GRAM + 1)]), r
        q, a = (float(np.isin(x, grams).mean()) if len(x) else 1.0 for x in (ix.questions[k], ix.answers[k]))
        if q >= overlap and a >= overlap:
            out.append((r, k, s, q, a))
    return out


def _index_passes(items: DataFrame, items_per_pass: int) -> Iterator[Index]:
    """Indexes of at most ``items_per_pass`` items, whatever the number of items."""
    held: list[tuple] = []
    for r in items.select("item_id", "text").where("text is not null").toLocalIterator():
        held.append((r["item_id"], r["text"]))
        if len(held) == items_per_pass:
            if ix := build_index(held):
                yield ix
            held = []
    if held and (ix := build_index(held)):
        yield ix


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.6, overlap: float = 0.5, items_per_pass: int = 20_000) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap``: one row per leak of an item in a document."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ix = shared.value
            for batch in batches:
                for part in slices(batch, "text", SLICE):
                    found = leaks_of(ix, plain_words(part.column("text")), threshold, overlap)
                    if found:
                        row, item, *rest = zip(*found)
                        ids = part.column("doc_id").take(pa.array(row))
                        yield pa.RecordBatch.from_arrays([ids, pa.array([ix.item_ids[k] for k in item], pa.int64()), *map(pa.array, rest)],
                                                         ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        return run

    out = spark.createDataFrame([], schema)
    texts = docs.select("doc_id", "text").where("text is not null")
    for ix in _index_passes(items, items_per_pass):
        out = out.unionByName(texts.mapInArrow(search(spark.sparkContext.broadcast(ix)), schema))
    return out.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")])


def drop_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.6, overlap: float = 0.5, items_per_pass: int = 20_000) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item."""
    spark = docs.sparkSession

    def keep(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text", SLICE):
                    leaky = {r for r, *_ in leaks_of(shared.value, plain_words(part.column("text")), threshold, overlap)}
                    yield part.filter(pa.array([r not in leaky for r in range(part.num_rows)])) if leaky else part

        return run

    for ix in _index_passes(items, items_per_pass):
        docs = docs.mapInArrow(keep(spark.sparkContext.broadcast(ix)), docs.schema)
    return docs
