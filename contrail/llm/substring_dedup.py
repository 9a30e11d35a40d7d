"""Removal of passages that already start in an earlier document.

A window is ``n`` consecutive words of one document.  A word goes when a
window covering it has the same word sequence as a window of a document with
a smaller id.  Windows are judged on the input.

How it runs:

1. Every task counts its windows in a count-min sketch (``depth`` rows of
   ``2**bits`` cells) and emits the sparse cells, cut in chunks.  Chunks of
   all partitions are merged by chunk; what is kept of the merged sketch is
   one bit per cell: counted twice or more.  The sketch has a fixed largest
   size (``max_bits``), so its broadcast is bounded; a sketch too small for
   the corpus only lets more windows through.
2. A second pass keeps the windows whose estimate is two or more in every
   sketch row.  The estimate never falls below the true count, so none is
   lost.  Each flush of a task resolves its own repeats and sends a window
   only with its smallest document, hence a passage shared by a third of all
   documents reaches the exact grouping once per flush, not once per document.
3. Shards of the window hash space group the rest exactly, on 96 bits of hash.
4. Removal marks are gathered per document and joined to the texts.

Defined results: a null or empty text has no words and stays as it is.  A row
with a null id is neither judged nor a source.  Rows with the same id never
remove each other's words; equal rows get equal results.  Other columns pass
through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.words import (U64, Words, mix, pack_gaps, pack_small, slices, split_words, text_buffer, unpack_gaps, unpack_small,
                                 window_hashes, window_starts)

CHUNK_BITS = 22          # cells of one merged chunk
FLUSH = 1_200_000        # windows a task holds before it resolves and emits them
SLICE = 1 << 20          # text bytes hashed at a time
_ROW_SEED = (0x8CB92BA72F3D8DD7, 0xABA9E4F8D3C1F5B7, 0xD1B54A32D192ED03)


def _cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mix(h ^ U64(_ROW_SEED[row])) >> U64(64 - bits)


def _sketch_partition(n: int, bits: int, depth: int):
    chunk_bits = min(CHUNK_BITS, bits)

    def flush(hashes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h = np.concatenate(hashes)
        rows, chunks, blobs = [], [], []
        for r in range(depth):
            cells, counts = np.unique(_cells(h, r, bits), return_counts=True)
            cells = np.repeat(cells, np.minimum(counts, 2)).astype(np.int64)
            chunk = cells >> chunk_bits
            for part in np.split(cells, np.flatnonzero(np.diff(chunk)) + 1):
                if len(part):
                    c = int(part[0] >> chunk_bits)
                    rows.append(r), chunks.append(c), blobs.append(pack_gaps(part - (c << chunk_bits)))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(chunks, pa.int32()), pa.array(blobs, pa.binary())], ["row", "chunk", "cells"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                w = split_words(part.column("text"))
                at = window_starts(w, n)
                if len(at):
                    held.append(window_hashes(w.hashes(0), n)[at])
                    count += len(at)
                if count >= 3 * FLUSH:
                    yield from flush(held)
                    held, count = [], 0
        if held:
            yield from flush(held)

    return run


def _merge_chunk(bits: int):
    size = 1 << min(CHUNK_BITS, bits)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(size, dtype=np.uint8)
        for blob in frame["cells"]:
            cells, n = np.unique(unpack_gaps(blob), return_counts=True)
            counts[cells] = np.minimum(2, counts[cells] + np.minimum(n, 2).astype(np.uint8))
        bitmap = np.packbits(counts >= 2, bitorder="little").tobytes()
        return pd.DataFrame({"row": frame["row"].iloc[:1], "chunk": frame["chunk"].iloc[:1], "bitmap": [bitmap]})

    return run


def merged_sketch(texts: DataFrame, n: int, bits: int, depth: int) -> list[np.ndarray]:
    """Per sketch row a bitmap of the cells that all partitions together hit twice or more.

    At most ``depth * 2**bits / 8`` bytes reach the driver.
    """
    parts = texts.select("text").mapInArrow(_sketch_partition(n, bits, depth), "row int, chunk int, cells binary")
    merged = parts.groupBy("row", "chunk").applyInPandas(_merge_chunk(bits), "row int, chunk int, bitmap binary")
    maps = [np.zeros((1 << bits) // 8, dtype=np.uint8) for _ in range(depth)]
    step = (1 << min(CHUNK_BITS, bits)) // 8
    for r in merged.toLocalIterator():
        maps[r["row"]][r["chunk"] * step: (r["chunk"] + 1) * step] = np.frombuffer(r["bitmap"], dtype=np.uint8)
    return maps


def _estimated_twice(h: np.ndarray, maps: list[np.ndarray], bits: int) -> np.ndarray:
    keep = np.ones(len(h), dtype=bool)
    for r, bitmap in enumerate(maps):
        cells = _cells(h, r, bits)
        keep &= ((bitmap[cells >> U64(3)] >> (cells & U64(7)).astype(np.uint8)) & 1).astype(bool)
    return keep


def _order(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by window then document, and the group heads in that order."""
    order = np.lexsort((doc, h1))
    a, b = h1[order], h2[order]
    if np.any((a[1:] == a[:-1]) & (b[1:] != b[:-1])):  # different windows share 64 bits
        order = np.lexsort((doc, h2, h1))
        a, b = h1[order], h2[order]
    head = np.ones(len(a), dtype=bool)
    head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, head


def _later(h1, h2, doc) -> tuple[np.ndarray, np.ndarray]:
    """Which windows repeat one of a smaller document, and which have the smallest document."""
    order, head = _order(h1, h2, doc)
    least = doc[order][np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
    later = np.zeros(len(doc), dtype=bool)
    later[order] = doc[order] > least
    return later, ~later


def _marks(doc, key, pos) -> tuple[np.ndarray, np.ndarray, list]:
    """One row per document of the given (document, row key, position) triples."""
    order = np.lexsort((pos, key, doc))
    doc, key, pos = doc[order], key[order], pos[order]
    cut = np.flatnonzero((doc[1:] != doc[:-1]) | (key[1:] != key[:-1])) + 1
    at = np.concatenate(([0], cut)) if len(doc) else np.zeros(0, np.int64)
    return doc[at], key[at], [x.astype(np.int32).tobytes() for x in np.split(pos, cut)] if len(doc) else []


_SENT = "shard int, h1 binary, h2 binary, ids binary, keys binary, counts binary, pos binary"


def _pack_windows(h1, h2, row, pos, ids, keys) -> tuple:
    """Windows in order of row and position: each row's id and key once, positions as gaps."""
    heads = np.flatnonzero(np.diff(row, prepend=-1))
    gaps = np.diff(pos, prepend=0)
    gaps[heads] = pos[heads]
    rows = row[heads]
    return (h1.tobytes(), h2.tobytes(), np.diff(ids[rows], prepend=0).tobytes(), keys[rows].tobytes(),
            pack_small(np.diff(np.append(heads, len(row)))), pack_small(gaps))


def _unpack_windows(r) -> tuple:
    ids, keys = np.cumsum(np.frombuffer(r.ids, dtype=np.int64)), np.frombuffer(r.keys, dtype=np.int64)
    counts, gaps = unpack_small(r.counts), unpack_small(r.pos)
    walked = np.cumsum(gaps)
    heads = np.cumsum(counts) - counts
    pos = walked - np.repeat(walked[heads] - gaps[heads], counts)
    return np.frombuffer(r.h1, dtype=U64), np.frombuffer(r.h2, dtype=np.uint32), np.repeat(ids, counts), np.repeat(keys, counts), pos


def _repeats_partition(n: int, bits: int, maps, shards: int):
    names = [x.split()[0] for x in _SENT.split(", ")]
    kinds = [pa.int32()] + [pa.binary()] * 6

    def flush(held: list[tuple], ids: list[np.ndarray], keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h1, h2, row, pos = (np.concatenate(x) for x in zip(*held))
        ids, keys = np.concatenate(ids), np.concatenate(keys)
        later, first = _later(h1, h2, ids[row])
        rows = []
        for s in np.unique(ids[row[later]] % shards).tolist():  # resolved here: these only pass through the shards
            of = np.flatnonzero(later)[ids[row[later]] % shards == s]
            rows.append((s, None, None, ids[row[of]].tobytes(), keys[row[of]].tobytes(), None, pos[of].astype(np.int32).tobytes()))
        h1, h2, row, pos = h1[first], h2[first], row[first], pos[first]
        shard = ((h1 >> U64(40)) % U64(shards)).astype(np.int32)
        order = np.argsort(shard, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            if len(part):
                rows.append((int(shard[part[0]]), *_pack_windows(h1[part], h2[part], row[part], pos[part], ids, keys)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, keys, rows, count, sketch = [], [], [], 0, 0, maps.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                w = split_words(part.column("text"))
                at = window_starts(w, n)
                if not len(at):
                    continue
                h1 = window_hashes(w.hashes(0), n)[at]
                keep = _estimated_twice(h1, sketch, bits)
                if not keep.any():
                    continue
                h2 = (window_hashes(w.hashes(1), n)[at][keep] >> U64(32)).astype(np.uint32)
                at = at[keep]
                row = w.rows[at]
                held.append((h1[keep], h2, row + rows, at - w.first[row]))
                ids.append(part.column("doc_id").to_numpy()), keys.append(part.column("text_key").to_numpy())
                rows += part.num_rows
                count += len(at)
                if count >= FLUSH:
                    yield from flush(held, ids, keys)
                    held, ids, keys, rows, count = [], [], [], 0, 0
        if held:
            yield from flush(held, ids, keys)

    return run


def _pack_marks(doc, key, pos, buckets: int) -> pd.DataFrame:
    """One row per bucket of documents: ids and keys once, positions as gaps."""
    order = np.lexsort((pos, key, doc, doc % buckets))
    doc, key, pos = doc[order], key[order], pos[order]
    bucket = doc % buckets
    cut = np.flatnonzero(np.diff(bucket)) + 1
    rows = []
    for d, k, p in zip(np.split(doc, cut), np.split(key, cut), np.split(pos, cut)):
        if len(d):
            heads = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (k[1:] != k[:-1])))
            gaps = np.diff(p, prepend=0)
            gaps[heads] = p[heads]
            rows.append((int(d[0] % buckets), d[heads].tobytes(), k[heads].tobytes(), pack_small(np.diff(np.append(heads, len(d)))), pack_small(gaps)))
    return pd.DataFrame(rows, columns=["bucket", "ids", "keys", "counts", "pos"])


def _unpack_marks(r) -> tuple:
    counts, gaps = unpack_small(r.counts), unpack_small(r.pos)
    walked, heads = np.cumsum(gaps), np.cumsum(counts) - counts
    pos = walked - np.repeat(walked[heads] - gaps[heads], counts)
    return np.repeat(np.frombuffer(r.ids, dtype=np.int64), counts), np.repeat(np.frombuffer(r.keys, dtype=np.int64), counts), pos


def _resolve_shard(buckets: int):
    """Exact grouping of one shard; passes on the marks made by the tasks."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        local = frame["h1"].isna()
        made = [tuple(np.frombuffer(x, dtype=t) for x, t in ((r.ids, np.int64), (r.keys, np.int64), (r.pos, np.int32))) for r in frame.loc[local].itertuples()]
        sent = frame.loc[~local]
        if len(sent):
            h1, h2, doc, key, pos = (np.concatenate(x) for x in zip(*[_unpack_windows(r) for r in sent.itertuples()]))
            later, _ = _later(h1, h2, doc)
            made.append((doc[later], key[later], pos[later]))
        return _pack_marks(*(np.concatenate(x).astype(np.int64) for x in zip(*made)), buckets)

    return run


def _marks_by_document(frame: pd.DataFrame) -> pd.DataFrame:
    doc, key, pos = (np.concatenate(x) for x in zip(*[_unpack_marks(r) for r in frame.itertuples()]))
    d, k, p = _marks(doc, key, pos)
    return pd.DataFrame({"doc_id": d, "text_key": k, "marks": p})


def _cover(w: Words, marks: list, n: int) -> np.ndarray:
    """Words covered by a marked window."""
    edge = np.zeros(len(w.starts) + n + 1, dtype=np.int32)
    for row, blob in enumerate(marks):
        if blob:
            at = np.unique(np.frombuffer(blob, dtype=np.int32)).astype(np.int64) + w.first[row]
            edge[at] += 1
            edge[at + n] -= 1
    return np.cumsum(edge)[: len(w.starts)] > 0


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as Zstandard frames: they take two thirds of the room in the shuffle."""
    codec = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            data, off = text_buffer(part.column("text"))
            raw = data.tobytes()
            frames = [codec.compress(raw[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield part.set_column(part.schema.get_field_index("text"), "text", pa.array(frames, pa.binary()))


def _kept_partition(n: int, single_spaced: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                docs = pa.array([codec.decompress(x) for x in part.column("text").to_pylist()], pa.binary()).cast(pa.string())
                w = split_words(docs)
                gone = _cover(w, part.column("marks").to_pylist(), n)
                raw = w.data.tobytes()
                texts, removed = [], np.diff(np.concatenate(([0], np.cumsum(gone)))[w.first])
                for i, lost in enumerate(removed.tolist()):
                    if not lost:
                        body = raw[w.offsets[i]: w.offsets[i + 1]]
                        texts.append(b" ".join(body.split()) if single_spaced else body)
                        continue
                    a, b = w.first[i], w.first[i + 1]
                    keep = np.flatnonzero(~gone[a:b]) + a
                    if single_spaced:
                        texts.append(b" ".join([raw[s:e] for s, e in zip(w.starts[keep].tolist(), w.ends[keep].tolist())]))
                    else:
                        runs = [x for x in np.split(keep, np.flatnonzero(np.diff(keep) > 1) + 1) if len(x)]
                        texts.append(b" ".join([raw[w.starts[x[0]]: w.ends[x[-1]]] for x in runs]))
                cols = [part.column("doc_id"), part.column("rest"), pa.array(np.diff(w.first), pa.int64()), pa.array(removed, pa.int64()),
                        pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "rest", "n_words", "n_removed", "kept_text"])

    return run


def sketch_bits(texts: DataFrame, load: float, least: int = 20, most: int = 30) -> int:
    """Bits of a sketch row: cells for ``1 / load`` times the windows, words taken as six bytes."""
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return int(min(most, max(least, np.ceil(np.log2(max(1.0, size / 6 / load))))))


def repeated_passages(docs: DataFrame, n: int = 13, depth: int = 2, load: float = 0.6, max_bits: int = 30,
                      shards: int | None = None) -> DataFrame:
    """Removal marks: (doc_id, text_key, marks), the positions of repeated windows as int32 blob.

    ``text_key`` is ``xxhash64(text)``; it tells rows with one id but different texts apart.
    """
    spark = docs.sparkSession
    texts = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    bits = sketch_bits(texts, load, most=max_bits)
    maps = spark.sparkContext.broadcast(merged_sketch(texts, n, bits, depth))
    shards = shards or max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << max(0, bits - 22))
    sent = texts.mapInArrow(_repeats_partition(n, bits, maps, shards), _SENT)
    packed = sent.groupBy("shard").applyInPandas(_resolve_shard(shards), "bucket int, ids binary, keys binary, counts binary, pos binary")
    return packed.groupBy("bucket").applyInPandas(_marks_by_document, "doc_id long, text_key long, marks binary")


def remove_repeated_passages(docs: DataFrame, n: int = 13, single_spaced: bool = True, **sizes) -> DataFrame:
    """``doc_id, rest, n_words, n_removed, kept_text`` for every row of ``docs``.

    ``rest`` is a struct of all other columns but ``text``.  ``single_spaced``
    joins all kept words by one space; otherwise an untouched text stays as it
    is and the kept runs of others are joined by one space.
    """
    marks = repeated_passages(docs, n, **sizes)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(None).cast("int").alias("nothing")]
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text", F.struct(*others).alias("rest"))
    rest = rows.schema["rest"].dataType.simpleString()
    rows = rows.mapInArrow(_packed, f"doc_id long, text_key long, text binary, rest {rest}")
    joined = rows.join(marks.hint("shuffle_hash"), ["doc_id", "text_key"], "left")
    return joined.mapInArrow(_kept_partition(n, single_spaced), f"doc_id long, rest {rest}, n_words long, n_removed long, kept_text string")
