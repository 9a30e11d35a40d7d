"""Vectorised word splitting and hashing over Arrow text columns.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``.  Splitting
and hashing work on the UTF-8 buffer of a whole Arrow slice with numpy, so a
task never builds a Python object per word.  Null texts hold no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Odd bases of the two polynomial hashes modulo 2**64; odd numbers have inverses.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer over unsigned 64-bit integers."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 20)
        up = np.full(size, base & _MASK, dtype=U64)
        down = np.full(size, pow(base, -1, 1 << 64), dtype=U64)
        up[0] = down[0] = 1
        have = _powers[base] = (np.cumprod(up), np.cumprod(down))
    return have


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and its row offsets into them."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    off = np.frombuffer(arr.buffers()[1], dtype=kind)[arr.offset: arr.offset + len(arr) + 1].astype(np.int64)
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[off[0]: off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


@dataclass
class Words:
    data: np.ndarray     # UTF-8 bytes of all rows
    offsets: np.ndarray  # byte offset of each row, one more than rows
    starts: np.ndarray   # first byte of each word
    ends: np.ndarray     # byte after each word
    first: np.ndarray    # index of each row's first word, one more than rows

    @property
    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, which: int = 0, data: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of each word; ``data`` replaces the bytes (case folding)."""
        data = self.data if data is None else data
        if not len(self.starts):
            return np.zeros(0, U64)
        up, down = _power_table(BASES[which], len(data) + 1)
        total = np.empty(len(data) + 1, dtype=U64)
        total[0] = 0
        np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=total[1:])
        h = (total[self.ends] - total[self.starts]) * down[self.starts]
        return mix(h + (self.ends - self.starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def split_words(arr: pa.Array) -> Words:
    return split_buffer(*text_buffer(arr))


def split_buffer(data: np.ndarray, off: np.ndarray) -> Words:
    body = (data != 0x20) & (data - np.uint8(9) > 4)
    begins, ends = body.copy(), body.copy()
    begins[1:] &= ~body[:-1]
    ends[:-1] &= ~body[1:]
    edge = off[:-1][off[:-1] < len(data)]  # a row's first byte never continues the row before
    begins[edge] = body[edge]
    edge = off[1:][(off[1:] > 0)] - 1
    ends[edge] = body[edge]
    starts = np.flatnonzero(begins)
    return Words(data, off, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, off))


def window_hashes(h: np.ndarray, n: int, base: int = 0xA0761D6478BD642F) -> np.ndarray:
    """Hash of the ``n`` consecutive hashes from each position (may cross rows)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out, c = np.zeros(m, dtype=U64), 1
    for k in range(n):
        out += h[k: k + m] * U64(c)
        c = c * base & _MASK
    return mix(out)


def window_starts(w: Words, n: int) -> np.ndarray:
    """Indices of the words at which a window of ``n`` words of one row starts."""
    m = len(w.starts) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    rows = w.rows
    return np.flatnonzero(rows[:m] == rows[n - 1:])


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``max_bytes``.

    A single longer text forms a run of its own; no row is split or dropped.
    """
    _, off = text_buffer(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        end = int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield batch.slice(at, end - at)
        at = end


def pack_gaps(sorted_cells: np.ndarray) -> bytes:
    """Gap code: runs of 255 plus a remainder byte per cell; a gap of 0 is a second count."""
    gaps = np.diff(sorted_cells, prepend=0)
    long = gaps // 255
    out = np.full(int(long.sum()) + len(gaps), 255, dtype=np.uint8)
    out[np.cumsum(long + 1) - 1] = gaps % 255
    return out.tobytes()


def unpack_gaps(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, dtype=np.uint8)
    return np.cumsum(raw.astype(np.int64))[raw != 255]


def pack_small(values: np.ndarray) -> bytes:
    """Two bytes for a value below 65535; larger ones repeat 65535 first."""
    long = values // 65535
    out = np.full(int(long.sum()) + len(values), 65535, dtype=np.uint16)
    out[np.cumsum(long + 1) - 1] = values % 65535
    return out.tobytes()


def unpack_small(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, dtype=np.uint16)
    ends = raw != 65535
    return np.diff(np.cumsum(raw.astype(np.int64))[ends], prepend=0)


def ranges(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions start..start+count of every entry, and the entry of each."""
    of = np.repeat(np.arange(len(count)), count)
    return np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count), of
