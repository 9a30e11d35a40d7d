"""Packed arrays of numbers and of words.

Numbers stand byte by byte (all lowest bytes, then all second ones), so that a
general compressor brings each to about its entropy.  A word is named by its
place in a book of frequent words, any other by its hash.  What a book holds
changes the size of an array, never what is read back from it.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

from contrail.llm.words import U64

_HEAD = struct.Struct("<BQ")   # bytes a value, values


def pack(values: np.ndarray) -> bytes:
    """Integers from 0, or the bits of doubles."""
    v = values.view("<u8") if values.dtype == np.float64 else values
    width = (int(v.max()).bit_length() + 7) // 8 if len(v) else 0
    planes = b"".join((v >> 8 * k if k else v).astype(np.uint8).tobytes() for k in range(width))
    small = pa.compress(planes, codec="zstd", asbytes=True) if len(planes) > 64 else planes
    return _HEAD.pack(width, len(v)) + (small if len(small) < len(planes) else planes)


def unpack(blob: bytes) -> np.ndarray:
    return _unpack(blob).view(np.int64)


def unpack_doubles(blob: bytes) -> np.ndarray:
    return _unpack(blob).view(np.float64)


def _unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, U64)
    width, n = _HEAD.unpack_from(blob)
    body = memoryview(blob)[_HEAD.size:]
    if len(body) < width * n:
        body = pa.decompress(body, decompressed_size=width * n, codec="zstd")
    planes = np.frombuffer(body, dtype=np.uint8, count=width * n).reshape(width, n)
    out = planes[0].astype(U64) if width else np.zeros(n, U64)
    for k in range(1, width):
        out |= planes[k].astype(U64) << U64(8 * k)
    return out


class Book:
    """Frequent words (64-bit hashes) and their counts; a word's code is its place from 1, other words have 0."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        _, first = np.unique(words >> U64(16), return_index=True)  # one word per name of 48 bits
        first.sort()
        self.words = np.concatenate([np.zeros(1, U64), words[first].astype(U64)])
        self.counts = np.concatenate([np.zeros(1, np.int64), counts[first].astype(np.int64)])
        self.names = self.words >> U64(16)
        self._code = (np.argsort(self.names[1:]) + 1).astype(np.int32)
        self._sorted = self.names[self._code]

    def codes(self, names: np.ndarray) -> np.ndarray:
        """Codes of words named by 48 bits."""
        if not len(self._code):
            return np.zeros(len(names), np.int32)
        at = np.minimum(np.searchsorted(self._sorted, names), len(self._code) - 1)
        return np.where(self._sorted[at] == names, self._code[at], 0).astype(np.int32)

    def word_codes(self, words: np.ndarray) -> np.ndarray:
        """Codes of words by all 64 bits of their hashes."""
        codes = self.codes(words >> U64(16))
        codes[self.words[codes] != words] = 0
        return codes

    def unpack_words(self, blob: bytes) -> np.ndarray:
        return self._filled(*_read(blob, 8), self.words)

    def unpack_names(self, blob: bytes) -> np.ndarray:
        return self._filled(*_read(blob, 6), self.names)

    @staticmethod
    def _filled(codes: np.ndarray, others: np.ndarray, listed: np.ndarray) -> np.ndarray:
        out = listed[codes]
        out[codes == 0] = others
        return out


def read_words(blobs) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words of packed arrays, 0 for one without, and the 64 bits of those without."""
    return _read_all(blobs, 8)


def read_names(blobs) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words of packed arrays, 0 for one without, and the names of those without."""
    return _read_all(blobs, 6)


def _read_all(blobs, size: int) -> tuple[np.ndarray, np.ndarray]:
    read = [_read(b, size) for b in blobs]
    return np.concatenate([np.zeros(0, np.int64), *[c for c, _ in read]]), np.concatenate([np.zeros(0, U64), *[o for _, o in read]])


def _read(blob: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    if not blob:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    end = 8 + int.from_bytes(blob[:8], "little")
    others = np.frombuffer(blob, dtype=np.uint8, offset=end).reshape(-1, size)
    raw = np.zeros((len(others), 8), dtype=np.uint8)
    raw[:, :size] = others
    return unpack(blob[8:end]), raw.reshape(-1).view("<u8")


class Names:
    """The distinct words of some packed arrays in the order of their names; a word's place there, their number for any other."""

    def __init__(self, book: Book, *parts: tuple[np.ndarray, np.ndarray]):
        listed = np.zeros(len(book.names), dtype=bool)
        for codes, _ in parts:
            listed[codes] = True
        listed[0] = False
        codes, others = np.flatnonzero(listed), np.sort(np.concatenate([o for _, o in parts]))
        others = others[np.diff(others, prepend=~others[:1]) != 0]
        names = np.concatenate([book.names[codes], others])
        order = np.argsort(names)
        self.names = names[order]
        self.codes = np.concatenate([codes, np.zeros(len(others), np.int64)])[order]
        self._of_code = np.full(len(listed), len(names), np.int32)
        self._of_code[self.codes] = np.arange(len(names))
        self._of_code[0] = len(names)

    def __len__(self) -> int:
        return len(self.names)

    def places(self, codes: np.ndarray, others: np.ndarray) -> np.ndarray:
        out = self._of_code[codes]
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, others), len(self.names) - 1)
            out[codes == 0] = np.where(self.names[at] == others, at, len(self.names))
        return out


def pack_words(codes: np.ndarray, words: np.ndarray) -> bytes:
    """Words by their codes (``word_codes``), those without one by 64 bits."""
    return _written(codes, words, 8)


def pack_names(codes: np.ndarray, names: np.ndarray) -> bytes:
    """Words by their codes, those without one by the 48 bits of their names."""
    return _written(codes, names, 6)


def pack_places(at: np.ndarray, codes: np.ndarray, names: np.ndarray) -> bytes:
    """As ``pack_names``, of codes[at] and names[at]."""
    codes = codes[at]
    return _packed(codes, names[at[codes == 0]], 6)


def _written(codes: np.ndarray, values: np.ndarray, size: int) -> bytes:
    return _packed(codes, values[codes == 0], size)


def _packed(codes: np.ndarray, others: np.ndarray, size: int) -> bytes:
    listed = pack(codes)
    return len(listed).to_bytes(8, "little") + listed + np.ascontiguousarray(others.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :size].tobytes()
