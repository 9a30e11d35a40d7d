"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

A Gaussian kernel over standardised statistics of the text is approximated by
``features`` random cosines with a fixed seed.  Every partition sums its part
of the normal equations; the sums are added in a shuffle, so the driver
receives ``MERGERS`` matrices of fixed size however many partitions there
are.  Isotonic regression on labelled rows that the ridge fit did not see,
collected by score bins, turns raw scores into probabilities.

Defined results: null and empty texts have all statistics 0 and get a score
like any other.  Rows without a label, or with a null one, teach nothing.
Without any label every score is 0.5; with labels of one kind only, that
label.  A null id counts as held out.  Equal texts get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.words import Words, slices, split_words, window_hashes
from contrail.session import cut_lineage

SLICE = 1 << 20
N_STATS = 16
MERGERS = 16
BIN = 500        # score bins of a unit
FOLDS = 5
# Byte classes: 1 upper, 2 lower, 3 digit, 4 symbol, 5 exclamation, 6 other punctuation, 7 not ASCII, 8 newline, 0 other
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 7
_CLASS[[b for b in range(33, 127) if _CLASS[b] == 0]] = 6
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 4
_CLASS[33], _CLASS[10] = 5, 8


def _distinct_per_row(rows: np.ndarray, h: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row and the count of the most frequent one."""
    if not len(rows):
        return np.zeros(n_rows), np.zeros(n_rows)
    order = np.lexsort((h, rows))
    r, x = rows[order], h[order]
    at = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (x[1:] != x[:-1])))
    most = np.zeros(n_rows)
    np.maximum.at(most, r[at], np.diff(np.append(at, len(r))))
    return np.bincount(r[at], minlength=n_rows), most


def statistics(w: Words) -> np.ndarray:
    """(rows, N_STATS) statistics; all 0 for a text without words."""
    n_rows, n = len(w.first) - 1, np.diff(w.first).astype(float)
    some = np.maximum(n, 1)
    size = np.diff(w.offsets)
    cls = np.bincount(np.repeat(np.arange(n_rows) * 9, size) + _CLASS[w.data], minlength=9 * n_rows).reshape(n_rows, 9)
    share = cls / np.maximum(size, 1)[:, None]
    rows, h = w.rows, w.hashes()
    length = (w.ends - w.starts).astype(float)
    mean = np.bincount(rows, length, minlength=n_rows) / some
    spread = np.sqrt(np.maximum(0, np.bincount(rows, length ** 2, minlength=n_rows) / some - mean ** 2))
    longest = np.zeros(n_rows)
    np.maximum.at(longest, rows, length)
    letters = np.concatenate(([0], np.cumsum(np.isin(_CLASS[w.data], (1, 2, 7)))))
    bare = np.bincount(rows, letters[w.ends] == letters[w.starts], minlength=n_rows) / some
    inner = rows[1:] == rows[:-1]
    again = np.bincount(rows[1:][inner], h[1:][inner] == h[:-1][inner], minlength=n_rows) / some
    kinds, most = _distinct_per_row(rows, h, n_rows)
    pairs, _ = _distinct_per_row(rows[:-1][inner], window_hashes(h, 2)[inner] if len(h) > 1 else h[:0], n_rows)
    out = np.stack([np.log1p(n), mean, spread, np.log1p(longest), np.sqrt(cls[:, 1] / np.maximum(1, cls[:, 1] + cls[:, 2] + cls[:, 7] / 2)),
                    np.sqrt(share[:, 3]), np.sqrt(share[:, 4]), np.sqrt(share[:, 5]), np.sqrt(share[:, 6]), np.sqrt(share[:, 7]),
                    np.sqrt(cls[:, 8] / some), np.log1p(kinds) / np.log1p(some), np.sqrt(again), pairs / np.maximum(1, n - 1),
                    np.sqrt(most / some), np.sqrt(bare)], axis=1)
    out[n == 0] = 0
    return out


def _stats_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            x = statistics(split_words(part.column("text")))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, N_STATS), pa.int32()), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), flat], ["doc_id", "x"])


def fold(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)).cast("int")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Fourier:
    """Random cosines approximating a Gaussian kernel of the given width."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, features: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.centre, self.scale = centre, np.where(scale > 1e-9, scale, 1.0)
        self.omega = rng.normal(0, 1 / width, (len(centre), features))
        self.phase = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -6, 6)
        cos = np.cos(z @ self.omega + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([cos, np.ones((len(x), 1))])


def summed(rows: DataFrame, part) -> np.ndarray | None:
    """Sum over all partitions of the float vectors ``part(batch)`` gives; merged in ``MERGERS`` tasks."""

    def add(vectors: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = None
        for v in vectors:
            total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def first(batches):
        return add(part(b) for b in batches if b.num_rows)

    def second(batches):
        return add(np.frombuffer(x, dtype=np.float64) for b in batches for x in b.column(0).to_pylist())

    merged = rows.mapInArrow(first, "sums binary").repartition(MERGERS).mapInArrow(second, "sums binary").collect()
    return np.sum([np.frombuffer(r["sums"], dtype=np.float64) for r in merged], axis=0) if merged else None


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points in order of x; returns the knots of the fitted steps."""
    blocks: list[list[float]] = []  # mean, weight, first x, last x
    for a, b, c in zip(x.tolist(), y.tolist(), weight.tolist()):
        blocks.append([b, c, a, a])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, n, _, last = blocks.pop()
            p = blocks[-1]
            p[0], p[1], p[3] = (p[0] * p[1] + m * n) / (p[1] + n), p[1] + n, last
    knots = [(e, m) for m, _, first, last in blocks for e in ((first, last) if last > first else (first,))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


@dataclass
class Model:
    """Scores of statistics; what the labels could not teach is left None."""

    fourier: Fourier | None = None
    beta: np.ndarray | None = None
    knots: np.ndarray | None = None
    values: np.ndarray | None = None

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.fourier(x) @ self.beta, -1.0, 2.0)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.beta is None:
            return np.full(len(x), 0.5)
        raw = self.raw(x)
        return np.clip(raw if self.knots is None else np.interp(raw, self.knots, self.values), 0.0, 1.0)


def fit(labelled: DataFrame, features: int = 300, width: float = 3.0, ridge: float = 0.1, seed: int = 7) -> Model:
    """A model learnt from (x, label, part): part 4 calibrates, the others fit."""
    one = labelled.where("part <> 4")

    def moments(b: pa.RecordBatch) -> np.ndarray:
        x = _matrix(b.column("x"), N_STATS)
        y = b.column("label").to_numpy().astype(float)
        return np.concatenate([[len(x), y.sum()], x.sum(0), (x ** 2).sum(0)])

    m = summed(one.select("x", "label"), moments)
    if m is None:
        return Model()
    n = m[0]
    centre = m[2: 2 + N_STATS] / n
    fourier = Fourier(centre, np.sqrt(np.maximum(0, m[2 + N_STATS:] / n - centre ** 2)), features, width, seed)

    def normal(b: pa.RecordBatch) -> np.ndarray:
        z = fourier(_matrix(b.column("x"), N_STATS))
        y = b.column("label").to_numpy().astype(float)
        return np.concatenate([(z.T @ z).reshape(-1), z.T @ y])

    s = summed(one.select("x", "label"), normal)
    k = features + 1
    model = Model(fourier, np.linalg.solve(s[: k * k].reshape(k, k) + ridge * np.eye(k), s[k * k:]))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.round(model.raw(_matrix(b.column("x"), N_STATS)) * BIN).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), b.column("label").cast(pa.int64())], ["bin", "label"])

    bins = labelled.where("part = 4").select("x", "label").mapInArrow(binned, "bin long, label long")
    bins = sorted(bins.groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).collect())  # at most 3 * BIN + 1 rows
    if not bins:
        return model
    at, count, ones = (np.array(c, dtype=float) for c in zip(*bins))
    model.knots, model.values = isotonic(at / BIN, ones / count, count)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``doc_id, held_out, score`` of every row of docs (doc_id, text), learnt from labels (doc_id, label)."""
    spark = docs.sparkSession
    stats = cut_lineage(docs.select("doc_id", "text").mapInArrow(_stats_partition, "doc_id long, x array<double>"))
    part = fold(F.col("doc_id"), FOLDS)
    marked = labels.where("label is not null").select("doc_id", "label").where(part != 0)
    labelled = cut_lineage(stats.join(marked, "doc_id").select("x", "label", part.alias("part")))
    model = spark.sparkContext.broadcast(fit(labelled, **settings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), N_STATS)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.value(x))], ["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(part == 0, F.lit(True)).alias("held_out"), "score")
