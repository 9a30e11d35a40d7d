"""Forests, boosted trees and linear models learnt on packed rows.

Spark's own learner keeps a row as an array with an int per one-hot feature and
a bag count per tree: at 64 features and 50 trees half a kilobyte, which no
executor holds, so that each of some thousand passes reads it from disk again.
Here a row is one small bin number per *input* column: the one-hot features of a
column exclude each other, so the histogram of its labels holds the statistics
of all of them.

All models grow in one job.  A task keeps its rows (above ``HELD`` bytes in an
unlinked scratch file) and the node each row is in; the tasks of a barrier stage
exchange their histograms with ``allGather`` and choose the same splits from the
sum.  A meeting takes a second whatever it carries (Spark sleeps that long), so
the models and some trees of the forest share each one, and up to ``ALONE`` rows
one task learns without any.  What is learnt is what Spark's learner learns from its parameters: up to
``maxBins`` bins cut at quantiles, variance gain, a random subset of the one-hot
features per node, Poisson bags (forest) or a Bernoulli sample (boosting) of the
rows per tree, a boosted tree fitted to twice the residual.  The results are
Spark's own model classes.  Random numbers differ from Spark's.

Linear models with a squared loss take no pass of their own: packing adds up the
products of all pairs of features, and the normal equations are solved from them.
"""

from __future__ import annotations

import base64
import json
import math
import pickle
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel,
                                   RandomForestRegressionModel, RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.session import ensure_checkpoint_dir

CHUNK = 1 << 16          # rows worked on at a time: their arrays stay in a core's cache
JOINT = 2048             # cells of a histogram over several columns
TABLE = 1 << 16          # nodes x cells up to which such a histogram is used
ALONE = 4_000_000        # rows one task learns from by itself
HELD = 200 << 20         # bytes a task keeps in memory
LANES = 4                # forest trees that grow at a time, at most
POINTS = 1000            # quantiles from which the bins are cut
MOST_TASKS = 64          # every task reads the histograms of all
PIECE = 1 << 19          # numbers exchanged at once
WIDE = 256               # features up to which products of pairs are added up
TREE_PARAMS = ("cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth",
               "maxMemoryInMB", "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed")
NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double,"
         " leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


# --- columns and bins ---------------------------------------------------------

class Layout:
    """Features in the order of the vector: numeric ones with their thresholds, then
    the one-hot block of each categorical column.  A *cell* is a bin of a column."""

    def __init__(self, thresholds: list[np.ndarray], labels: list[int]):
        self.thresholds, self.labels = [np.asarray(x, dtype=float) for x in thresholds], list(labels)
        k = len(self.thresholds)
        self.bins = [len(x) + 1 for x in self.thresholds] + [n + 1 for n in self.labels]   # a value unknown to the index has the last bin
        self.start = np.concatenate([[0], np.cumsum(self.bins)]).astype(int)
        self.dtype = np.uint8 if max(self.bins) <= 256 else np.uint16 if max(self.bins) <= 65536 else np.uint32
        first = k + np.concatenate([[0], np.cumsum(self.labels)]).astype(int)
        self.features = int(first[-1])
        self.column = np.repeat(np.arange(len(self.bins)), self.bins)             # of a cell
        self.bin = np.concatenate([np.arange(b) for b in self.bins])
        self.feature = np.concatenate([np.full(self.bins[j], j) for j in range(k)] + [np.minimum(first[i] + np.arange(n + 1), first[i] + n - 1) for i, n in enumerate(self.labels)])
        self.splits = self.bin < np.asarray(self.bins)[self.column] - 1           # the last bin ends no split
        self.is_numeric = self.column < k
        self.groups: list[list[int]] = []                                          # columns counted together
        for c in sorted(range(len(self.bins)), key=lambda c: -self.bins[c]):
            fit = next((g for g in self.groups if math.prod(self.bins[x] for x in g) * self.bins[c] <= JOINT), None)
            self.groups.append([c]) if fit is None else fit.append(c)

    def span(self, c: int) -> slice:
        return slice(self.start[c], self.start[c + 1])

    def binned(self, num: np.ndarray, cat: np.ndarray) -> np.ndarray:
        """Bins by column; x <= threshold i means a bin <= i, NaN lies above all."""
        out = np.empty((len(self.bins), len(num)), dtype=self.dtype)
        for j, cuts in enumerate(self.thresholds):
            out[j] = np.searchsorted(cuts, num[:, j], side="left")
        for i, n in enumerate(self.labels):
            out[len(self.thresholds) + i] = np.where((cat[:, i] >= 0) & (cat[:, i] < n), cat[:, i], n)
        return out


def cuts(points, most: int) -> np.ndarray:
    """Thresholds from equally weighted values, as Spark cuts them from its sample:
    between all values if they are few, else where the counts come closest to equal."""
    x = np.asarray([p for p in points if p is not None], dtype=float)
    values, counts = np.unique(x[np.isfinite(x)], return_counts=True)
    between = (values[:-1] + values[1:]) / 2
    if len(between) <= most - 1:
        return between
    stride, target, out = counts.sum() / most, counts.sum() / most, []
    for i, after in enumerate(np.cumsum(counts)[1:], 1):
        before = after - counts[i]
        if abs(before - target) < abs(after - target):
            out.append(between[i - 1])
            target += stride
    return np.unique(out)[:most - 1]


def layout_of(rows: DataFrame, numeric: int, labels: list[int], most: int) -> Layout:
    """Bins of the numeric features (``_num``) from quantiles of all rows."""
    q = f"array({', '.join(f'{i / POINTS}D' for i in range(POINTS + 1))})"
    got = rows.agg(*[F.expr(f"percentile_approx(_num[{j}], {q}, 1000)").alias(f"q{j}") for j in range(numeric)]).first() if numeric else []
    return Layout([cuts(x or [], most) for x in got], labels)


def products(num: np.ndarray, cat: np.ndarray, y: np.ndarray, labels: list[int]) -> np.ndarray:
    """Sums over the rows of all products of two of: the features, one, the label."""
    k, m = num.shape[1], num.shape[1] + sum(labels)
    x = np.zeros((len(y), m + 2))
    x[:, :k], x[:, m], x[:, m + 1], rows, first = num, 1, y, np.arange(len(y)), k
    for i, n in enumerate(labels):
        known = (cat[:, i] >= 0) & (cat[:, i] < n)
        x[rows[known], first + cat[known, i]] = 1
        first += n
    return x.T @ x


def packed(rows: DataFrame, layout: Layout, label: str, linear: bool) -> DataFrame:
    """Blocks of rows: their bins by column, their labels and, for linear models, their products, as bytes."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(held):
            both = sum(h[2] for h in held).tobytes() if linear else b""
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (np.concatenate([h[0] for h in held], axis=1).tobytes(), np.concatenate([h[1] for h in held]).tobytes(), both)],
                                              names=["bins", "y", "products"])
        held, n = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            y = b.column(2).to_numpy(zero_copy_only=False).astype(float)
            if not np.isfinite(y).all():
                raise ValueError(f"{label}: a label is missing or not finite")
            num, cat = (b.column(i).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, k) for i, k in enumerate((len(layout.thresholds), len(layout.labels))))
            held.append((layout.binned(num, cat), y, products(num, cat, y, layout.labels) if linear else None))
            n += len(y)
            if n >= CHUNK // 2:
                yield block(held)
                held, n = [], 0
        if held:
            yield block(held)
    return rows.select("_num", "_cat", F.col(label).cast("double").alias("_y")).mapInArrow(pack, "bins binary, y binary, products binary")


# --- a task's rows -------------------------------------------------------------

class Room:
    """Arrays in memory up to a number of bytes, then in a scratch file without a name."""

    def __init__(self, held: int):
        self.held, self.used, self.offset, self.file = held, 0, 0, None

    def empty(self, shape, dtype) -> np.ndarray:
        size = int(np.prod(shape)) * np.dtype(dtype).itemsize
        if self.used + size <= self.held or not size:
            self.used += size
            return np.empty(shape, dtype)
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        out = np.memmap(self.file, dtype, "r+", self.offset, tuple(np.atleast_1d(shape)))
        self.offset += -(-size // 4096) * 4096
        return np.asarray(out)

    def put(self, a: np.ndarray) -> np.ndarray:
        out = self.empty(a.shape, a.dtype)
        out[...] = a
        return out


class Part:
    """A chunk of rows: bins by column, the codes of each group of columns, their
    counts in the bag (None for ones), their labels, the rows left out, the nodes."""

    def __init__(self, bins, codes, w, y, out, node):
        self.bins, self.codes, self.w, self.y, self.out, self.node = bins, codes, w, y, out, node


def codes_of(bins: np.ndarray, layout: Layout) -> list[np.ndarray | None]:
    """A number per group of columns; None for a group of one."""
    out = []
    for g in layout.groups:
        code = None
        if len(g) > 1:
            code = bins[g[0]].astype(np.uint16)
            for c in g[1:]:
                code *= layout.bins[c]
                code += bins[c].astype(np.uint16)
        out.append(code)
    return out


# --- a tree --------------------------------------------------------------------

class Tree:
    """Grows by levels; the nodes of a level have consecutive numbers."""

    def __init__(self, layout: Layout, parts: list[Part], seed: list[int], depth: int, per_node: int, least: int):
        self.lay, self.parts, self.depth, self.per_node, self.least = layout, parts, depth, per_node, least
        self.rng = np.random.default_rng(seed)
        self.cell, self.left, self.right = (np.full(1, x, dtype=np.int64) for x in (-1, 0, 0))
        self.n, self.s, self.gain = np.zeros(1), np.zeros(1), np.full(1, -1.0)
        self.level, self.first, self.route = 0, 0, None
        self.open = np.ones(1, dtype=bool)   # nodes of the level that may be split
        self._draw()

    def _draw(self) -> None:
        """The features each open node may be split by."""
        m, a = self.lay.features, len(self.open)
        if self.per_node >= m:
            chosen = np.ones((a, m), dtype=bool)
        else:
            chosen = np.zeros((a, m), dtype=bool)
            np.put_along_axis(chosen, np.argpartition(self.rng.random((a, m)), self.per_node - 1, axis=1)[:, :self.per_node], True, axis=1)
        self.wanted = chosen[:, self.lay.feature] & self.lay.splits & self.open[:, None]

    @property
    def grows(self) -> bool:
        return self.level < self.depth and bool(self.open.any())

    def _move(self, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The nodes rows go to from theirs; rows in leaves stay."""
        column, onward, bits = self.route
        at = node.astype(np.int64)
        i = (column * bins.shape[1]).take(at)
        i += np.arange(bins.shape[1])
        at <<= bits
        at += bins.reshape(-1).take(i)
        return onward.take(at)

    def histograms(self) -> np.ndarray:
        """This task's rows and label sums per open node, in the cells its features need; at the root also in all."""
        lay, a = self.lay, len(self.open)
        needed = [c for c in range(len(lay.bins)) if self.wanted[:, lay.span(c)].any()]
        if not self.level and not needed:
            needed = [0]
        plan = []   # columns, cells, index of the codes or None
        for g, cols in enumerate(lay.groups):
            want = [c for c in cols if c in needed]
            size = math.prod(lay.bins[c] for c in cols)
            if len(want) > 1 and (a + 1) * size <= TABLE:
                plan.append((cols, want, size, g))
            else:
                plan += [([c], [c], lay.bins[c], None) for c in want]
        sums = [(np.zeros((a + 1) * p[2]), np.zeros((a + 1) * p[2])) for p in plan]
        for p in self.parts:
            if self.level:
                p.node[...] = self._move(p.bins, p.node)
            slot = p.node - np.uint16(self.first)     # nodes of upper levels wrap around
            if p.out is not None:
                slot |= p.out
            np.minimum(slot, a, out=slot)
            slot, w = slot.astype(np.int64), None if p.w is None else p.w.astype(float)
            y = p.y if w is None else w * p.y
            for (cols, _, size, g), (n, s) in zip(plan, sums):
                key = slot * size
                key += p.bins[cols[0]] if g is None else p.codes[g]
                n += np.bincount(key, w, minlength=len(n))
                s += np.bincount(key, y, minlength=len(s))
        cells = np.zeros((2, a, len(lay.column)))
        for (cols, want, size, g), both in zip(plan, sums):
            for k, x in enumerate(both):
                x = x.reshape(a + 1, *[lay.bins[c] for c in cols])[:a]
                for c in want:
                    cells[k, :, lay.span(c)] = x.sum(axis=tuple(i + 1 for i, d in enumerate(cols) if d != c))
        total = cells[:, 0, lay.span(needed[0])].sum(axis=1) if not self.level else np.zeros(0)
        return np.concatenate([total, cells[0][self.wanted], cells[1][self.wanted]])

    def split(self, told: np.ndarray) -> None:
        """The best split of each open node from the sums of all tasks; their children are the next level."""
        lay, a = self.lay, len(self.open)
        if not self.level:
            self.n[0], self.s[0], told = told[0], told[1], told[2:]
        cells = np.zeros((2, a, len(lay.column)))
        cells[0][self.wanted], cells[1][self.wanted] = np.split(told, 2)
        ids = np.arange(self.first, self.first + a)
        n, s = self.n[ids][:, None], self.s[ids][:, None]
        ln, ls = n - cells[0], s - cells[1]              # a one-hot feature sends its label to the right
        for c in range(len(lay.thresholds)):
            for k, x in ((0, ln), (1, ls)):
                x[:, lay.span(c)] = np.cumsum(cells[k][:, lay.span(c)], axis=1)
        rn, rs = n - ln, s - ls
        fits = self.wanted & (ln >= max(self.least, 1)) & (rn >= max(self.least, 1))
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(fits, ls * ls / ln + rs * rs / rn - s * s / n, -np.inf)
        best = gain.argmax(axis=1)
        rows = np.arange(a)
        gains = gain[rows, best]
        with np.errstate(divide="ignore", invalid="ignore"):
            parted = gains > 1e-11 * s[:, 0] ** 2 / n[:, 0]      # less is rounding
        k = np.flatnonzero(parted)
        start = len(self.n)
        self.cell[ids[k]], self.gain[ids[k]] = best[k], gains[k] / n[k, 0]
        self.left[ids[k]], self.right[ids[k]] = start + 2 * np.arange(len(k)), start + 2 * np.arange(len(k)) + 1
        children = [np.stack([x[k, best[k]], y[k, best[k]]], axis=1).reshape(-1) for x, y in ((ln, rn), (ls, rs))]
        self.n, self.s = np.concatenate([self.n, children[0]]), np.concatenate([self.s, children[1]])
        m = 2 * len(k)
        self.cell, self.gain = np.concatenate([self.cell, np.full(m, -1)]), np.concatenate([self.gain, np.full(m, -1.0)])
        self.left, self.right = np.concatenate([self.left, np.zeros(m, int)]), np.concatenate([self.right, np.zeros(m, int)])
        self._routes()
        self.level, self.first = self.level + 1, start
        self.open = self.n[start:] >= 2 * max(self.least, 1)
        self._draw()

    def _routes(self) -> None:
        lay, inner = self.lay, np.flatnonzero(self.cell >= 0)
        bits = (max(lay.bins) - 1).bit_length()
        onward = np.repeat(np.arange(len(self.n), dtype=np.uint16), 1 << bits).reshape(-1, 1 << bits)
        cell = self.cell[inner]
        bins = np.arange(1 << bits)
        right = np.where(lay.is_numeric[cell][:, None], bins > lay.bin[cell][:, None], bins == lay.bin[cell][:, None])
        onward[inner] = np.where(right, self.right[inner][:, None], self.left[inner][:, None])
        column = np.zeros(len(self.n), dtype=np.int64)
        column[inner] = lay.column[cell]
        self.route = column, onward.reshape(-1), bits

    def settle(self) -> None:
        """Rows go to their leaves; squared labels per leaf, of this task's rows."""
        squares = np.zeros(len(self.n) + 1)
        for p in self.parts:
            if self.level:
                p.node[...] = self._move(p.bins, p.node)
            at = p.node if p.out is None else np.where(p.out, len(self.n), p.node)
            yy = p.y * p.y
            if p.w is not None:
                yy *= p.w
            squares += np.bincount(at, yy, minlength=len(squares))
        self.squares, self.value = squares[:-1], self.s / np.maximum(self.n, 1)

    def nodes(self) -> dict:
        return {k: getattr(self, k) for k in ("cell", "left", "right", "n", "s", "gain", "squares", "value")}


def grown(tree: Tree):
    """Yields this task's histograms of a level, takes their sum over all tasks; then the rows are in their leaves."""
    while tree.grows:
        tree.split((yield tree.histograms()))
    tree.settle()


class Lane:
    """A generator that asks for sums, and what it was told last."""

    def __init__(self, steps):
        self.steps, self.told, self.asks, self.ended = steps, None, None, False

    def go(self) -> None:
        try:
            self.asks = self.steps.send(self.told)
        except StopIteration:
            self.ended = True


def together(chains: list, fillers: list, exchange: Callable[[np.ndarray], np.ndarray]) -> None:
    """Runs generators side by side; what they yield goes through one exchange.  While
    it is under way half of ``fillers`` work, the others' questions travel with it."""
    chains, halves, turn = [Lane(x) for x in chains], [[Lane(x) for x in fillers[k::2]] for k in (0, 1)], 0
    for x in halves[0]:
        x.go()
    with ThreadPool(1) as meeting:
        while True:
            for x in chains:
                x.go()
            chains, halves = [x for x in chains if not x.ended], [[x for x in half if not x.ended] for half in halves]
            asked = chains + halves[turn]
            if not asked and not halves[1 - turn]:
                return
            answer = meeting.apply_async(exchange, [np.concatenate([x.asks for x in asked])]) if asked else None
            for x in halves[1 - turn]:
                x.go()
            if answer is not None:
                for x, told in zip(asked, np.split(answer.get(), np.cumsum([len(x.asks) for x in asked])[:-1])):
                    x.told = told
            turn = 1 - turn


# --- what a task learns ----------------------------------------------------------

def poisson_table(rate: float) -> np.ndarray:
    """Bag counts by a random 16-bit number."""
    p = np.exp(-rate) * np.cumprod(np.concatenate([[1.0], rate / np.arange(1, 40)]))
    return np.searchsorted(np.cumsum(p), (np.arange(65536) + 0.5) / 65536).astype(np.uint8)


def random16(rng: np.random.Generator, n: int) -> np.ndarray:
    return rng.integers(0, 1 << 64, -(-n // 4), dtype=np.uint64).view(np.uint16)[:n]


def boosting(plan: dict, layout: Layout, chunks: list, room: Room, task: int, found: dict):
    """One tree after the other, fitted to the label, then to twice the residual."""
    parts = [Part(bins, codes, None, room.put(y), room.empty(len(y), np.uint16) if plan["rate"] < 1 else None, room.empty(len(y), np.uint16)) for bins, codes, y in chunks]
    for i in range(plan["trees"]):
        rng = np.random.default_rng([plan["seed"], i, task])
        for x in parts:
            x.node[...] = 0
            if x.out is not None:
                x.out[...] = np.where(random16(rng, len(x.node)) < round(plan["rate"] * 65536), 0, 65535)
        tree = Tree(layout, parts, [plan["seed"], i], plan["depth"], plan["per_node"], plan["least"])
        yield from grown(tree)
        for x in parts:
            step = tree.value.take(x.node)
            step *= 2 * plan["step"] if i else 1
            x.y -= step
            if not i:
                x.y *= 2
        found["trees"][i] = tree.nodes()
    found["errors"] = lambda: (x.y / 2 for x in parts)


def bagged(plan: dict, layout: Layout, chunks: list, numbers: range, total: list, room: Room, task: int, found: dict):
    """Some trees of a forest, each on a bag of the rows; adds their predictions of all rows up."""
    table = poisson_table(plan["rate"])
    parts = [Part(bins, codes, room.empty(len(y), np.uint8), y, None, room.empty(len(y), np.uint16)) for bins, codes, y in chunks]
    for i in numbers:
        rng = np.random.default_rng([plan["seed"], i, task])
        for x in parts:
            x.node[...] = 0
            x.w[...] = table.take(random16(rng, len(x.w)))
        tree = Tree(layout, parts, [plan["seed"], i], plan["depth"], plan["per_node"], plan["least"])
        yield from grown(tree)
        for x, m in zip(parts, total):
            m += tree.value.take(x.node)
        found["trees"][i] = tree.nodes()


def chunks_of(batches: Iterator[pa.RecordBatch], layout: Layout, room: Room, linear: bool) -> tuple[list, np.ndarray]:
    """The task's rows in chunks of ``CHUNK`` and a rest; the sum of their products."""
    out, held, n, both = [], [], 0, np.zeros((layout.features + 2) ** 2 * linear)

    def keep(rows):
        nonlocal held, n
        bins, y = np.concatenate([h[0] for h in held], axis=1), np.concatenate([h[1] for h in held])
        held, n = ([(bins[:, rows:], y[rows:])], len(y) - rows) if len(y) > rows else ([], 0)
        bins = np.ascontiguousarray(bins[:, :rows])
        out.append((room.put(bins), [None if c is None else room.put(c) for c in codes_of(bins, layout)], room.put(y[:rows])))

    for b in batches:
        for bins, y, pairs in zip(*b.columns):
            both += np.frombuffer(pairs.as_buffer())
            y = np.frombuffer(y.as_buffer(), dtype=float)
            held.append((np.frombuffer(bins.as_buffer(), dtype=layout.dtype).reshape(len(layout.bins), len(y)).copy(), y.copy()))
            n += len(y)
            while n >= CHUNK:
                keep(CHUNK)
    if n:
        keep(n)
    return out, both


def learn_here(batches: Iterator[pa.RecordBatch], layout: Layout, plans: dict[str, dict], linear: bool, task: int, exchange) -> tuple[dict, np.ndarray]:
    """One task's part in learning all models; every task ends with the same trees."""
    room = Room(HELD)
    chunks, both = chunks_of(batches, layout, room, linear)
    told = exchange(np.concatenate([[sum(len(y) for _, _, y in chunks), sum(y.sum() for _, _, y in chunks)], both]))
    (rows, total), both = told[:2], told[2:].reshape(-1, layout.features + 2)
    found = {name: {"trees": [None] * p["trees"]} for name, p in plans.items()}
    levels = {name: p["trees"] * p["depth"] for name, p in plans.items()}
    longest = max((levels[name] for name, p in plans.items() if p["step"] is not None), default=0)
    chains, fillers = [], []
    for name, p in plans.items():
        if p["step"] is not None:
            chains.append(boosting(p, layout, chunks, room, task, found[name]))
            continue
        side_by_side = min(LANES, p["trees"], -(-2 * levels[name] // longest) if longest else LANES)   # done when the boosting is
        mean = [room.put(np.zeros(len(y))) for _, _, y in chunks]
        fillers += [bagged(p, layout, chunks, range(k, p["trees"], side_by_side), mean, room, task, found[name]) for k in range(side_by_side)]
        found[name]["errors"] = lambda mean=mean, n=p["trees"]: (y - x / n for (_, _, y), x in zip(chunks, mean))
    together(chains, fillers, exchange)
    trees = [t for f in found.values() for t in f["trees"]]
    squares = exchange(np.concatenate([t["squares"] for t in trees]))
    for t, x in zip(trees, np.split(squares, np.cumsum([len(t["n"]) for t in trees])[:-1])):
        t["squares"] = x
        for i in np.flatnonzero(t["cell"] >= 0)[::-1]:      # of inner nodes from their children, which have larger numbers
            x[i] = x[t["left"][i]] + x[t["right"][i]]
    sums = [sum((((y - total / rows) ** 2).sum() for _, _, y in chunks), 0.0)]
    for f in found.values():
        sums += np.sum([[0.0, 0.0], *[[(e * e).sum(), np.abs(e).sum()] for e in f.pop("errors")()]], axis=0).tolist()
    sst, *errors = exchange(np.array(sums)).tolist()
    for f, sse, sae in zip(found.values(), errors[::2], errors[1::2]):
        f["metrics"] = {"n": int(rows), "r2_score": 1 - sse / sst if sst else None, "mae": sae / rows, "rmse": math.sqrt(sse / rows), "mse": sse / rows}
    return found, both


def learn(blocks: DataFrame, layout: Layout, plans: dict[str, dict], linear: bool, tasks: int) -> tuple[dict, np.ndarray]:
    """Trees and training metrics by model, and the sum of products, from one job over ``blocks``."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = BarrierTaskContext.get() if tasks > 1 else None

        def exchange(mine: np.ndarray) -> np.ndarray:
            if ctx is None:
                return mine
            out = np.zeros(len(mine))
            for i in range(0, len(mine), PIECE):
                for x in ctx.allGather(base64.b64encode(mine[i:i + PIECE].tobytes()).decode()):   # in the order of the tasks
                    out[i:i + PIECE] += np.frombuffer(base64.b64decode(x))
            return out

        number = ctx.partitionId() if ctx else 0
        found = learn_here(batches, layout, plans, linear, number, exchange)
        if not number:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], names=["found"])

    return pickle.loads(blocks.repartition(tasks).mapInArrow(task, "found binary", barrier=tasks > 1).collect()[0]["found"])


# --- Spark's estimators and models ------------------------------------------------

def features_per_node(strategy: str, m: int, trees: int) -> int:
    """Spark's reading of featureSubsetStrategy."""
    strategy = strategy.lower()
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": m, "sqrt": math.ceil(math.sqrt(m)), "log2": max(1, math.ceil(math.log2(m))), "onethird": math.ceil(m / 3)}
    if strategy in named:
        return named[strategy]
    return min(int(strategy), m) if strategy.isdigit() else min(m, math.ceil(float(strategy) * m))


def can_learn(est) -> bool:
    """Whether ``est`` is a forest or boosted trees without settings that are left to Spark's learner."""
    if type(est) not in (RandomForestRegressor, GBTRegressor):
        return False
    of = lambda p: est.getOrDefault(p)
    own = of("bootstrap") if isinstance(est, RandomForestRegressor) else of("lossType") == "squared" and not est.isSet("validationIndicatorCol")
    return bool(own and of("impurity") == "variance" and of("minInfoGain") == 0 and of("minWeightFractionPerNode") == 0
                and of("maxDepth") <= 14 and not est.isSet("weightCol") and not of("leafCol"))


def can_solve(est, features: int) -> bool:
    """Whether ``est`` is least squares, with a ridge penalty or none, of few enough features."""
    of = lambda p: est.getOrDefault(p)
    return type(est) is LinearRegression and features <= WIDE and bool(
        of("loss") == "squaredError" and of("solver") in ("auto", "normal") and of("fitIntercept") and not est.isSet("weightCol")
        and (of("regParam") == 0 or of("elasticNetParam") == 0 and not of("standardization")))


def solved(est, both: np.ndarray, spark) -> tuple:
    """The linear model of the products' sums, and its R2: Spark's penalty is n regParam / std(label) on the squared
    coefficients.  Of the solutions that one-hot columns and an intercept leave equal, the least in scaled coefficients."""
    m = len(both) - 2
    n, mean = both[m, m], both[:, m] / both[m, m]
    g = both / n - np.outer(mean, mean)
    sst = g[m + 1, m + 1]
    a = g[:m, :m] + np.eye(m) * (est.getOrDefault("regParam") / math.sqrt(sst) if sst > 0 else 0)
    scale = np.sqrt(np.where(np.diag(a) > 1e-14 * np.diag(both)[:m] / n, np.diag(a), np.inf))
    beta = np.linalg.pinv(a / np.outer(scale, scale), rcond=1e-11, hermitian=True) @ (g[:m, m + 1] / scale) / scale
    sse = max(0.0, sst - 2 * beta @ g[:m, m + 1] + beta @ g[:m, :m] @ beta)
    jvm, sc = spark._jvm, spark.sparkContext
    made = LinearRegressionModel(jvm.org.apache.spark.ml.regression.LinearRegressionModel(est.uid, _py2java(sc, Vectors.dense(beta)), float(mean[m + 1] - beta @ mean[:m])))
    return est._copyValues(made), {"n": int(n), "r2_score": float(1 - sse / sst) if sst > 0 else None}


def _plan(est, m: int) -> dict:
    boosted = isinstance(est, GBTRegressor)
    trees = est.getOrDefault("maxIter") if boosted else est.getOrDefault("numTrees")
    return {"trees": trees, "depth": est.getOrDefault("maxDepth"), "least": est.getOrDefault("minInstancesPerNode"),
            "per_node": features_per_node(est.getOrDefault("featureSubsetStrategy"), m, 1 if boosted else trees),
            "rate": est.getOrDefault("subsamplingRate"), "step": est.getOrDefault("stepSize") if boosted else None,
            "seed": est.getOrDefault("seed") & 0xFFFFFFFF}


def fit_all(estimators: dict, rows: DataFrame, numeric: int, labels: list[int], label: str) -> dict[str, tuple]:
    """Each estimator's model and its metrics on ``rows``: stored, with the scaled numeric
    columns in ``_num``, the label indexes in ``_cat`` and the label.  Needs as many
    free task slots as it has tasks, at the same time."""
    sc, spark = rows.sparkSession.sparkContext, rows.sparkSession
    slots = max(1, sc.defaultParallelism // int(sc.getConf().get("spark.task.cpus", "1")))
    tasks = 1 if rows.count() <= ALONE else min(slots, MOST_TASKS)
    out, linear = {}, {name: est for name, est in estimators.items() if isinstance(est, LinearRegression)}
    grown = {name: est for name, est in estimators.items() if name not in linear}
    for most in sorted({est.getOrDefault("maxBins") for est in grown.values()}):
        same = {name: est for name, est in grown.items() if est.getOrDefault("maxBins") == most}
        layout = layout_of(rows, numeric, labels, most)
        found, both = learn(packed(rows, layout, label, bool(linear)), layout, {name: _plan(est, layout.features) for name, est in same.items()}, bool(linear), tasks)
        for name, est in same.items():
            out[name] = (model(est, found[name]["trees"], layout, spark), found[name]["metrics"])
        out |= {name: solved(est, both, spark) for name, est in linear.items()}
        linear = {}
    return out


def _nodes(tree: dict, layout: Layout) -> list[tuple]:
    """Rows of Spark's model table, a node before what is below it."""
    left, right, cell = (tree[k].tolist() for k in ("left", "right", "cell"))
    order, todo = [], [0]
    while todo:
        i = todo.pop()
        order.append(i)
        if cell[i] >= 0:
            todo += [right[i], left[i]]
    place = {i: k for k, i in enumerate(order)}
    out = []
    for i in order:
        n, s, q, c = float(tree["n"][i]), float(tree["s"][i]), float(tree["squares"][i]), cell[i]
        split, kids = (-1, [], -1), (-1, -1)
        if c >= 0:
            j = int(layout.column[c])
            split = (int(layout.feature[c]), [float(layout.thresholds[j][layout.bin[c]]) if layout.is_numeric[c] else 0.5], -1)
            kids = (place[left[i]], place[right[i]])
        out.append((place[i], float(tree["value"][i]), max(0.0, q / n - (s / n) ** 2) if n else 0.0, [n, s, q], int(n), float(tree["gain"][i]), *kids, split))
    return out


def model(est, trees: list[dict], layout: Layout, spark):
    """Spark's model of the learnt trees, written in its format into the shared folder and loaded."""
    boosted = isinstance(est, GBTRegressor)
    kind = GBTRegressionModel if boosted else RandomForestRegressionModel
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/trees-{uuid.uuid4().hex}"
    mine, default = ({p.name: v for p, v in x.items()} for x in (est._paramMap, est._defaultParamMap))

    def meta(cls, uid, keep, **more):
        return json.dumps({"class": f"org.apache.spark.ml.regression.{cls}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
                           "paramMap": {k: v for k, v in mine.items() if keep(k)}, "defaultParamMap": {k: v for k, v in default.items() if keep(k)}} | more)

    top = meta(kind.__name__, est.uid, lambda k: True, numFeatures=layout.features, numTrees=len(trees))
    each = [(i, meta("DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}", TREE_PARAMS.__contains__), est.getOrDefault("stepSize") if boosted and i else 1.0) for i in range(len(trees))]
    spark.createDataFrame([(top,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(i, x) for i, t in enumerate(trees) for x in _nodes(t, layout)], NODES).coalesce(1).write.parquet(f"{path}/data")
    return kind.load(path)
