"""Near-duplicate classes from dart MinHash signatures.

A text is the set of its five-word shingles; how often it repeats one does
not count, in the bands as in the verification.  ``signatures`` takes weighted
sets, here of unit weights.  Hashed darts fall, as a unit Poisson process over
(weight, rank), into the weighted regions of each shingle; the regions double
in width.  A dart hits a text if its weight coordinate lies below the
shingle's weight there.  Every dart carries one of ``bands * rows``
coordinates, and a text keeps its earliest dart per coordinate, so the number
of darts looked at depends on the number of coordinates and hardly on the
length.  Two texts agree in a coordinate with the probability of their
(weighted) Jaccard similarity.

1. Texts with equal word sequences collapse to the smallest id.
2. Texts that agree in all coordinates of a band meet in a bucket.  The
   member that meets most others is the bucket's pivot; every member is
   compared with its pivots only.
3. A pair is linked if the exact Jaccard similarity of its shingle sets
   reaches the threshold.  Links give classes (smallest label, repeated).
4. Buckets whose members still belong to several classes are compared
   across classes.  Shingles that occur in no other text of these buckets
   bound what a text can share and leave out texts that cannot reach the
   threshold.  The others meet by their differences to what their group has
   in common (``_across``).  So no pair of a bucket is lost, while a large
   group of near copies costs one comparison per member and those few that
   the bounds leave open.

Defined results: a text of one to four words has one shingle, the whole; a
text without words (or null) is a class of its own, as is a null id (class
null).  Rows with one id are one document with several texts.  Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from contrail.llm.store import stored
from contrail.llm.words import U64, Words, mix, slices, split_words, window_hashes, window_starts
from contrail.session import cut_lineage

SLICE = 1 << 20
_STEP, _REGION = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)
_MASK = (1 << 64) - 1
_UNIT = 2.0 ** -53
_EPS = 1e-6  # rounding of the bounds; pairs let through are verified


def shingle_sets(w: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count) of every distinct shingle, ordered by row and shingle."""
    h = w.hashes(0)
    at = window_starts(w, size)
    rows = w.rows[at] if len(at) else np.zeros(0, np.int64)
    grams = window_hashes(h, size)[at] if len(at) else np.zeros(0, U64)
    lengths = np.diff(w.first)
    for n in range(1, size):  # a shorter text is one shingle
        short = np.flatnonzero(lengths == n)
        if len(short):
            rows = np.concatenate([rows, short])
            grams = np.concatenate([grams, window_hashes(h, n)[w.first[short]] ^ U64(n)])
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    head = np.ones(len(rows), dtype=bool)
    head[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])
    at = np.flatnonzero(head)
    return rows[at], grams[at], np.diff(np.append(at, len(rows)))


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> U64(11)).astype(np.float64) + 0.5) * _UNIT


def _throw(key: np.ndarray, width: np.ndarray, limit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Darts of each region in order of rank, up to its limit: (region, dart, rank).

    The gaps between ranks are exponential; regions expecting many darts draw
    them at once, the others one after another.
    """
    expect = limit * width
    many = np.flatnonzero(expect > 16)
    if len(many):
        n = (expect[many] + 8 * np.sqrt(expect[many]) + 16).astype(np.int64)
        reg = np.repeat(many, n)
        first = np.cumsum(n) - n
        nth = (np.arange(len(reg)) - np.repeat(first, n) + 1).astype(U64)
        dart = mix(key[reg] + nth * _STEP)
        gap = -np.log(_uniform(dart)) / width[reg]
        total = np.cumsum(gap)
        rank = total - np.repeat(total[first] - gap[first], n)
        keep = rank <= limit[reg]
        yield reg[keep], dart[keep], rank[keep]
    reg = np.flatnonzero(expect <= 16)
    rank, nth = np.zeros(len(reg)), 0
    while len(reg):
        nth += 1
        dart = mix(key[reg] + U64(nth * int(_STEP) & _MASK))
        rank = rank - np.log(_uniform(dart)) / width[reg]
        keep = rank <= limit[reg]
        reg, dart, rank = reg[keep], dart[keep], rank[keep]
        yield reg, dart, rank


def signatures(rows: np.ndarray, elements: np.ndarray, weights: np.ndarray, n_rows: int, k: int) -> np.ndarray:
    """Signature matrix (n_rows, k) of weighted sets given by (row, element, weight); empty rows stay 0."""
    sig = np.zeros((n_rows, k), dtype=U64)
    total = np.bincount(rows, weights, minlength=n_rows)
    spread = 5.0
    open_rows = total > 0
    while open_rows.any():
        take = open_rows[rows]
        row, element, weight = rows[take], elements[take], weights[take]
        limit = k * (np.log(k) + spread) / np.maximum(total, 1e-300)
        best = np.full(n_rows * k, np.inf)
        found = []
        # region 0 is [0, 1), region v >= 1 is [2**(v-1), 2**v)
        for v in range(int(np.ceil(np.log2(max(1.0, weight.max())))) + 1):
            low = 0.0 if v == 0 else 2.0 ** (v - 1)
            inside = np.flatnonzero(weight > low)
            if not len(inside):
                break
            span = 1.0 if v == 0 else low
            key = mix(element[inside] ^ U64(v * int(_REGION) & _MASK))
            for reg, dart, rank in _throw(key, np.full(len(inside), span), limit[row[inside]]):
                mark = mix(dart)
                at = low + span * _uniform(mix(mark ^ _STEP))
                hit = at < weight[inside[reg]]
                cell = row[inside[reg]][hit] * k + (mark[hit] >> U64(20)).astype(np.int64) % k
                np.minimum.at(best, cell, rank[hit])
                found.append((cell, dart[hit], rank[hit]))
        flat = sig.reshape(-1)
        for cell, dart, rank in found:
            won = rank == best[cell]
            flat[cell[won]] = dart[won]
        empty = np.isinf(best.reshape(n_rows, k)).any(axis=1)
        open_rows &= empty
        spread = 2 * spread + 5
    return sig


def text_keys(w: Words) -> list[np.ndarray]:
    """Two 64-bit hashes of the word sequence of each row."""
    out = []
    for which, base in ((0, 0xE7037ED1A0B428DB), (1, 0x8EBC6AF09C88C6E3)):
        h = w.hashes(which)
        up = np.full(len(h) + 1, base, dtype=U64)
        up[0] = 1
        up = np.cumprod(up)
        down = np.full(len(h) + 1, pow(base, -1, 1 << 64), dtype=U64)
        down[0] = 1
        down = np.cumprod(down)
        total = np.concatenate((np.zeros(1, U64), np.cumsum(h * up[:-1])))
        out.append(mix((total[w.first[1:]] - total[w.first[:-1]]) * down[w.first[:-1]] + np.diff(w.first).astype(U64)).astype(np.int64))
    return out


def _signature_partition(size: int, bands: int, band_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                w = split_words(part.column("text"))
                rows, grams, _ = shingle_sets(w, size)
                sig = signatures(rows, grams, np.ones(len(rows)), part.num_rows, bands * band_rows)
                keys = np.zeros((part.num_rows, bands), dtype=U64)
                for r in range(band_rows):
                    keys = mix((keys + sig[:, r::band_rows][:, :bands] * _REGION).reshape(-1)).reshape(keys.shape)
                keys = mix((keys + np.arange(bands, dtype=U64) * _STEP).reshape(-1)).astype(np.int64)
                t1, t2 = text_keys(w)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, bands), pa.int32()), pa.array(keys))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array(t1), pa.array(t2), pa.array(np.diff(w.first), pa.int64()), flat],
                                                 ["doc_id", "text_key", "t1", "t2", "n_words", "buckets"])

    return run


def _set_partition(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                rows, grams, _ = shingle_sets(split_words(part.column("text")), size)
                off = np.searchsorted(rows, np.arange(part.num_rows + 1))
                sets = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(grams.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), sets], ["doc", "grams"])

    return run


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets reach the similarity."""
    a = sets.select(F.col("doc").alias("a"), F.col("grams").alias("ga"))
    b = sets.select(F.col("doc").alias("b"), F.col("grams").alias("gb"))
    both = F.size(F.array_intersect("ga", "gb"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", both.alias("both"), (F.size("ga") + F.size("gb") - both).alias("either"))
    return joined.where(F.col("both") >= similarity * F.col("either")).select("a", "b").distinct()


def smallest_labels(edges: DataFrame) -> DataFrame:
    """(doc, label): the smallest node each node of the undirected edges reaches."""
    both = stored(edges.select(F.col("a").alias("doc"), F.col("b").alias("near"))
                  .unionByName(edges.select(F.col("b").alias("doc"), F.col("a").alias("near"))).distinct())
    labels = stored(both.groupBy("doc").agg(F.least(F.min("near"), F.col("doc")).alias("label")))
    while True:
        near = labels.select(F.col("doc").alias("near"), F.col("label").alias("of_near"))
        least = both.join(near, "near").groupBy("doc").agg(F.min("of_near").alias("least"))
        step = stored(labels.join(least, "doc").select("doc", F.col("label").alias("before"), F.least("label", "least").alias("label")))
        top = step.select(F.col("doc").alias("label"), F.col("label").alias("of_label"))
        moved = stored(step.join(top, "label").select("doc", "before", F.col("of_label").alias("label")))
        labels = moved.select("doc", "label")
        if moved.where("label < before").isEmpty():
            return labels


def near_duplicate_classes(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, class_id, n_spanning_links`` for every row: the smallest id of its class and
    the verified links of its text among those that span the class, not all its near copies."""
    return classes_by_text(docs, **settings).drop("text_key")


def classes_by_text(docs: DataFrame, similarity: float = 0.8, size: int = 5, bands: int = 32, band_rows: int = 4) -> DataFrame:
    """As ``near_duplicate_classes``, with ``text_key``, the ``xxhash64`` of the row's text, which
    tells the texts of an id apart."""
    texts = docs.select("doc_id", "text")
    hashed = texts.select("*", F.xxhash64("text").alias("text_key"))
    sig = cut_lineage(hashed.mapInArrow(_signature_partition(size, bands, band_rows), "doc_id long, text_key long, t1 long, t2 long, n_words long, buckets array<long>"))
    worded = sig.where("n_words > 0 and doc_id is not null")
    distinct = cut_lineage(worded.groupBy("t1", "t2").agg(F.min("doc_id").alias("doc"), F.first("buckets").alias("buckets")))
    placed = distinct.select("doc", F.explode("buckets").alias("bucket"))
    shared = cut_lineage(placed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    placed = cut_lineage(placed.join(shared, "bucket"))
    degree = cut_lineage(placed.groupBy("doc").agg(F.sum("n").alias("degree")))
    ranked = cut_lineage(placed.join(degree, "doc").select("bucket", "doc", F.struct("degree", (-F.col("doc")).alias("least")).alias("rank")))
    pivots = cut_lineage(ranked.groupBy("bucket").agg((-F.max("rank")["least"]).alias("pivot")))
    pairs = ranked.join(pivots, "bucket").where("doc <> pivot").select(F.col("doc").alias("a"), F.col("pivot").alias("b")).distinct()
    sets = texts.join(degree.select(F.col("doc").alias("doc_id")), "doc_id", "left_semi").mapInArrow(_set_partition(size), "doc long, grams array<long>")
    sets = cut_lineage(sets)
    links = stored(verified(pairs, sets, similarity))
    labels = smallest_labels(links)
    # Buckets that hold more than one class are looked through again, across classes.
    labelled = cut_lineage(ranked.select("bucket", "doc").join(labels, "doc", "left").select("bucket", "doc", F.coalesce("label", "doc").alias("label")))
    by_class = labelled.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    mixed = by_class.groupBy("bucket").agg(F.count("*").alias("classes"), F.max(F.struct("n", "label"))["label"].alias("main")).where("classes > 1")
    mixed = cut_lineage(mixed.select("bucket", "main"))
    members = cut_lineage(labelled.join(mixed, "bucket"))
    sizes = cut_lineage(_sizes(members.select("doc").distinct(), sets))
    members = cut_lineage(members.join(sizes, "doc"))
    shortest = cut_lineage(members.groupBy("bucket").agg(F.min("n").alias("shortest")))
    members = cut_lineage(members.join(shortest, "bucket").where(_reachable(similarity)))
    more = _across(stored(members.select("doc", "label", "main").distinct()), sets, similarity)
    more = more.join(links.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
    links = stored(links.unionByName(verified(cut_lineage(more), sets, similarity)))
    labels = smallest_labels(links)
    ends = links.select(F.explode(F.array("a", "b")).alias("doc")).groupBy("doc").agg(F.count("*").alias("n_spanning_links"))
    classes = distinct.select("t1", "t2", "doc").join(labels.join(ends, "doc", "left"), "doc", "left")
    classes = cut_lineage(classes.select("t1", "t2", F.coalesce("label", "doc").alias("class_id"), F.coalesce("n_spanning_links", F.lit(0)).alias("n_spanning_links")))
    lonely = sig.where("n_words = 0 or doc_id is null").select("doc_id", "text_key", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_spanning_links"))
    return worded.select("doc_id", "text_key", "t1", "t2").join(classes, ["t1", "t2"]).select("doc_id", "text_key", "class_id", "n_spanning_links").unionByName(lonely)


def _sizes(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(doc, n, most): shingles of each text, and those that another text of ``docs`` has as well."""
    own = cut_lineage(sets.join(docs, "doc", "left_semi"))
    alone = own.select("doc", F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("n"), F.min("doc").alias("doc")).where("n = 1")
    alone = alone.groupBy("doc").agg(F.count("*").alias("alone"))
    joined = own.select("doc", F.size("grams").alias("n")).join(alone, "doc", "left")
    return joined.groupBy("doc").agg(F.max("n").alias("n"), F.max(F.col("n") - F.coalesce("alone", F.lit(0))).alias("most"))


def _across(group: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of different labels in one group (doc, label, main) that may reach the similarity.

    The core of a group are the shingles of more than half of its texts.
    With d core shingles missing in a text of n, two texts share
    K - da - db shingles and as many more as their differences to the core
    have in common; they need ya + yb - K of those, where y = f n + d and
    f = similarity / (1 + similarity).  If the text of least y needs none of
    another, that pair is a link.  Whoever is too far from it for that must
    have enough differences in common with its partner, so they share one
    among the first (size - need + 1) of their differences, rarest first.
    """
    f = similarity / (1 + similarity)
    full = group.join(sets, "doc")
    size = group.groupBy("main").agg(F.count("*").alias("texts"))
    often = full.select("main", F.explode("grams").alias("gram")).groupBy("main", "gram").agg(F.count("*").alias("n"))
    core = stored(often.join(size, "main").where("2 * n > texts").groupBy("main").agg(F.collect_list("gram").alias("core")))
    beside = full.join(core, "main", "left").withColumn("core", F.coalesce("core", F.array().cast("array<long>")))
    beside = stored(beside.select("main", "doc", "label", F.size("core").alias("k"), F.array_except("core", "grams").alias("less"),
                                  F.array_except("grams", "core").alias("more"), (f * F.size("grams")).alias("fn")))
    placed = beside.select("main", "doc", "label", "k", (F.col("fn") + F.size("less")).alias("y"), F.explode(F.concat("less", "more")).alias("gram"))
    shared = placed.groupBy("main", "gram").agg(F.count("*").alias("df")).where("df > 1")
    nearest = beside.groupBy("main").agg(F.min(F.struct((F.col("fn") + F.size("less")).alias("y"), "doc", "label")).alias("least"))
    nearest = stored(nearest.select("main", F.col("least.y").alias("y0"), F.col("least.doc").alias("doc0"), F.col("least.label").alias("label0")))
    star = beside.join(nearest, "main").where(f"doc <> doc0 and label <> label0 and fn + size(less) + y0 - k <= {_EPS}")
    by_doc = W.partitionBy("main", "doc")
    ranked = placed.join(stored(shared), ["main", "gram"]).join(nearest.select("main", "y0"), "main")
    ranked = ranked.withColumn("rank", F.row_number().over(by_doc.orderBy("df", "gram"))).withColumn("size", F.count("*").over(by_doc))
    ranked = stored(ranked.withColumn("far", F.expr(f"y + y0 - k > {_EPS}")))
    far = ranked.where("far").select("main", "gram", "k", *[F.col(c).alias(f"{c}_a") for c in ("doc", "label", "y", "rank", "size")])
    every = ranked.select(F.col("main").alias("main_b"), F.col("gram").alias("gram_b"), "far", *[F.col(c).alias(f"{c}_b") for c in ("doc", "label", "y", "rank", "size")])
    need = f"(y_a + y_b - k - {_EPS})"
    pairs = far.join(every, F.expr(f"""main = main_b and gram = gram_b and label_a <> label_b and (doc_a < doc_b or not far)
        and rank_a <= size_a - {need} + 1 and rank_b <= size_b - {need} + 1"""))
    return star.select(F.col("doc").alias("a"), F.col("doc0").alias("b")).union(pairs.select("doc_a", "doc_b")).distinct()


def _reachable(similarity: float):
    """Whether a text can reach the similarity with any text of its bucket.

    It shares ``most`` shingles at best; the union with a text of m shingles
    then holds n + m - most, and no m in the bucket is below ``shortest``.
    """
    union = F.when(F.col("shortest") >= F.col("most"), F.col("n") + F.col("shortest") - F.col("most")).otherwise(F.col("n"))
    return F.col("most") >= similarity * union
