"""Frequent phrases and their association scores, mined by SETM.

The occurrence relation of the words, sorted by piece and position, is written
to the shared folder in slices of one language.  A round merge-joins the
relation of the phrases of k words with that of the words on the piece and the
adjacent position, counts the groups over all slices, keeps the frequent ones
and semi-joins the occurrences with them; what is left is written and is what
the next round extends.  Pieces lie on one number line with a gap between
them, so "same piece and next position" is one equality.

A slice names its words by codes of its own.  For counting it sends each shard
of the group ids its distinct groups with their counts, not its occurrences;
the answer names the frequent ones.  Identities are exact: a word is compared
as a string, a longer phrase by the ids of its first words and its last word.

Defined results: a null text is empty, a null language is ``und``.  Repeated
rows count as often as they stand there.  A text without a word and an empty
table give no phrase.  Ties in the score go by count, then by the phrase's
bytes.  Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.store import stored
from contrail.llm.words import mix, slices

SLICE_BYTES = 4 << 20
SHARD_ROWS = 1_000_000
_GAP, _BREAK = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, dtype=np.uint8)  # 0 in a word, 1 between words, 2 between pieces
_KIND[list(_GAP)], _KIND[list(_BREAK)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes."""
    wide = np.ascontiguousarray(values, dtype="<u8")
    width = max((int(wide.max()).bit_length() + 7) // 8, 1) if len(wide) else 1
    planes = wide.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    width = blob[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), dtype=np.uint8).reshape(width, -1)
    wide = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    wide[:, :width] = planes.T
    return wide.reshape(-1).view("<u8").astype(np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=0))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob))


def located_words(data: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words of lower-cased bytes and their positions, which skip a number at each new piece."""
    kind = _KIND[data]
    body = kind == 0
    edge = np.diff(body.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(kind == 2)[starts] if len(starts) else starts
    at = np.arange(len(starts)) + np.cumsum(np.diff(piece, prepend=piece[:1]) > 0)
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[body].tobytes()))
    return words.dictionary_encode(), at


def _slice_row(lang: str, data: np.ndarray, n: int) -> pa.RecordBatch | None:
    words, at = located_words(data)
    if not len(at):
        return None
    codes = words.indices.to_numpy()
    counts = np.bincount(codes, minlength=len(words.dictionary))
    order = np.argsort(-counts, kind="stable")  # frequent words get small codes
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    number = (TaskContext.get().partitionId() << 24) + n
    listed = words.dictionary.take(pa.array(order)).cast(pa.string())
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([lang]), one(listed), one(pa.array(counts[order], pa.int64())),
                                       pa.array([pack_sorted(at)], pa.binary()), pa.array([pack(rank[codes])], pa.binary())], ["slice", "lang", "words", "counts", "at", "codes"])


def _locate(slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}
        n = 0

        def cut(lang: str, last: bool) -> np.ndarray:
            """The held bytes up to the last break between pieces, or all."""
            data = np.concatenate(held[lang])
            ends = np.flatnonzero(_KIND[data] == 2)
            end = len(data) if last else int(ends[-1]) + 1 if len(ends) else 0
            held[lang], size[lang] = [data[end:]], len(data) - end
            return data[:end]

        for batch in (x for whole in batches for x in slices(whole, "text", slice_bytes)):
            langs = pc.fill_null(batch.column("lang"), "und")
            wide = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            texts = pc.binary_join_element_wise(wide, *pa.array(["", "\n"], pa.large_string()))  # a text ends its piece
            for lang in pc.unique(langs).to_pylist():
                arr = pc.filter(texts, pc.equal(langs, lang))
                off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset: arr.offset + len(arr) + 1]
                raw = _LOWER[np.frombuffer(arr.buffers()[2], np.uint8)[off[0]: off[-1]]]
                for i in range(0, len(raw), slice_bytes):
                    held.setdefault(lang, []).append(raw[i: i + slice_bytes])
                    size[lang] = size.get(lang, 0) + len(held[lang][-1])
                    if size[lang] >= slice_bytes or sum(size.values()) >= 4 * slice_bytes:
                        most = max(size, key=size.get)
                        row = _slice_row(most, cut(most, False), n)
                        n += 1
                        if row is not None:
                            yield row
        for lang in list(held):
            row = _slice_row(lang, cut(lang, True), n)
            n += 1
            if row is not None:
                yield row

    return run


def located(docs: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The words' occurrence relation: a row per slice, sorted by piece and position."""
    return stored(docs.select("lang", "text").mapInArrow(_locate(slice_bytes), "slice long, lang string, words array<string>, counts array<long>, at binary, codes binary"))


def _frequent_only(place: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """Semi-join of a slice's words with the frequent ones; ids become a table by code."""
    if not len(place) or not len(known):
        return pd.DataFrame(columns=_STATE_NAMES)
    row = place.iloc[0]
    at, codes = unpack_sorted(row["at"]), unpack(row["codes"])
    known = known.sort_values("code")
    new = np.full(int(codes.max()) + 1, -1, dtype=np.int64)
    new[known["code"].to_numpy()] = np.arange(len(known))
    codes = new[codes]
    keep = codes >= 0
    packed = pack_sorted(at[keep]), pack(codes[keep]), pack(known["id"].to_numpy())
    return pd.DataFrame([(row["slice"], *packed, *packed)], columns=_STATE_NAMES)


_STATE = "slice long, word_at binary, word_codes binary, word_ids binary, at binary, codes binary, ids binary"
_STATE_NAMES = [c.split()[0] for c in _STATE.split(", ")]


class _Extended:
    """The merge join of a slice: phrases of k words with the word behind them, grouped."""

    def __init__(self, word_at, word_codes, word_ids, at, codes, ids, k: int, shards: int):
        self.word_at, self.word_codes, self.word_ids = unpack_sorted(word_at), unpack(word_codes), unpack(word_ids)
        at, codes, ids = unpack_sorted(at), unpack(codes), unpack(ids)
        behind = np.searchsorted(self.word_at, at + k)
        behind[behind == len(self.word_at)] = 0
        hit = self.word_at[behind] == at + k if len(self.word_at) else np.zeros(len(at), bool)
        self.at = at[hit]
        pairs = codes[hit] * len(self.word_ids) + self.word_codes[behind[hit]]
        group, self.of, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        left, right = ids[group // max(len(self.word_ids), 1)], self.word_ids[group % max(len(self.word_ids), 1)]
        key = mix(mix(left.astype(np.uint64)) + right.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        shard = (key % np.uint64(shards)).astype(np.int64)
        self.order = np.lexsort((right, left, shard))
        self.left, self.right, self.counts = left[self.order], right[self.order], counts[self.order]
        self.bounds = np.searchsorted(shard[self.order], np.arange(shards + 1))


def _ask(k: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                number = row.pop("slice")
                x = _Extended(**row, k=k, shards=shards)
                rows = [(s, number, pack_sorted(x.left[a:b]), pack(x.right[a:b]), pack(x.counts[a:b]))
                        for s, (a, b) in enumerate(zip(x.bounds, x.bounds[1:])) if b > a]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                                                     ["shard", "slice", "lefts", "rights", "counts"])

    return run


_COUNTED = "kind int, shard int, slice long, l long, r long, id long, a long, places binary, ids binary"


def _count(shards: int, least: int):
    """Group counts of whole shards: rows of kind 0 are frequent groups, of kind 1 answers to slices."""
    names = [c.split()[0] for c in _COUNTED.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def counted(shard: int, asks: list[dict]) -> Iterator[pa.RecordBatch]:
        left = [unpack_sorted(x["lefts"]) for x in asks]
        size = np.array([len(x) for x in left])
        left, right = np.concatenate(left), np.concatenate([unpack(x["rights"]) for x in asks])
        counts = np.concatenate([unpack(x["counts"]) for x in asks])
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        new = np.ones(len(left), dtype=bool)
        new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        firsts = np.flatnonzero(new)
        total = np.add.reduceat(counts[order], firsts)
        often = total >= least
        ids = np.full(len(firsts), -1, dtype=np.int64)
        ids[often] = np.arange(int(often.sum())) * shards + shard
        at, n = firsts[often], int(often.sum())
        if not n:
            return
        blank = pa.nulls(n, pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, shard, np.int32)), pa.nulls(n, pa.int64()), pa.array(left[at]), pa.array(right[at]),
                                          pa.array(ids[often]), pa.array(total[often]), blank, blank], names)
        of = np.empty(len(order), dtype=np.int64)
        of[order] = ids[np.cumsum(new) - 1]
        start = np.cumsum(size) - size
        rows = []
        for ask, a, m in zip(asks, start, size):
            mine = of[a: a + m]
            found = np.flatnonzero(mine >= 0)
            if len(found):
                rows.append((1, shard, ask["slice"], None, None, None, None, pack_sorted(found), pack(mine[found])))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, asks = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard and asks:
                    yield from counted(shard, asks)
                    asks = []
                shard = row["shard"]
                asks.append(row)
        if asks:
            yield from counted(shard, asks)

    return run


def _semi_join(k: int, shards: int):
    def run(state: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(state) or not len(answers):
            return pd.DataFrame(columns=_STATE_NAMES)
        row = state.iloc[0]
        x = _Extended(*[row[c] for c in _STATE_NAMES[1:]], k=k, shards=shards)
        code = np.full(len(x.left), -1, dtype=np.int64)
        ids, n = [], 0
        for shard, places, found in zip(answers["shard"], answers["places"], answers["ids"]):
            found = unpack(found)
            code[x.order[x.bounds[shard] + unpack_sorted(places)]] = n + np.arange(len(found))
            ids.append(found)
            n += len(found)
        codes = code[x.of]
        keep = codes >= 0
        return pd.DataFrame([(row["slice"], row["word_at"], row["word_codes"], row["word_ids"], pack_sorted(x.at[keep]), pack(codes[keep]), pack(np.concatenate(ids)))],
                            columns=_STATE_NAMES)

    return run


def frequent_phrases(docs: DataFrame, max_words: int, least: int, slice_bytes: int = SLICE_BYTES, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``max_words`` words found ``least`` times or more, and the words of each language.

    The first table is ``lang, n_words, phrase, a``, the second ``lang, n``.
    """
    place = located(docs, slice_bytes)
    words = place.select("slice", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "w")).select(
        "slice", "lang", "code", F.col("w.words").alias("phrase"), F.col("w.counts").alias("c"))
    per_lang = stored(place.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("c")).groupBy("lang").agg(F.sum("c").alias("n")))
    total = per_lang.agg(F.sum("n")).first()[0] or 0
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_rows))
    vocabulary = stored(words.groupBy("lang", "phrase").agg(F.sum("c").alias("a")).where(F.col("a") >= least).withColumn("id", F.monotonically_increasing_id()))
    # Ids without holes between the partitions: number in the partition times partitions, plus the partition.
    parts = (vocabulary.agg(F.max(F.shiftright("id", 33))).first()[0] or 0) + 1
    vocabulary = vocabulary.withColumn("id", F.col("id").bitwiseAND((1 << 33) - 1) * parts + F.shiftright("id", 33))
    known = words.join(vocabulary, ["lang", "phrase"]).select(F.col("slice").alias("of"), "code", "id")
    state = stored(place.select("slice", "at", "codes").groupBy("slice").cogroup(known.groupBy("of")).applyInPandas(_frequent_only, _STATE))
    level = vocabulary
    found = [level.select("lang", F.lit(1).alias("n_words"), "phrase", "a")]
    for k in range(1, max_words):
        asks = state.mapInArrow(_ask(k, shards), "shard int, slice long, lefts binary, rights binary, counts binary")
        counted = stored(asks.repartition(shards, "shard").sortWithinPartitions("shard", "slice").mapInArrow(_count(shards, least), _COUNTED))
        groups = counted.where("kind = 0").select("l", "r", "id", "a")
        last = vocabulary.select("id", F.col("phrase").alias("last"))
        level = stored(groups.join(level.select("lang", "phrase", F.col("id").alias("l")), "l").join(last.withColumnRenamed("id", "r"), "r").select(
            "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "id", "a"))
        found.append(level.select("lang", F.lit(k + 1).alias("n_words"), "phrase", "a"))
        if k + 1 < max_words:
            answers = counted.where("kind = 1").select("slice", "shard", "places", "ids")
            state = stored(state.groupBy("slice").cogroup(answers.groupBy("slice")).applyInPandas(_semi_join(k, shards), _STATE))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out, per_lang


def scored(phrases: DataFrame, scale: int = 1_000_000) -> DataFrame:
    """Lowest score over the cuts of each phrase of two words or more: ``lang, phrase, n_words, a, l, r, score``.

    The score is ``floor(scale * a * a / (l * r))`` in decimals, which hold its
    products exactly; ties go to the cut after the fewest words.
    """
    part = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    cuts = phrases.where("n_words > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn("tail", F.expr("substring_index(phrase, ' ', k - n_words)"))
    both = cuts.join(part.withColumnRenamed("part", "head").withColumnRenamed("f", "l"), ["lang", "head"]).join(
        part.withColumnRenamed("part", "tail").withColumnRenamed("f", "r"), ["lang", "tail"])
    wide = lambda c: f"CAST({c} AS DECIMAL(19,0))"
    both = both.withColumn("score", F.expr(f"CAST({scale} AS DECIMAL(7,0)) * {wide('a')} * {wide('a')} div ({wide('l')} * {wide('r')})"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return both.groupBy("lang", "phrase", "n_words", "a").agg(best).select("lang", "phrase", "n_words", "a", "best.l", "best.r", "best.score")


def without_contained(candidates: DataFrame, phrases: DataFrame, share: int) -> DataFrame:
    """Candidates that no longer phrase with ``share`` percent of their count or more contains."""
    inner = F.transform(F.sequence(F.lit(2), F.col("n_words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("n_words") - m + 1), lambda i: F.array_join(F.slice(F.split("phrase", " "), i, m), " ")))
    longer = phrases.where("n_words > 2").select("lang", F.explode(F.array_distinct(F.flatten(inner))).alias("phrase"), F.col("a").alias("around"))
    most = longer.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    return candidates.join(most, ["lang", "phrase"], "left").where(F.col("around").isNull() | (100 * F.col("around") < share * F.col("a"))).drop("around")


def mine_phrases(docs: DataFrame, max_words: int = 3, least: int = 10, share: int = 50, top: int = 2000, salts: int = 16) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, n_words, a, l, r, n, score``."""
    phrases, per_lang = frequent_phrases(docs, max_words, least)
    left = without_contained(scored(phrases), phrases, share)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = Window.partitionBy("lang", "salt").orderBy(*order)
    left = left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts))).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return left.join(per_lang, "lang").select("lang", "rank", "phrase", "n_words", "a", "l", "r", "n", "score")
