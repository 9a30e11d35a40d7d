"""Exact deduplication by an index of cuckoo filters over content digests.

The index holds every live row with its text and digest in the shared folder,
one cuckoo filter per shard of the digests, and the live digests the filters
stand for.  Documents are added in batches and removed again.  A batch is first
reduced to its distinct digests per partition; each shard looks these up in its
filter.  A miss is new and is inserted.  A hit is compared with the stored
digests of the shard, so a false hit is inserted too, and the texts of true
hits are compared whole: a digest whose texts differ is split by text.  A
filter that overflows is rebuilt with twice the buckets from its stored
digests.

Defined results: a null text is empty and equal to an empty one.  Of equal
texts the row with the largest id stays, a null id being smaller than any
other; of rows with the same text and id one stays.  Repeated rows are members
of a group like others.  An empty table gives an empty index.  Other columns of
the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.store import stored
from contrail.llm.words import mix

SLOTS = 4          # fingerprints a bucket holds
MAX_KICKS = 500    # moves before a filter counts as full
SHARD_ROWS = 250_000


class CuckooFilter:
    """Approximate set of 64-bit hashes with deletion; 16-bit fingerprints, two buckets each."""

    def __init__(self, buckets: int, slots: np.ndarray | None = None):
        self.buckets = buckets  # a power of two
        self.slots = np.zeros((buckets, SLOTS), dtype=np.uint16) if slots is None else slots

    @classmethod
    def for_items(cls, n: int) -> CuckooFilter:
        """A filter that ``n`` hashes fill to 84 % at most."""
        return cls(1 << max(int(np.ceil(np.log2(max(n, 1) / (0.84 * SLOTS)))), 2))

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        slots = np.frombuffer(blob, dtype=np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(slots), slots)

    def dump(self) -> bytes:
        return self.slots.tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = mix(np.asarray(hashes).astype(np.uint64))
        print_ = (h >> np.uint64(48)).astype(np.uint16)
        print_[print_ == 0] = 1  # 0 marks a free slot
        first = (h & np.uint64(self.buckets - 1)).astype(np.int64)
        return print_, first, self._other(first, print_)

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(print_.astype(np.uint64)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        p, a, b = self._places(hashes)
        return (self.slots[a] == p[:, None]).any(axis=1) | (self.slots[b] == p[:, None]).any(axis=1)

    def insert(self, hashes: np.ndarray) -> bool:
        """Adds all hashes; False if the filter is full, and then it must be rebuilt."""
        p, a, b = self._places(hashes)
        left = np.arange(len(p))
        for bucket in (a, b) * SLOTS:  # every bucket takes one of its hashes a turn
            if not len(left):
                return True
            target = bucket[left]
            free = (self.slots[target] == 0).any(axis=1)
            _, one = np.unique(target[free], return_index=True)
            placed = np.flatnonzero(free)[one]
            where = target[placed]
            self.slots[where, (self.slots[where] == 0).argmax(axis=1)] = p[left[placed]]
            left = np.delete(left, placed)
        return all(self._kick(int(p[i]), int(a[i])) for i in left)

    def _kick(self, print_: int, bucket: int) -> bool:
        """Places a fingerprint by moving others to their second bucket."""
        for turn in range(MAX_KICKS):
            free = np.flatnonzero(self.slots[bucket] == 0)
            if len(free):
                self.slots[bucket, free[0]] = print_
                return True
            slot = (print_ + turn) % SLOTS
            print_, self.slots[bucket, slot] = int(self.slots[bucket, slot]), print_
            bucket = int(self._other(np.array([bucket]), np.array([print_], np.uint16))[0])
        return False

    def delete(self, hashes: np.ndarray) -> None:
        """Removes one fingerprint of each hash, which must have been inserted."""
        for p, a, b in zip(*self._places(hashes)):
            for bucket in (a, b):
                found = np.flatnonzero(self.slots[bucket] == p)
                if len(found):
                    self.slots[bucket, found[0]] = 0
                    break
            else:
                raise KeyError("the hash is not in the filter")


def with_inserted(held: CuckooFilter, hashes: np.ndarray, stored_hashes) -> CuckooFilter:
    """The filter with ``hashes`` in it; on overflow one of twice the buckets, made from the stored hashes."""
    if held.insert(hashes):
        return held
    everything = np.concatenate([stored_hashes(), hashes])
    buckets = held.buckets
    while True:
        buckets *= 2
        held = CuckooFilter(buckets)
        if held.insert(everything):
            return held


@dataclass(frozen=True)
class Index:
    content: DataFrame        # part, row, doc_id, key, text: every live row
    live: DataFrame           # key, h: the live digests
    filters: DataFrame        # shard, slots
    repeated: DataFrame       # key: digests of more than one row
    collided: DataFrame       # key: those of them whose texts differ
    shards: int
    key_bytes: int
    batches: int


_PASS = "kind int, part long, key binary, h long, slots binary"
_SCHEMA = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("key", pa.binary()), ("h", pa.int64()), ("slots", pa.binary()), ("shard", pa.int32())])
FILTER, LIVE, ASK, HIT, GONE = range(5)


def _rows(shard: int, kind: int, **columns) -> pa.Table:
    n = len(next(iter(columns.values())))
    have = columns | {"kind": np.full(n, kind, np.int32), "shard": np.full(n, shard, np.int32)}
    return pa.table([pa.array(have[f.name], f.type) if f.name in have else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)


def _of_kind(rows: pa.Table, kind: int) -> pa.Table:
    return rows.filter(pc.equal(rows["kind"], kind))


def _insert_shard(rows: pa.Table) -> pa.Table:
    """Looks the digests of a batch up in a shard and inserts the new ones."""
    shard = rows["shard"][0].as_py()
    known, asks, old = _of_kind(rows, LIVE), _of_kind(rows, ASK).sort_by("part"), _of_kind(rows, FILTER)
    hashes = [known["h"].to_numpy()]
    if len(old):
        held = CuckooFilter.load(old["slots"][0].as_py())
    else:
        held = with_inserted(CuckooFilter.for_items(len(known)), hashes[0], lambda: hashes[0][:0])
    keys, part, h = asks["key"].to_pylist(), asks["part"].to_numpy(), asks["h"].to_numpy()
    live, new, hits = set(known["key"].to_pylist()), [], []
    ends = np.append(np.flatnonzero(np.diff(part)) + 1, len(part))
    start = 0
    for end in ends:  # the digests of one partition all differ
        seen = held.contains(h[start:end])
        fresh = []
        for i, maybe in zip(range(start, end), seen):
            if maybe and keys[i] in live:
                hits.append(i)
            else:  # a miss, or a false hit
                fresh.append(i)
        live.update(keys[i] for i in fresh)
        held = with_inserted(held, h[fresh], lambda: np.concatenate(hashes))
        hashes.append(h[fresh])
        new += fresh
        start = end
    return pa.concat_tables([_rows(shard, FILTER, slots=[held.dump()]), _rows(shard, LIVE, key=[keys[i] for i in new], h=h[new]),
                             _rows(shard, HIT, part=part[hits], key=[keys[i] for i in hits])])


def _delete_shard(rows: pa.Table) -> pa.Table:
    """Takes digests without a live row out of a shard's filter."""
    shard = rows["shard"][0].as_py()
    old = _of_kind(rows, FILTER)
    if not len(old):
        return _SCHEMA.empty_table()
    held = CuckooFilter.load(old["slots"][0].as_py())
    held.delete(_of_kind(rows, GONE)["h"].to_numpy())
    return _rows(shard, FILTER, slots=[held.dump()])


def _shaped(df: DataFrame, kind: int, shards: int) -> DataFrame:
    """``df`` with the columns of a pass over the shards."""
    have = [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in _PASS.split(", ")[1:])]
    shard = F.col("shard") if "shard" in df.columns else F.pmod(F.crc32("key"), F.lit(shards)).cast("int").alias("shard")
    return df.select(F.lit(kind).alias("kind"), *have, shard)


def empty_index(spark, key_bytes: int = 32) -> Index:
    none = lambda s: spark.createDataFrame([], s)
    keys = none("key binary")
    return Index(none("part long, row long, doc_id long, key binary, text string"), none("key binary, h long"), none("shard int, slots binary"), keys, keys, 1, key_bytes, 0)


def add_documents(index: Index, docs: DataFrame, shard_rows: int = SHARD_ROWS) -> Index:
    """The index with all rows of ``docs`` (``doc_id``, ``text``) in it."""
    text = F.coalesce("text", F.lit(""))
    part = F.spark_partition_id().cast("long") + F.lit(index.batches << 32)
    batch = stored(docs.select(part.alias("part"), F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "key", F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, index.key_bytes)).select("part", "row", "doc_id", "key", "text"))
    asks = stored(batch.groupBy("part", "key").agg(F.count("*").alias("n")).withColumn("h", F.xxhash64("key")))
    held = index.live.count() + asks.count()
    shards = index.shards
    if held > shards * shard_rows or not index.batches:
        shards = max(-(-held // shard_rows), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = _shaped(index.live, LIVE, shards).unionByName(_shaped(asks, ASK, shards))
    if shards == index.shards:  # otherwise the shards' filters are made from the live digests
        rows = rows.unionByName(_shaped(index.filters, FILTER, shards))
    seen = stored(rows.groupBy("shard").applyInArrow(_insert_shard, f"{_PASS}, shard int"))
    content = batch if not index.batches else index.content.unionByName(batch)
    live = seen.where(F.col("kind") == LIVE).select("key", "h")
    live = live if not index.batches else index.live.unionByName(live)
    filters = seen.where(F.col("kind") == FILTER).select("shard", "slots")
    hit = stored(seen.where(F.col("kind") == HIT).select("key").unionByName(asks.where("n > 1").select("key")).distinct())
    collided = _differing(content, hit)
    if index.batches:
        hit, collided = stored(index.repeated.unionByName(hit).distinct()), stored(index.collided.unionByName(collided).distinct())
    return replace(index, content=content, live=live, filters=filters, repeated=hit, collided=collided, shards=shards, batches=index.batches + 1)


def _involved(content: DataFrame, keys: DataFrame) -> DataFrame:
    """The (part, key) pairs of ``keys``; a key of many rows has one per partition."""
    return content.groupBy("part", "key").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "part", "row")).alias("last")).join(keys, "key")


def _differing(content: DataFrame, keys: DataFrame) -> DataFrame:
    """Digests among ``keys`` whose rows do not all hold the same text."""
    pairs = _involved(content.select("part", "key", "doc_id", "row"), keys).select(F.col("part").alias("p"), F.col("key").alias("k"))
    texts = content.join(pairs, (F.col("part") == F.col("p")) & (F.col("key") == F.col("k")), "left_semi")
    return stored(texts.groupBy("key").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b").select("key"))


def remove_documents(index: Index, ids: DataFrame) -> Index:
    """The index without the rows whose ``doc_id`` is in ``ids``; digests left without a row leave the filters."""
    ids = stored(ids.select(F.col("doc_id").cast("long").alias("gone_id")).where("gone_id IS NOT NULL").distinct())
    mine = F.col("doc_id") == F.col("gone_id")
    touched = index.content.join(ids, mine, "left_semi").select("key").distinct()
    content = index.content.join(ids, mine, "left_anti")
    left = content.select("key").join(touched, "key", "left_semi").groupBy("key").count()
    gone = stored(index.live.join(touched, "key", "left_semi").join(left.select("key"), "key", "left_anti"))
    single = left.where("count = 1").select("key").unionByName(gone.select("key"))
    rows = _shaped(index.filters, FILTER, index.shards).unionByName(_shaped(gone, GONE, index.shards))
    filters = stored(rows.groupBy("shard").applyInArrow(_delete_shard, f"{_PASS}, shard int")).select("shard", "slots")
    live = stored(index.live.join(gone.select("key"), "key", "left_anti"))
    repeated = stored(index.repeated.join(single, "key", "left_anti"))
    collided = _differing(content, stored(index.collided.join(repeated, "key", "left_semi")))
    return replace(index, content=content, live=live, filters=filters, repeated=repeated, collided=collided)


def resolved(index: Index) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, key`` of every live row."""
    rows = index.content.select("part", "row", "doc_id", "key")
    whole = index.repeated.join(index.collided, "key", "left_anti")
    pairs = stored(_involved(rows, whole))
    groups = pairs.groupBy("key").agg(F.sum("n").alias("group_size"), F.max("last").alias("last"))
    # A digest of many rows has one answer per partition, so no key gathers them.
    answers = pairs.select("part", "key").join(groups, "key")
    out = _kept(rows.join(index.collided, "key", "left_anti").join(answers, ["part", "key"], "left"))
    if index.collided.isEmpty():
        return out
    texts = index.content.join(index.collided, "key", "left_semi")
    split = texts.groupBy("key", "text").agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "part", "row")).alias("last"))
    return out.unionByName(_kept(texts.join(split, ["key", "text"])))


def _kept(rows: DataFrame) -> DataFrame:
    alone = F.col("group_size").isNull()
    itself = (F.col("last.part") == F.col("part")) & (F.col("last.row") == F.col("row"))
    return rows.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
                       F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), (alone | itself).alias("kept"), "key")


def exact_duplicates(docs: DataFrame, key_bytes: int = 32) -> DataFrame:
    """Groups of equal texts of a whole table, by an index made for it."""
    return resolved(add_documents(empty_index(docs.sparkSession, key_bytes), docs))
