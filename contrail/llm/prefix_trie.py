"""Prefix trie of conversations, built by peeling their last turns.

Conversations may share their first turns.  Each is reduced to a chain of
digests, one per turn, that stand for the whole prefix up to it, and equal
conversations become one row.  The rounds descend from the greatest depth: the
nodes that survived from below lose their last turns and are grouped with the
conversations that end here, by their chains, so a round discovers the nodes of
its depth and adds up what their subtrees brought along, in one grouping with a
map-side part.  Turns that no two of them share are stripped in one round.  A
node never holds its members; their ids are hashed as a sorted stream.

Defined results: rows go by turn, a null turn first, then by role and text.  A
null role or text is empty.  Rows with a null conversation id form one
conversation, which shares no turns of another and whose id is larger than any
other for the smallest member and an empty text among the ids.  Repeated rows
are repeated turns.  An empty table has no conversation and no node, not even a
root.  Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.store import stored
from contrail.session import ensure_checkpoint_dir

DIGEST = 16
CHUNK = 1 << 16


def _turn_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns of whole conversations to one row each: turn digests and word counts."""
    conv, begun, digests, words = None, False, bytearray(), []

    def out() -> pa.RecordBatch:
        counts = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([bytes(digests)], pa.binary()), counts], ["conv_id", "digests", "words"])

    for batch in batches:
        for c, role, text, n in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text", "n"))):
            if begun and c != conv:
                yield out()
                digests, words = bytearray(), []
            conv, begun = c, True
            role = role.encode()
            digests += hashlib.blake2b(len(role).to_bytes(8, "big") + role + text.encode(), digest_size=DIGEST).digest()
            words.append(n)
    if begun:
        yield out()


def turn_sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, digests, words``: every conversation as the digests and word counts of its turns in order."""
    empty = F.lit("")
    rows = turns.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long"))
    rows = rows.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")
    return rows.mapInArrow(_turn_rows, "conv_id long, digests binary, words array<long>")


def share_first_turns(sequences: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with its first ``h`` turns taken from the first one of its family.

    ``h`` is the unsigned crc32 of the decimal id modulo ``most``; the family's
    first conversation has the id ``c - c % family``.
    """
    sequences = stored(sequences)
    base = sequences.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.substring("digests", 1, (most - 1) * DIGEST).alias("lead"), F.slice("words", 1, most - 1).alias("lead_words"))
    rows = sequences.withColumn("h", F.coalesce(F.crc32(F.col("conv_id").cast("string")) % most, F.lit(0)).cast("int"))
    rows = rows.join(base, F.col("conv_id") - F.col("conv_id") % family == F.col("base"), "left")
    nothing = F.array().cast("array<long>")
    lead = F.expr(f"coalesce(substring(lead, 1, h * {DIGEST}), X'')")
    own = F.expr(f"substring(digests, 1 + h * {DIGEST})")
    words = F.concat(F.expr("coalesce(slice(lead_words, 1, h), CAST(array() AS array<bigint>))"), F.expr("slice(words, 1 + h, size(words))"))
    return rows.select("conv_id", F.concat(lead, own).alias("digests"), F.coalesce(words, nothing).alias("words"))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chains, depth = [], []
        for digests in batch.column("digests").to_pylist():
            chain, last = bytearray(), b""
            for i in range(0, len(digests), DIGEST):
                last = hashlib.blake2b(last + digests[i: i + DIGEST], digest_size=DIGEST).digest()
                chain += last
            chains.append(bytes(chain))
            depth.append(len(digests) // DIGEST)
        sums = [[0, *accumulate(w)] for w in batch.column("words").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(depth, pa.int64()), pa.array(chains, pa.binary()), pa.array(sums, pa.list_(pa.int64()))], ["conv_id", "depth", "chain", "sums"])


def prefix_chains(sequences: DataFrame) -> DataFrame:
    """``conv_id, depth, chain, sums``: a digest and a running number of words per prefix instead of per turn."""
    return sequences.mapInArrow(_chain, "conv_id long, depth long, chain binary, sums array<long>")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of one node in one partition to texts of about ``CHUNK`` bytes."""
    held: list[str] = []
    node, first, place, size, begun, n = None, None, 0, 0, False, 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([first], pa.int64()), pa.array([n], pa.int64()), pa.array([",".join(held)])], ["node", "first", "n", "ids"])

    for batch in batches:
        for key, c in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if begun and (key != node or size >= CHUNK):
                yield out()
                n = n + 1 if key == node else 0
                held, size = [], 0
            if not held:
                first = c
            node, begun = key, True
            held.append("" if c is None else str(c))
            size += len(held[-1]) + 1
    if begun:
        yield out()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, digest, begun = None, None, False
    for batch in batches:
        nodes, sums = [], []
        for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if begun and key == node:
                digest.update(b"," + ids.encode())
                continue
            if begun:
                nodes.append(node), sums.append(digest.hexdigest())
            node, digest, begun = key, hashlib.sha256(ids.encode()), True
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sums, pa.string())], ["node", "ends_sha256"])
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])


def hashed_ends(chains: DataFrame) -> DataFrame:
    """``node, ends_sha256``: hash of the ascending ids of the conversations that end at a node.

    The ids are dealt out by ranges, so those of a common conversation lie in
    several partitions and become texts there; one task then hashes a node's
    texts as a stream.
    """
    ids = chains.select(_last(F.col("chain")).alias("node"), "conv_id")
    order = [F.asc("node"), F.asc_nulls_first("conv_id")]
    parts = ids.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_chunks, "node binary, first long, n long, ids string")
    return parts.repartition("node").sortWithinPartitions(F.asc("node"), F.asc_nulls_first("first"), "n").mapInArrow(_hashed, "node binary, ends_sha256 string")


def _last(chain, back: int = 0):
    """Digest of the prefix that ends ``back`` turns before the chain's end; empty for the root."""
    size = F.octet_length(chain)
    return F.substring(chain, F.greatest(size - (back + 1) * DIGEST + 1, F.lit(1)), F.when(size >= (back + 1) * DIGEST, DIGEST).otherwise(0))


def _cut(chain, depth):
    return F.substring(chain, F.lit(1), F.lit(depth) * DIGEST) if isinstance(depth, int) else F.substring(chain, F.lit(1), depth * DIGEST)


def _path(rows: DataFrame, low: int) -> DataFrame:
    """The nodes of each row's path at the depths above ``low``; no other row passes through them."""
    rows = rows.withColumn("t", F.explode(F.sequence(F.lit(low + 1).cast("long"), F.col("depth"))))
    top = F.col("t") == F.col("depth")
    since = F.element_at("sums", (F.col("depth") + 1).cast("int")) - F.when(F.col("t") > 0, F.expr("sums[int(t - 1)]")).otherwise(0)
    return rows.select(F.col("t").alias("depth"), _last(_cut(F.col("chain"), F.col("t"))).alias("node"), _last(_cut(F.col("chain"), F.col("t")), 1).alias("parent"), "conv_id", "n_convs",
                       F.when(top, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), F.greatest("below", F.lit(1)).cast("long").alias("n_leaves"),
                       (F.col("saved") + (F.col("n_convs") - 1) * since).cast("long").alias("saved_tokens"))


def _meeting_depth(rows: DataFrame, high: int) -> int:
    """The greatest depth, ``high`` at most, at which two rows have one prefix; -1 for a single row."""
    def meet(k: int) -> bool:
        prefixes = rows.where(F.col("depth") >= k).groupBy(_cut(F.col("chain"), k).alias("p")).agg(F.count("*").alias("n"))
        return (prefixes.agg(F.max("n")).first()[0] or 0) > 1

    if high < 0 or not meet(0):
        return -1
    if meet(high):
        return high
    low = 0  # rows that meet at a depth meet at all smaller ones
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if meet(middle) else (low, middle)
    return low


def peeled(ended: DataFrame) -> DataFrame | None:
    """All nodes with the totals of their subtrees, from the deepest to the root.

    ``ended`` has a row per different conversation.  A round strips the turns
    that no two nodes share, down to the next depth where some meet, and groups
    there; a run of unshared turns is one round, however long it is.  Returns
    ``depth, node, parent, conv_id, n_convs, n_children, n_leaves, saved_tokens``.
    """
    spark = ended.sparkSession
    deepest = ended.agg(F.max("depth")).first()[0]
    if deepest is None:
        return None
    folder = f"{ensure_checkpoint_dir(spark)}/trie-{uuid.uuid4().hex}"
    count = lambda c: F.sum(c).cast("long").alias(c)
    survivors, above, low, paths = None, deepest + 1, deepest + 1, []
    while low >= 0:
        here = ended.where(F.col("depth") < above)
        if survivors is not None:
            here = here.unionByName(survivors)
        low = _meeting_depth(here, min(above - 1, deepest))
        deeper = here.where(F.col("depth") > low)
        nodes = _path(deeper, low)
        paths.append(f"{folder}/{len(paths)}")
        nodes.write.parquet(paths[-1])
        if low < 0:
            break
        since = F.element_at("sums", (F.col("depth") + 1).cast("int")) - F.expr(f"sums[{low}]")
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        cut = deeper.select(_cut(F.col("chain"), low).alias("chain"), F.expr(f"slice(sums, 1, {low + 1})").alias("sums"), "conv_id", "n_convs", one.alias("n_children"),
                            F.greatest("below", one).alias("below"), (F.col("saved") + (F.col("n_convs") - 1) * since).alias("saved"))
        stay = here.where(F.col("depth") == low).select("chain", "sums", "conv_id", "n_convs", "n_children", "below", "saved")
        survivors = stored(stay.unionByName(cut).groupBy("chain", "sums").agg(F.min("conv_id").alias("conv_id"), *map(count, ("n_convs", "n_children", "below", "saved"))).withColumn(
            "depth", F.lit(low).cast("long")))
        above = low
    return spark.read.schema(nodes.schema).parquet(*paths)


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """The trie of turn sequences (``conv_id, digests, words``), a row per node."""
    chains = stored(prefix_chains(sequences))
    none = F.lit(0).cast("long")
    ended = chains.groupBy("chain", "sums", "depth").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    nodes = peeled(stored(ended.select("*", none.alias("n_children"), none.alias("below"), none.alias("saved"))))
    if nodes is None:
        return sequences.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    parents = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = hashed_ends(chains)
    out = nodes.join(parents, ["depth", "parent"], "left").join(ends, "node", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
