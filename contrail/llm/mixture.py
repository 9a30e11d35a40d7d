"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key ``-ln(u) / w`` from a hash of its id
and its quality weight ``w``; sorted by key within its source, the first
documents whose sizes fill a budget are a weighted sample without
replacement.  A source whose target exceeds its size is taken whole as often
as it fits (complete epochs) before the rest is sampled.  A document that is
longer than what is left of a budget is passed over, and those behind it that
still fit follow in the order of their keys (``fills`` times), so a source
comes near its target however long some documents are.

The order within a source is cut into buckets of the key's logarithm, about
evenly filled whatever the weights, so prefix sums run per (source, bucket)
plus once over the bucket totals; no task holds a whole source.

Defined results: a null text has size 0; a null id draws the key of the empty
string; null sources form a source of their own, the last in order.  Equal
keys go by id, then size.  An empty table gives an empty mixture.  A source
of size 0 has target 0.  Only ``doc_id, source, text`` of the input are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from contrail.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, least: float = 0.05) -> Column:
    """One minus four times the share of markup symbols, at least ``least``."""
    symbols, chars = F.regexp_count(text, F.lit(SYMBOLS)), F.length(text)
    return F.coalesce(F.when(chars > 0, F.greatest(F.lit(least), 1 - 4 * symbols / chars)), F.lit(1.0))


def uniform(key: Column, seed: str) -> Column:
    """A fixed number in (0, 1) of each key, from 52 bits of its MD5 digest."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":" + seed)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Target of each source: shares by weight, stopped at ``most`` sizes, the excess reshared.

    Ordered by the ratio of cap to weight, the sources that stop at their cap
    are a prefix; one ordered pass over the table of sources finds it.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(x) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = W.orderBy("ratio", F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("level", left / weights_left).withColumn("capped", F.col("level") > F.col("ratio"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    return s.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double"))
                    .otherwise(F.coalesce(level, F.lit(0.0)) * F.col("weight")).alias("target"))


def _taken(rows: DataFrame, gaps: DataFrame) -> DataFrame:
    """``rows`` (name, bucket, key, doc_id, size, done) with those done that fit, in key order, into the gap of their source.

    Rows that are done or longer than the gap are passed over; of the others the
    first are taken whose sizes fill it, by prefix sums per (source, bucket) and
    over the bucket totals.
    """
    rows = rows.join(gaps, "name")
    open_ = ~F.col("done") & (F.col("size") <= F.col("gap"))
    rows = rows.withColumn("counts", F.when(open_, F.col("size")).otherwise(0))
    totals = rows.groupBy("name", "bucket").agg(F.sum("counts").alias("words"))
    ahead = W.partitionBy("name").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select("name", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    upto = W.partitionBy("name", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.join(totals, ["name", "bucket"]).withColumn("filled", F.col("ahead") + F.sum("counts").over(upto))
    return rows.withColumn("done", F.col("done") | (open_ & (F.col("filled") <= F.col("gap")))).drop("gap", "counts", "ahead", "filled")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix",
                quality: Column | None = None, rows_per_step: int = 100_000, fills: int = 3) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row.

    ``taken`` counts the words of the row in the mixture, repeats included.  A
    source takes its target at most; what is missing is less than the shortest
    documents passed over.
    """
    text = F.col("text")
    sized = cut_lineage(docs.select(
        "doc_id", "source", word_count(text).alias("size"),
        (-F.log(uniform(F.col("doc_id"), seed)) / (quality_weight(text) if quality is None else quality)).alias("key")))
    steps = max(64, sized.count() // rows_per_step)  # buckets of an octave of the key; more rows, finer buckets
    name = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("name")
    rows = sized.select("*", name, F.floor(F.log2("key") * steps).alias("bucket"), F.lit(False).alias("done"))
    sizes = cut_lineage(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    targets = source_targets(sizes, weights, most)
    epochs = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size")))).otherwise(0)
    targets = cut_lineage(targets.withColumn("epochs", epochs).select(name, "source_size", "target", "epochs", (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest")))
    gaps = targets.select("name", F.col("rest").alias("gap"))
    for _ in range(1 + fills):
        rows = cut_lineage(_taken(rows, gaps))
        used = rows.where("done").groupBy("name").agg(F.sum("size").alias("used"))
        gaps = targets.join(used, "name", "left").select("name", (F.col("rest") - F.coalesce("used", F.lit(0))).alias("gap"))
    rows = rows.join(targets, "name")
    part = F.when(F.col("done"), F.col("size")).otherwise(0)
    return rows.select("doc_id", "source", "size", "source_size", "target",
                       (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"))
