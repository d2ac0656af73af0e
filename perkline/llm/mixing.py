"""Mixing sources to target weights by a low-discrepancy slot schedule.

Sizes, targets and blocks:

* a source's target is its weight's share of all words, but at most
  ``max_passes`` times its own size; the excess is reshared by weight until
  none is above (closed form: sources sorted by size per weight);
* each source's documents stand in a shuffled order (a hash of id and text)
  and its words are cut into equal blocks, ``block_words`` each or smaller,
  at least ``min_blocks`` of them where it has that many words.

Slots: point ``k * golden ratio mod 1`` falls in one source's stretch of the
cumulative slot shares, so every stretch of the schedule has the right mix.
Slots are ranked per source; slot ``r`` takes block ``r mod blocks``.  A
document takes its words in each block as often as the block is taken.

Nothing is ordered in one task: ranks and word offsets are sums over ranges
(of slots, of hash buckets) plus a place within the range.  A slot finds its
source by order, without a join: points and the begins of stretches lie
together in ranges of the axis, each opened by the stretch that reaches into
it, and a point takes the last stretch begun before it.  Only the sources'
table (a row each) is windowed as a whole.

Defined cases: a NULL text has size 0 and takes nothing; a NULL source is a
source of its own, last in order; repeated rows are documents of their own;
an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline.llm.common import WHITE, stored

WEIGHTS = (5.0, 2.0, 1.0)
MAX_PASSES = 3
BLOCK_WORDS = 1024
MIN_BLOCKS = 256
RANGE_SLOTS = 1 << 14
BUCKET_ROWS = 1 << 13
GOLDEN = (math.sqrt(5) - 1) / 2


def size_of(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; NULL has none."""
    flat = F.trim(F.translate(F.coalesce(text, F.lit("")), WHITE, " " * len(WHITE)))
    return F.when(flat == "", F.lit(0).cast("long")).otherwise(F.size(F.split(flat, " +")).cast("long"))


def targets(sized: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """``source, src (its place), docs, source_size, weight, target``."""
    sums = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), "src")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = max_passes * F.col("source_size")
    level = (F.col("total") - F.coalesce(F.sum(cap).over(before), F.lit(0))) / (
        F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    ranked = sums.withColumn("src", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int"))
    )
    # sources in order of size per weight: while one would pass its cap it is
    # capped, and the first that would not fixes the level of all the rest
    every = Window.partitionBy()
    levels = (
        ranked.withColumn("total", F.sum("source_size").over(every))
        .withColumn("weights", F.sum("weight").over(every))
        .withColumn("level", level)
        .withColumn("free", F.when(F.col("level") * F.col("weight") <= cap, F.col("level")))
        .withColumn("level", F.first("free", ignorenulls=True).over(whole))
    )
    target = F.least(F.col("level") * F.col("weight"), cap.cast("double"))
    return levels.select("source", "src", "docs", "source_size", "weight", target.alias("target"))


def blocks_of(sources: DataFrame, block_words: int = BLOCK_WORDS, min_blocks: int = MIN_BLOCKS) -> DataFrame:
    """``sources`` with ``blocks`` and its stretch ``lo``..``hi`` of the
    expected slots."""
    size = F.col("source_size")
    blocks = F.greatest(F.ceil(size / block_words), F.least(size, F.lit(min_blocks)))
    slots = F.when(size > 0, F.col("target") * F.col("blocks") / size).otherwise(0.0)
    so_far = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, 0)
    return (
        sources.withColumn("blocks", blocks.cast("long"))
        .withColumn("slots", slots)
        .withColumn("hi", F.sum("slots").over(so_far))
        .withColumn("lo", F.col("hi") - F.col("slots"))
    )


def schedule(sources: DataFrame, n_slots: int, max_passes: int = MAX_PASSES) -> DataFrame:
    """``slot, src, rank, block``: which block each slot takes.

    Slots of a source beyond ``max_passes`` of all its blocks stay idle.
    """
    spark = sources.sparkSession
    point = F.pmod(F.col("id") * F.lit(GOLDEN), F.lit(1.0)) * n_slots
    slot = spark.range(n_slots).withColumn("at", point).withColumn("range", F.floor(F.col("id") / RANGE_SLOTS))
    stretch = sources.where("slots > 0").select("lo", F.struct("src", "blocks", "hi").alias("of"))
    begun = stretch.select(F.col("lo").alias("at"), F.floor(F.col("lo") / RANGE_SLOTS).alias("part"), "of")
    # the ranges that a stretch reaches into, after the one where it begins
    parts = F.sequence(F.floor(F.col("lo") / RANGE_SLOTS) + 1, F.ceil(F.col("of.hi") / RANGE_SLOTS) - 1)
    reaches = F.ceil(F.col("of.hi") / RANGE_SLOTS) - 1 > F.floor(F.col("lo") / RANGE_SLOTS)
    opened = stretch.where(reaches).select(F.explode(parts).alias("part"), "of")
    opened = opened.select((F.col("part") * F.lit(float(RANGE_SLOTS))).alias("at"), "part", "of")
    points = slot.select("id", "range", "at", F.floor(F.col("at") / RANGE_SLOTS).alias("part"))
    axis = points.unionByName(begun.unionByName(opened), allowMissingColumns=True)
    # at one place stretches come before the point, in their own order
    along = Window.partitionBy("part").orderBy("at", F.col("id").asc_nulls_first(), "of.src")
    last = F.last("of", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))
    hit = (
        axis.withColumn("in", last)
        .where(F.col("id").isNotNull() & (F.col("at") < F.col("in.hi")))
        .select("id", "range", "in.src", "in.blocks")
    )
    per_range = hit.groupBy("src", "range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select("src", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("src", "range").orderBy("id")
    ranked = (
        hit.withColumn("place", F.row_number().over(within) - 1)
        .join(starts, ["src", "range"])
        .withColumn("rank", F.col("base") + F.col("place"))
    )
    return ranked.where(F.col("rank") < max_passes * F.col("blocks")).select(
        F.col("id").alias("slot"), "src", "rank", (F.col("rank") % F.col("blocks")).alias("block")
    )


def placed(sized: DataFrame, sources: DataFrame, n_docs: int) -> DataFrame:
    """``sized`` with ``src``, ``source_size``, ``target``, ``blocks`` and
    ``start``, the words of its source before it in shuffled order."""
    buckets = max(1, n_docs // BUCKET_ROWS)
    docs = sized.join(
        sources.select(F.col("source").alias("_s"), "src", "source_size", "target", "blocks"),
        sized["source"].eqNullSafe(F.col("_s")),
    ).drop("_s")
    docs = docs.withColumn("bucket", F.pmod(F.shiftright("order", 8), F.lit(buckets)))
    sums = docs.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("src", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = (
        Window.partitionBy("src", "bucket")
        .orderBy("order", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        docs.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(bases, ["src", "bucket"])
        .withColumn("start", F.col("base") + F.col("inside"))
        .drop("inside", "base", "bucket")
    )


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    max_passes: int = MAX_PASSES,
    block_words: int = BLOCK_WORDS,
    min_blocks: int = MIN_BLOCKS,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for each row of
    ``docs (doc_id, text, source)``."""
    sized = docs.select(
        "doc_id",
        "source",
        size_of(F.col("text")).alias("size"),
        F.xxhash64(F.col("doc_id"), F.col("text")).alias("order"),
    )
    sized = stored(sized, "mix-sizes")
    sources = stored(blocks_of(targets(sized, weights, max_passes), block_words, min_blocks), "mix-sources")
    total = sources.agg(F.sum("slots").alias("slots"), F.sum("docs").alias("docs")).first()
    n_slots, n_docs = math.ceil(total["slots"] or 0), total["docs"] or 0
    rows = stored(placed(sized, sources, n_docs), "mix-rows")
    # block b holds the words from ceil(b * size / blocks) on
    first = F.floor(F.col("start") * F.col("blocks") / F.col("source_size"))
    last = F.floor((F.col("start") + F.col("size") - 1) * F.col("blocks") / F.col("source_size"))
    pieces = rows.where("size > 0").select(
        "src", "start", "size", "blocks", "source_size", F.explode(F.sequence(first - 1, last + 1)).alias("block")
    )
    begin = F.ceil(F.col("block") * F.col("source_size") / F.col("blocks"))
    end = F.ceil((F.col("block") + 1) * F.col("source_size") / F.col("blocks"))
    words = F.least(end, F.col("start") + F.col("size")) - F.greatest(begin, F.col("start"))
    times = schedule(sources, n_slots, max_passes).groupBy("src", "block").agg(F.count("*").alias("times"))
    taken = (
        pieces.withColumn("words", words)
        .where("words > 0")  # and one block more on either side, should a quotient be rounded
        .join(times, ["src", "block"])
        .groupBy("src", "start")
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        .withColumnRenamed("src", "_src")
        .withColumnRenamed("start", "_start")
    )
    return rows.join(
        taken, (rows["src"] == taken["_src"]) & (rows["start"] == taken["_start"]) & (rows["size"] > 0), "left"
    ).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )
