"""Connected components of an edge table, by star contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkline.llm.common import stored, stored_counting


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star step, then one small-star step, on edges ``(a, b)``
    with ``a > b``.  Each is a map-side combined minimum per node, joined back
    to the edges, so a node with very many neighbours is never one group."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    large = (
        both.where("b > a")
        .join(least, F.col("a") == F.col("n"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.where("m < n").select(F.col("n").alias("a"), F.col("m").alias("b")))
        .distinct()
    )
    root = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
    small = (
        large.join(root, F.col("a") == F.col("n"))
        .where("b > m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(root.select(F.col("n").alias("a"), F.col("m").alias("b")))
    )
    return small.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of an edge ``(a, b)``; ``root`` is the
    smallest node of its component.  Each round is written to the shared
    folder, which also cuts the lineage and tells whether the round changed
    anything; the rounds grow with the logarithm of the longest path."""
    a, b = F.greatest("a", "b"), F.least("a", "b")
    marks = {
        "n": F.count(F.lit(1)),
        "s": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        "x": F.bit_xor(F.xxhash64("b", "a")),
    }
    first = edges.select(a.alias("a"), b.alias("b")).where("a > b").distinct()
    now, mark = stored_counting(first, "components", **marks)
    before = None
    while mark != before and mark.get("n"):
        before = mark
        now, mark = stored_counting(_stars(now), "components", **marks)
    leaves = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return leaves.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def forest_roots(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of a forest given as one edge ``(a, b)``
    from each node but the roots to its parent.  A round replaces a parent by
    its own parent: one join, and as many rounds as the logarithm of the
    depth."""
    now = stored(edges.select("a", "b"), "forest")
    while True:
        up = now.select(F.col("a").alias("n"), F.col("b").alias("up"))
        moved = now.join(up, F.col("b") == F.col("n"), "left").select("a", F.coalesce("up", "b").alias("b"), F.col("up").isNotNull().alias("m"))
        now, seen = stored_counting(moved, "forest", m=F.count_if("m"))
        now = now.select("a", "b")
        if not seen.get("m"):
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
