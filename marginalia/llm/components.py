"""Connected components of a graph given by its links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.sources.paths import stored


def _least(pairs: DataFrame, name: str) -> DataFrame:
    """Least ``b`` of each ``a``; stored, so that the join with it can split a frequent ``a``."""
    return stored(pairs.groupBy("a").agg(F.min("b").alias("least")), name)


def _large_star(links: DataFrame) -> DataFrame:
    """Every greater neighbour of a node now points at the node's least neighbour."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both, "large-star").withColumn("least", F.least("a", "least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and all it points at now point at the least of these."""
    joined = links.join(_least(links, "small-star"), "a")
    down = joined.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return joined.select("a", F.col("least").alias("b")).union(down).distinct()


def _state(links: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def components(links: DataFrame) -> DataFrame:
    """``a``, ``b`` to node, root: the least node of the component, for nodes that have links.

    Each round halves the depth of the trees at least; the driver sees a count and a sum.
    """
    current = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = _state(current)
    while before[0]:
        current = stored(_small_star(stored(_large_star(current), "stars")), "links")
        now = _state(current)
        if now == before:
            break
        before = now
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.union(leaves.select(F.col("root").alias("node"), "root").distinct())
