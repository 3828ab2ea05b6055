"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.staging import stage


def _stars(links: DataFrame) -> DataFrame:
    """One round. Links are ``a > b``; hubs cost a minimum (combined before the shuffle) and a join."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = stage(large.distinct(), "large-stars")
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return stage(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "small-stars")


def connected_components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, component``: each linked node and the smallest node it can reach.

    ``links`` holds whole numbers; loops and NULL ends are left out. Every round
    is written out; the rounds needed grow with the logarithm of the size at most.
    """
    both = F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right))
    ends = links.filter(both).select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
    current, seen = stage(ends.distinct(), "links"), None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen, current = mark, _stars(current)
    roots = current.select("b").distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("component"))
    )
