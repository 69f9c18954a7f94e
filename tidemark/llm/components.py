"""Connected components of a graph kept as a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    least = both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("m"))
    return both.join(least, "hi").where("lo > hi and lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = links.join(least, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link at most and none leads on."""
    nodes = links.select("hi", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(links.select(F.col("lo").alias("hi"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = nodes.groupBy("hi").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not seen.where("up > 1 or (up > 0 and down > 0)").take(1)


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) but the roots themselves.

    The root is the smallest node. Each round writes its links to the shared folder; the
    number of rounds grows with the logarithm of the longest chain.
    """
    now = stored(links.where("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), name)
    while not _settled(now):
        now = stored(_small_star(stored(_large_star(now), name)), name)
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
