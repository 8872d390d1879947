"""Connected components of a link table, by rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of the links
    ``a``, ``b`` (longs). Links may repeat, loop, and stand in either order.

    Every round hangs each node's larger neighbours, and then its smaller ones, on the smallest
    of them. Minima are aggregated before they are shuffled and a node of many links meets its
    minimum in a join that can be split, so no neighbourhood is ever gathered. The number of
    rounds grows with the logarithm of the longest path.
    """

    def tidy(edges: DataFrame) -> DataFrame:
        high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        return edges.where("a <> b").select(high, low).distinct()

    def digest(edges: DataFrame) -> tuple:
        wide = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(edges.agg(F.count("*"), F.sum(wide)).first())

    edges = materialise(tidy(links.select("a", "b")))
    before = digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = tidy(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(tidy(small.unionByName(least.withColumnRenamed("m", "b"))))
        after = digest(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    tops = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.unionByName(tops)
