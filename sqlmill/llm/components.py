"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` (the smallest node it reaches) of every node in ``links`` (``a, b``).

    Alternates two contractions until nothing changes: every node passes its
    smallest neighbour to its larger neighbours, then to its smaller ones.  Both
    keep components, and the links become stars around the smallest nodes in a
    number of rounds that grows with the logarithm of the nodes.  Each round is
    two partial aggregates and joins on the node; hot nodes are split by AQE."""
    links = stored(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
                 .filter("a != b").distinct())
        after = stored(small, name)
        if after.exceptAll(links).isEmpty() and links.exceptAll(after).isEmpty():
            break
        links = after
    found = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return found.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
