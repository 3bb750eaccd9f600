"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsubo.sources.staging import stage

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``): the smallest node of its component.

    Alternates two kinds of round, after Kiveris et al.: every node points its
    larger neighbours, then its smaller ones, at the smallest of its
    neighbourhood.  Trees flatten in a logarithmic number of rounds, and no
    round makes more rows than there are links.  A node's neighbourhood is only
    aggregated, never gathered.  Each round is written to the shared folder.
    """
    edges = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "links")
    before = None
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
        large = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()
        lows = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(lows, "a").select(F.when(F.col("b") == F.col("root"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("root").alias("b"))
        edges = stage(small.filter(F.col("a") != F.col("b")).distinct(), "links")
        state = tuple(edges.agg(F.count(F.lit(1)), F.countDistinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or state[0] == 0:
            # every node but the roots has one edge, to its root
            nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
    raise RuntimeError(f"components not settled after {MOST_ROUNDS} rounds")
