"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import stored

MAX_STEPS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that can be reached over ``links`` (a, b), for every node with a link.

    Alternates the large-star and small-star steps, after each of which every node points at a smaller neighbour;
    their number grows with the logarithm of the longest path. A node with very many neighbours is never gathered:
    its smallest neighbour is a partial aggregate, joined back to its links. Every step is written down.
    """
    edges = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "links")
    before = None
    for _ in range(MAX_STEPS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: larger neighbours point at the smallest of the neighbourhood
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b")
        # small star: smaller neighbours, and the node, point at the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()
        edges = stored(small, "links")
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_STEPS} steps")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
