"""Connected components of a graph given by its edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import written

MOST_ROUNDS = 50


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b); the root is the smallest node of its component.

    Each half round is one aggregate (a minimum, so it combines in the map tasks) and one join; the number of
    edges never grows, and no node's neighbours are gathered. Rounds go to the shared folder. Self-loops and nulls
    are left out.
    """
    now = written(edges.where("a <> b").select("a", "b").distinct(), "components")
    before = None
    for turn in range(MOST_ROUNDS):
        # Every neighbour above a node is tied to the least node around it.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Then a node and its neighbours below are tied to the least of those.
        down = written(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b"), f"components-{turn}")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), f"components-{turn}-small")
        seen = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == before:
            break
        before = seen
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
