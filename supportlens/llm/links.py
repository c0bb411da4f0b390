"""Connected components of links between long ids, by alternating large and small stars.

Each round is joins and minimum aggregates, so that a node with very many links is split like any skewed key, and no component
meets in one place. Rounds are written to the shared folder; their number grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to its smallest neighbour, itself included."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them. `edges` run from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    near = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """node, root (the component's smallest node) of every node in `links` (a, b), of any order and with repeats."""
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    edges, before = stored(edges, "links"), None
    while True:
        sums = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if sums == before or not sums["n"]:
            break
        before = sums
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "links")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
