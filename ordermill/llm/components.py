"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.session import discard, materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with a link; the root is the smallest node reachable, and has a row too.

    Links may repeat and point either way. Each round is written to the shared folder; neighbours are only ever
    reduced to their least, so a node with any number of links is no group in a task.
    """
    state = materialise(links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "links")
    mark = None
    while True:
        starred = materialise(_small_star(_large_star(state)).distinct(), "links")
        now = starred.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(state)
        state = starred
        if now == mark:
            break
        mark = now
    nodes = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
