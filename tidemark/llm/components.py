"""Connected components of links, by alternating star operations on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.store import settle


def _nearest(edges: DataFrame) -> DataFrame:
    """(u, v, m): every edge with the least node of u's neighbourhood, u included. Minima combine before the shuffle."""
    least = edges.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    joined = edges.join(least, F.col("u") == F.col("k"))
    return joined.select("u", "v", F.least("m", "u").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node are tied to the least node of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _nearest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Neighbours below a node, and the node, are tied to the least of them."""
    near = _nearest(edges)
    tied = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(near.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the least node it is connected to.

    Each round writes the links, so a lost executor repeats one round at most. The number of rounds grows with the
    logarithm of the longest chain. Nulls and loops are left out; an empty table has no nodes.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, seen = settle(ordered, "links"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            break
        seen = now
        edges = settle(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def joined_components(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, root) after more links (a, b): only the roots that these join are worked on."""
    def lifted(df: DataFrame, c: str) -> DataFrame:
        of = roots.select(F.col("node").alias("n"), F.col("root").alias("r"))
        return df.join(of, F.col(c) == F.col("n"), "left").withColumn(c, F.coalesce("r", c)).drop("n", "r")

    above = settle(components(lifted(lifted(links, "a"), "b")), "roots")
    single = above.join(roots, "node", "left_anti").select("node", F.col("node").alias("root"))
    top = above.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return roots.union(single).join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
