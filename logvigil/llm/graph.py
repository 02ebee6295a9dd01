"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logvigil.session import discard, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """For each node that has a link to another one: node, root (the smallest node reachable).

    Each round hangs every node's larger neighbours, then its smaller ones, on its smallest neighbour; the
    rounds grow with the logarithm of the longest chain. Neighbourhoods are only ever reduced to their
    minimum or joined with it, so a node with a third of all links is no group that one task has to
    hold. Each round is written to the shared folder. Repeated links and links to oneself change nothing; no
    links give no rows.
    """
    kind = dict(links.dtypes)[a]
    edges = written(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct())
    spent = []
    while not _are_stars(edges):
        spent.append(edges)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
    discard(*spent)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").cast(kind).alias("node"), F.col("b").cast(kind).alias("root")).unionByName(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one other at most, and none that others hang on does."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.lit(1).alias("up")), F.struct(F.col("b").alias("n"), F.lit(0).alias("up")))).alias("e"))
    ups = ends.select("e.*").groupBy("n").agg(F.sum("up").alias("up"), F.min("up").alias("low"))
    return ups.where("up > 1 OR (up = 1 AND low = 0)").isEmpty()
