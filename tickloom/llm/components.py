"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hot import hot_limit, join_split
from .scratch import Scratch


def _towards(neighbours: DataFrame, limit: int) -> DataFrame:
    """a, b and m: the smallest of a and its neighbours.

    The count of a hot node is combined before its shuffle, and its least is
    broadcast, so that the centre of a large star is not one task's.  Where no
    node is hot nothing is broadcast: each broadcast holds a page on the driver.
    neighbours is read twice: give a table.
    """
    least = neighbours.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"), F.count(F.lit(1)).alias("degree"))
    if least.where(F.col("degree") > limit).isEmpty():
        return neighbours.join(least.drop("degree"), "a")
    return join_split(neighbours, least, ["a"], "degree", limit).drop("degree")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every a has one b, and no b is an a: then every b is the root of its component."""
    if not edges.groupBy("a").count().where("count > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """node and root, the smallest node that it reaches, of every node with an edge.

    edges has a and b of one type that has an order.  Alternates large-star and small-star steps
    (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014)
    until every node hangs on its root; each round is a table of at most as
    many edges as before.
    """
    now = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{label}0")
    limit = hot_limit(2 * now.count())
    n = 0
    while not _are_stars(now):
        n += 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _towards(both, limit).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.save(large, f"{label}{n}-large")
        stars = _towards(large, limit)
        small = stars.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(stars.select("a", F.col("m").alias("b")))
        now = scratch.save(small.where("a <> b").distinct(), f"{label}{n}")
        scratch.drop(f"{label}{n}-large", *[f"{label}{n - 2}"] * (n > 1))
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
