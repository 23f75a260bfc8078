"""Connected components of a graph too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.lookup import ROUND_BYTES, measured_bytes
from tillroll.scratch import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): ``root`` is the smallest node of its component.

    Large-star and small-star steps in turn: each joins nodes to their smallest neighbour, so after a number of
    rounds that grows with the logarithm of the nodes only stars are left. Each step's minima are broadcast where
    the links, which are measured, are few; else they are a written table, so the rows of a node with very many
    neighbours can be split between tasks.
    """
    links = materialise(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _are_stars(links):
        few = 2 * measured_bytes(links) <= ROUND_BYTES
        links = _small_star(_large_star(links, few), few)
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _are_stars(links: DataFrame) -> bool:
    """Whether every node has one link and leads to a node without one."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = links.select(F.col("a").alias("node"), one.alias("out"), none.alias("in")).unionByName(
        links.select(F.col("b").alias("node"), none.alias("out"), one.alias("in")))
    counts = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return counts.filter((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("in") == 1))).isEmpty()


def _large_star(links: DataFrame, few: bool) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a"), F.least("a", "b").alias("least"))
    return _relinked(both, least, few).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame, few: bool) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    links = materialise(links)
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = _relinked(links, least, few).filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return materialise(moved.unionByName(own).distinct())


def _relinked(links: DataFrame, least: DataFrame, few: bool) -> DataFrame:
    return links.join(F.broadcast(least) if few else materialise(least).hint("merge"), "a")
