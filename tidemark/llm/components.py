"""Connected components of a table of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the least node of its component.

    A round points the neighbours of each node that are greater than it to the least of them all, then
    the same the other way round. Groups are reduced by minima and joins, never gathered, so a node with
    very many links is no problem. Rounds end when a round changes nothing, after about the logarithm of
    the longest path. Each round is written, which cuts the lineage.
    """
    edges = written(_ordered(links.select("a", "b")), "links")
    before = None
    while (now := _print(edges)) != before:
        before = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = _ordered(both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b"))
        down = large.groupBy("b").agg(F.min("a").alias("least"))
        small = large.join(down, "b").select(F.col("least").alias("a"), F.explode(F.array("a", "b")).alias("b"))
        edges = written(_ordered(small), "links")
    nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return nodes.union(edges.select("a", "a").distinct())


def _ordered(links: DataFrame) -> DataFrame:
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
