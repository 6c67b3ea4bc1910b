"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltstream.llm.common import discard, settled


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every linked node; a component is its smallest node.

    Alternates two steps on links that point from the larger to the smaller node: hang
    larger neighbours on the smallest one, then smaller ones likewise, until all hang on
    a root. Each step is a minimum per node, aggregated before its shuffle, and a join
    whose large partitions Spark may split, so a node may have any number of links.
    Every step is written to the shared folder and replaces the one before. Links with a
    null end or to themselves are passed over.
    """
    edges = settled(
        links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
        .where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("a") > F.col("b")))
        .distinct(),
        "links",
    )
    while not _all_on_roots(edges):
        edges = _hang_smaller(_hang_larger(edges))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _all_on_roots(edges: DataFrame) -> bool:
    """Whether no node hangs on two others or on one that hangs itself."""
    parents = edges.groupBy("a").agg(F.count("*").alias("parents"))
    roots = edges.select(F.col("b").alias("a")).distinct()
    wrong = parents.join(roots, "a", "left_semi").limit(1).count() if parents.where("parents > 1").isEmpty() else 1
    return wrong == 0


def _hang_larger(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the node's smallest neighbour, or the node."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
    least = settled(least, "least")
    hung = settled(edges.join(least, "b").select("a", F.col("m").alias("b")).distinct(), "links")
    discard(edges, least)
    return hung


def _hang_smaller(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, go to its smallest neighbour."""
    least = settled(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    hung = settled(moved.unionByName(own).distinct(), "links")
    discard(edges, least)
    return hung
