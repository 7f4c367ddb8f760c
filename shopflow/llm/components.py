"""Connected components of an edge list, by alternating large and small stars.

Each round rewires every node to the smallest node it knows of (first its larger
neighbours, then its smaller ones) until the edges are stars around the component's
smallest node. A round is two grouped minima, which Spark combines before its shuffles,
and two equi joins whose large side adaptive execution may split, so a hub with a third of
all edges is no single task's work: the minima are stored first, so that the joins have
plain inputs. Rounds are stored in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shopflow.session import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")), "components-least")
    joined = both.join(least, "a").where("b > a")
    return joined.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "components-least")
    rewired = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rewired.union(least.select("a", F.col("m").alias("b"))).distinct()


def _done(edges: DataFrame) -> bool:
    """True if every node has one edge, to a node that has none of its own."""
    parents = edges.select(F.col("b").alias("a")).distinct()
    again = edges.groupBy("a").count().where("count > 1").select("a")
    return edges.join(parents, "a", "left_semi").select("a").union(again).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node named by an edge; component is its smallest node.

    ``edges`` has the long columns a and b; order, repeats, NULLs and loops do not matter.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "components",
    )
    while not _done(now):
        before, now = now, stored(_small_star(_large_star(now)), "components")
        discard(before)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
