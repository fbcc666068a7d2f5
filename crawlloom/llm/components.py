"""Connected components of an edge list by alternating large-star and small-star.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Both steps are
joins and aggregates over edges, so neither links nor components reach the driver, and
a node with very many neighbours is a skewed join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlloom.llm.shared import cut


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.select("hi", "lo").union(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    both = both.toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (
        both.filter("v > u").join(least, "u").filter("v <> m")
        .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest one."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour at most, and that one has none itself."""
    roles = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("lo", F.lit(0), F.lit(1))
    )
    roles = roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not roles.filter("up > 1 or up = 1 and down = 1").head(1)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each linked node with the smallest node it reaches.

    Null ends and self links are ignored, repeated links count once, no links give an
    empty frame. Nodes of any orderable type. Nodes without a link are not returned.
    """
    found = cut(
        edges.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )
    while not _are_stars(found):
        found = cut(small_star(large_star(found)))
    roots = found.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return found.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
