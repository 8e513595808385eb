"""Connected components of a graph given as edges, by joins and grouped minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rillstone.llm.common import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node that each node can reach. Nodes are numbers, edges have no direction.

    Large-star and small-star steps in turn: each links neighbours of a node to the smallest of them, until every
    edge leads to its component's smallest node. A node's neighbours are never gathered in one place: their minimum
    is combined before the shuffle and joined back, and the join of a node with very many edges can be split.
    The number of turns grows with the logarithm of the graph's size; an empty graph gives an empty table.
    """
    now = cut(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    while True:
        before = measure(now)
        large = star(now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), large=True)
        now = cut(star(large, large=False), "edges")
        if measure(now) == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def measure(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def star(pairs: DataFrame, large: bool) -> DataFrame:
    """Edges u > v after a step. Large: each node's larger neighbours go to its smallest. Small: each node's
    smaller neighbours, and the node, do."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = pairs.join(least.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u"))
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select(F.col("u"), F.col("m").alias("v"))
        )
    return moved.where("u != v").distinct()
