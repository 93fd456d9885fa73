"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import stored_at
from basketflow.plans.scratch import remove


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``links`` (``a``, ``b``: longs, not null).

    The component is its smallest node.  Each round hangs a node's larger
    neighbours, then its smaller ones, onto the smallest node it knows, until
    nothing changes; rounds grow with the logarithm of the longest chain.  All
    steps are joins and aggregates on the node; links of a node with very many are
    reduced to a minimum before the shuffle, and Spark splits its side of a join.
    Each round is a stored table, so that lost executors cost no more than a round;
    the one before it is removed.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, path = stored_at(edges, "components")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.union(edges.select("v", "u")).toDF("x", "y")
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last = path
        edges, path = stored_at(moved.union(smallest).distinct(), "components")
        remove(links.sparkSession, last)
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.toDF("node", "component").union(roots)
