"""Connected components of an edge list, by alternating star contraction.

Each round points every node at the smallest neighbour it knows and hands its
other neighbours on to that one, so the number of rounds grows with the
logarithm of a component's size.  Minima are aggregated before the shuffle, and
the joins back are plain equi-joins that Spark splits where one node has many
neighbours.  Every round is a written table; nothing is collected but a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casebook.llm.common import joined_back, saved


def _towards_least(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with ``m``: the least of u and its partners."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    return joined_back(pairs, least, "u").withColumn("m", F.least("u", "least"))


def _round(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _towards_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    small = _towards_least(large)
    return (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def _unsettled(edges: DataFrame) -> bool:
    """Whether some node has two parents, or is a child and a parent."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("child")).union(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("child")))
    open_nodes = (ends.groupBy("node").agg(F.sum("child").alias("parents"), F.min("child").alias("least"))
                  .where("parents > 1 or (parents > 0 and least = 0)"))
    return open_nodes.agg(F.count(F.lit(1))).first()[0] > 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; ``edges`` has bigints u and v.

    ``root`` is the least node of the component.  Edges from a node to itself
    and NULL ends are ignored; an empty table gives an empty result.  It ends
    when every component is a star around its least node.
    """
    ends = F.greatest("u", "v"), F.least("u", "v")
    now = saved(edges.where("u <> v").select(ends[0].alias("u"), ends[1].alias("v")).distinct(),
                "edges")
    while _unsettled(now):
        now = saved(_round(now), "edges")
    roots = now.select(F.col("v").alias("node")).distinct()
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(roots.withColumn("root", F.col("node"))))
