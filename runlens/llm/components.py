"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a join on node ids over tables that shrink towards stars; lineage is cut by a
table in the shared folder after each round, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import discard, materialise


def _least_around(edges: DataFrame) -> DataFrame:
    """The least of each node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least node around it (edges have a > b).

    ``least`` is a table, not a plan: so Spark can split the rows of a node with very many neighbours over several tasks.
    """
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the least of them (edges have a > b)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Map every linked node to the least node that it can reach.

    ``edges`` has two columns of longs, one row per link, in any direction and with repeats; links
    with a null end or from a node to itself say nothing.  Returns (node, component): one row for
    each node that has a link to another node, the component's least node included.  An empty
    table gives an empty one.
    """
    a, b = edges.columns
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), (F.col(a) != F.col(b)).alias("ok"))
    now = materialise(edges.where("ok").select("a", "b").distinct(), "links")  # a > b from here on
    while True:
        least = materialise(_least_around(now), "least")
        new = materialise(_small_star(_large_star(now, least)), "links")
        discard(now, least)
        now = new
        # Done when the links are stars, no node being an end of one and the head of another, and each end has one head.
        roles = now.select("a", F.lit(1).alias("ends"), F.lit(0).alias("heads")).union(now.select("b", F.lit(0), F.lit(1)))
        if roles.groupBy("a").agg(F.sum("ends").alias("ends"), F.max("heads").alias("heads")).where("ends > 1 or ends = 1 and heads = 1").isEmpty():
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
