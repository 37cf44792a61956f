"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import drop_saved, saved


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """For each ``u`` the least of itself and its neighbours, keyed by ``-u``.

    A hub's links meet in one join key.  The key is not the column that the aggregate is
    partitioned by, so both sides of the join are shuffled anew and adaptive execution can split
    the hub.
    """
    return edges.groupBy("u").agg(F.min("v").alias("least")).selectExpr(
        "-u AS key", "least(u, least) AS least"
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    keyed = both.selectExpr("-u AS key", "u", "v").where("v > u")
    return keyed.join(_least_neighbour(both), "key").selectExpr("v AS u", "least AS v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them.  Here u is the larger end."""
    keyed = edges.selectExpr("-u AS key", "u", "v")
    joined = keyed.join(_least_neighbour(edges), "key")
    return joined.selectExpr("inline(array(struct(v AS u, least AS v), struct(u, least AS v)))")


def components(links: DataFrame, first: str, second: str) -> DataFrame:
    """The nodes of all links with the least node they can reach: columns ``node``, ``component``.

    Links are rewritten by large and small stars in turn until they are stars, which takes few
    rounds even for long chains.  Every round is written to the shared folder, and the one before
    it deleted.
    """
    edges = links.select(
        F.greatest(first, second).cast("bigint").alias("u"),
        F.least(first, second).cast("bigint").alias("v"),
    ).where("u != v")
    edges = saved(edges.distinct(), "links")
    before = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
        following = saved(
            _small_star(_large_star(edges)).where("u != v").distinct(), "links"
        )
        drop_saved(edges)
        edges = following
