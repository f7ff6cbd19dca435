"""Connected components of an edge list by alternating star steps, each a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.session import written

MOST_ROUNDS = 60


def _to_least(edges: DataFrame, least: str) -> DataFrame:
    """(u, v) joined with the least neighbour ``m`` of u; map tasks reduce before the shuffle."""
    smallest = edges.groupBy("u").agg(F.expr(least).alias("m"))
    return edges.join(smallest, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_least(both, "least(min(v), u)").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    met = _to_least(edges, "min(v)")
    own = met.select("u", F.col("m").alias("v"))
    return met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(own)


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of any ordered type -> (node, root): each node that has an edge to another
    node, with the least node of its component. A hot node is reduced in the map tasks and
    its join is split at run time. Loops and NULLs are no edges.
    """
    spread = edges.toDF("a", "b").where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now, before = written(spread.distinct()), None
    for _ in range(MOST_ROUNDS):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            break
        before = tuple(state)
        now = written(_small_star(_large_star(now).distinct()).distinct())
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
