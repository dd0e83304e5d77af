"""Connected components of a graph given as an edge table, by alternating star operations.

*Large star*: every node hands its smallest neighbour (or itself) to its larger neighbours.
*Small star*: every node hands its smallest neighbour to its smaller ones and takes it itself.
Both keep the components and flatten them towards stars around the smallest node; rounds go on
until nothing changes, about the logarithm of the longest path.  Minima combine map-side and are
stored in the shared folder before they meet the edges, so that Spark can split the edges of a
node with very many of them.  Each round is stored too; a lost executor never costs more than its
own tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroute.llm.store import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = stored(both.groupBy("a").agg(F.min("b").alias("low")), "least")
    return (
        both.where("b > a").join(least, "a")
        .select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger node ``a`` to the smaller ``b``."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("low")), "least")
    across = edges.join(least, "a").where("b != low").select(F.col("b").alias("a"), "low")
    return across.union(least).select("a", F.col("low").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node it is linked with, for every node that has an
    edge to another one.  NULL ends and loops are ignored; edges may repeat."""
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b")
    state = stored(
        pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links")
    seen = _state(state)
    while seen[0]:
        state = stored(_small_star(stored(_large_star(state), "links")), "links")
        now = _state(state)
        if now == seen:
            break
        seen = now
    return (
        state.select(F.col("a").alias("node"), F.col("b").alias("component"))
        .union(state.select("b", "b")).distinct())
