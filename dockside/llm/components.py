"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dockside.plans.staging import stage


def _with_least(edges: DataFrame, label: str) -> DataFrame:
    """Each edge (u, v) with ``m``, the least neighbour of u or u itself.

    The least neighbours are a written table, so the join reads two plain exchanges and adaptive execution can split
    the edges of a hot node.
    """
    least = stage(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), label)
    return edges.join(least, "u")


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge in ``edges(a, b)``; the root is the component's least node.

    Each round costs a few shuffles of edges; the number of rounds grows with the logarithm of the longest path.
    Every half round is a written table, so nothing is recomputed when an executor is lost.
    """
    e = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    e = stage(e.distinct(), "edges")
    before = _signature(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, "least").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(large.distinct(), "large-star")
        small = _with_least(e, "least").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")
        ).select("x.u", "x.v").where(F.col("u") != F.col("v"))
        e = stage(small.distinct(), "small-star")
        if (now := _signature(e)) == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
