"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.sources.tables import stage


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges as (child, parent) with child > parent."""
    return edges.select(
        F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")
    ).where("child > parent").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is tied to the smallest node around it."""
    both = edges.select(F.col("child").alias("a"), F.col("parent").alias("b")).unionByName(
        edges.select(F.col("parent").alias("a"), F.col("child").alias("b"))
    )
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return _oriented(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("child").agg(F.min("parent").alias("low"))
    joined = edges.join(least, "child")
    return _oriented(
        joined.select(F.col("parent").alias("a"), F.col("low").alias("b")).unionByName(
            least.select(F.col("child").alias("a"), F.col("low").alias("b"))
        )
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("child", "parent"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node on an edge (a, b); root is the smallest id of its component.

    Edges may repeat, point either way and be loops (which add no node). Each round is a written
    table, so lineage stays short; the number of rounds grows with the logarithm of the longest path.
    """
    current = stage(_oriented(edges), "edges")
    before = _state(current)
    while before[0]:
        current = stage(_small_star(_large_star(current)), "edges")
        now = _state(current)
        if now == before:
            break
        before = now
    return current.select(F.col("child").alias("id"), F.col("parent").alias("root")).unionByName(
        current.select(F.col("parent").alias("id"), F.col("parent").alias("root")).distinct()
    )
