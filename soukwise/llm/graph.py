"""Connected components by alternating star contractions, each round a few joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukwise.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest node of a neighbourhood.

    ``large`` relinks the larger neighbours of a node, otherwise the smaller ones
    and the node itself. Either keeps the components as they are.
    """
    if large:
        both = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    else:
        both = edges.where("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.join(least, "a")
    if large:
        moved = linked.where("b > a").selectExpr("b as a", "m as b")
    else:
        moved = linked.select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
    return moved.where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each node that has a smaller neighbour has no other neighbour; then that is the smallest of its component."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("a").alias("id"), (F.col("b") < F.col("a")).alias("up")),
        F.struct(F.col("b").alias("id"), (F.col("a") < F.col("b")).alias("up")))))
    return ends.groupBy("id").agg(F.bool_or("up").alias("up"), F.count("*").alias("n")).where("up and n > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for every node of an edge table (a, b) of integers; label is the smallest id reached.

    The number of rounds grows with the logarithm of the longest path. Edges stay
    in tables, only whether they are settled reaches the driver. Every plan reads its edges
    few times, because the driver holds a plan with all its copies of them. Self loops count
    as nodes; an empty table gives an empty one.
    """
    edges = materialise(edges.select("a", "b").distinct())
    nodes = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    state = edges.where("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct()
    while not _settled(state):
        state = materialise(_star(_star(state, large=True), large=False))
    return nodes.join(state.toDF("id", "label"), "id", "left").selectExpr("id", "coalesce(label, id) as label")
