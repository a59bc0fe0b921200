"""Connected components of a distributed edge list by alternating stars.

Large star: every node hands its larger neighbours to its smallest one. Small star: every
node hands its smaller neighbours, and itself, to the smallest of them. Repeated until the
edges stay the same, each component is a star around its smallest node. All of it is
aggregates and joins; each step is a written table, and only two numbers reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquill.llm import shared


def written(least: DataFrame) -> DataFrame:
    """Of a written table the join shuffles both sides anew, so a node with very many
    neighbours is a partition that can be split."""
    return shared.stage(least, "star-least")


def large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The new edges and a written table that they read."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
    moved = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.distinct(), least


def small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same, of edges whose a is smaller than their b."""
    least = written(edges.groupBy("b").agg(F.min("a").alias("m")))
    moved = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).where("a <> b")
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct(), least


def step(edges: DataFrame, star: Callable, name: str) -> DataFrame:
    """The edges after a star, written; what it was made from goes."""
    new, least = star(edges)
    new = shared.stage(new, name)
    shared.release(edges, least)
    return new


def state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def stars(edges: DataFrame) -> DataFrame:
    """(a, b) with a < b, both of one ordered type -> (a, b): a the smallest node of b's component."""
    edges = shared.stage(edges.where("a < b").distinct(), "star-edges")
    before = state(edges)
    while before[0]:
        edges = step(step(edges, large_star, "large-star"), small_star, "small-star")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges
