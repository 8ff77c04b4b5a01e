"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import join_to_groups, written


def _star(edges: DataFrame, n: int) -> DataFrame:
    """`edges` (u, v): every neighbour v > u is linked to the least neighbour of u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree"))
    least = written(least.select("u", F.least("u", "m").alias("m"), "degree"), "least")
    return join_to_groups(edges, least, "u", "degree", n).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b; longs): root is the least
    node of its component.

    Alternating large and small stars: each round links nodes to smaller ones,
    until every node hangs from its root.  A round is a few shuffles of edges
    and is written to the shared folder, so the lineage stays short; nodes with
    many links go through `join_to_groups`.
    """
    now = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        n = now.count()
        large = written(_star(both, 2 * n).where("a != b").distinct(), "edges")  # larger neighbours to the least
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))  # a > b: towards smaller nodes
        n_large = large.count()
        least = written(down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree")), "least")
        joined = join_to_groups(down, least, "u", "degree", n_large)
        small = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        now = written(small.where("a != b").distinct(), "edges")
        at = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(at) == state:
            break
        state = tuple(at)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
