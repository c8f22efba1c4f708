"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Rows (node, component) for every node of an edge; component is the smallest node reachable.

    Nulls and self-loops are ignored, repeated edges count once, an empty table gives no rows. Each
    step is two aggregations and joins over the edges; nothing is gathered, and the edge table is
    written after each round, so a lost executor costs one round at most. A hub meets its many
    edges in a join that adaptive execution can split.
    """
    spark = edges.sparkSession
    big, small = F.greatest("_a", "_b").alias("u"), F.least("_a", "_b").alias("v")
    state = (
        edges.select(F.col(src).cast("long").alias("_a"), F.col(dst).cast("long").alias("_b"))
        .where("_a <> _b")
        .select(big, small)
        .distinct()
    )
    state, path = written(state, "edges")
    mark = _mark(state)
    while True:
        # every larger neighbour of a node moves to the smallest of its neighbourhood
        both = state.union(state.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # every smaller neighbour, and the node itself, moves to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        new, new_path = written(moved.where("u <> v").distinct(), "edges")
        drop_written(spark, path)
        state, path, before = new, new_path, mark
        mark = _mark(state)
        if mark == before:
            break
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
