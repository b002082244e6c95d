"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.shared import drop, materialize, new_path


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of an edge (u, v), component being the smallest id that it reaches.

    Alternating large-star and small-star steps; each is one min by key and one join, so a node with very
    many edges is no group that a task must hold. Every round is written to the shared folder in place of the last, and only
    one row of two numbers comes to the driver, to see that nothing changed.
    """
    ordered = lambda e: e.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    spark = edges.sparkSession
    path = new_path(spark, "edges")
    edges = materialize(ordered(edges), "edges", path)
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = ordered(large)
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        last, path = path, new_path(spark, "edges")
        edges = materialize(ordered(small.select("e.*")), "edges", path)
        drop(spark, last)
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component"))
    ).distinct()
