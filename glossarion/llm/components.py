"""Connected components by alternating large-star and small-star steps, each a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossarion.llm._shared import Workspace


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(space: Workspace, edges: DataFrame, name: str = "cc") -> DataFrame:
    """``edges``: a, b (long), in any direction. Returns v, comp: the smallest vertex reachable.

    Each step finds the least neighbour of every vertex by an aggregation (combined
    before the shuffle, so hubs do no harm) and joins it back; a join may split a hub.
    Only vertices of edges are returned. Nothing but a count and a checksum reaches the driver.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, step, before = space.write(pairs, f"{name}0"), 0, None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        step += 1
        after = space.write(small, f"{name}{step}")
        space.drop(f"{name}{step - 1}")
        state = _state(after)
        if state == before:
            break
        current, before = after, state
    roots = after.select(F.col("b").alias("v"), F.col("b").alias("comp")).distinct()
    return after.select(F.col("a").alias("v"), F.col("b").alias("comp")).unionByName(roots)
