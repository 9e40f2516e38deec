"""Connected components of an edge table, by alternating star steps.

Every step replaces edges so that nodes hang on smaller and smaller neighbours (large star: each
neighbour that is larger than a node moves to the node's smallest neighbour; small star: the smaller
ones do).  The edges end as one star for each component.  Rounds are written to the shared folder, and
nothing but whether to go on reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from knnspark.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: distinct (u, v) with u > v."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = both.join(least, "u")
    if large:
        moved = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return moved.where(F.col("u") > F.col("v")).distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether every node hangs on one other node that hangs on none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node of its component."""
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where(F.col("u") > F.col("v")).distinct(), name)
    while not _is_done(now):
        now = written(_star(_star(now, large=True), large=False), name)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
