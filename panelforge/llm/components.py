"""Connected components over edge tables, with nothing but grouping and shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.session import stage


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``edges`` (a, b); component is the least node reachable.

    Alternating large-star and small-star steps until nothing changes; each step groups by node and
    writes its result to the shared folder, so lineage stays short and no executor's loss costs more
    than a step. A node with very many neighbours never gets them in one row: each step needs only
    the least neighbour, which is aggregated before the shuffle, and joins it back by node (a skewed
    join, which Spark splits). Loops and NULLs are ignored, repeated edges count once.
    """
    spark = edges.sparkSession
    now = (edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
           .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    now = stage(now, "edges")
    for _ in range(rounds):
        if now.isEmpty():
            break
        # large star: larger neighbours of each node move to its least neighbour
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where(F.col("b") > F.col("a")).join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())
        large = stage(large, "large-star")
        # small star: smaller neighbours of each node, and the node itself, move to the least of them
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(floor, "a").select(F.col("b").alias("x"), "m")
                 .unionByName(floor.select(F.col("a").alias("x"), "m"))
                 .where("x != m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct())
        small = stage(small, "small-star")
        before, after = (d.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"))
                         .first() for d in (now, small))
        now = small
        if before == after:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
