"""Connected components of an edge table by alternating large and small stars.

Both steps keep the graph's components and never make more edges than there
are; minima are pre-aggregated before the shuffle, so a hub costs one row a
task.  Rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(src, dst) -> (node, component), the smallest node of its component, for every node on an edge."""
    def ordered(df: DataFrame) -> DataFrame:
        return (df.where("src <> dst").select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
                .distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    now = materialize(ordered(edges), "cc")
    before = state(now)
    for _ in range(rounds):
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: every larger neighbour of u goes to the smallest of u and its neighbours
        large = ordered(now.select(F.col("lo").alias("u"), "hi").join(least, "u")
                        .select(F.col("hi").alias("src"), F.col("m").alias("dst")))
        # small star: u and its smaller neighbours go to the smallest of them
        large = materialize(large, "cc-large")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(least, "hi")
        now = materialize(ordered(moved.select(F.col("lo").alias("src"), F.col("m").alias("dst"))
                                  .unionAll(moved.select(F.col("hi").alias("src"), F.col("m").alias("dst")))), "cc-small")
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("lo").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(roots)
