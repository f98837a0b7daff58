"""Connected components of an edge table, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmart.llm.common import dropped, written


def connected_components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """(node, component) of every node of the edges (a, b); component is the smallest node reachable.

    Each round links a node's larger neighbours, then its smaller ones, to the smallest of its
    neighbourhood, until no edge changes; the number of rounds grows with the logarithm of the
    longest path. Minima combine before the shuffle, so a hub is one row per task there; its edges
    then meet the minimum in a join, which Spark can split.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where("a > b").distinct(), f"{name}-edges")
    n, last = now.count(), None
    for turn in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Minima are written, so that each join shuffles both sides itself and a hub's side can be split.
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), f"{name}-least", n)
        large = written(both.where("b > a").join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct(), f"{name}-large", n)
        small_least = written(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-least", n)
        small = large.join(small_least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(small_least.select("a", F.col("m").alias("b")))
        before, now = now, written(small.where("a > b").distinct(), f"{name}-{turn}", n)
        for done in (before, least, large, small_least):
            dropped(done)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == last:
            break
        last = seen
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
