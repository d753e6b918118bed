"""Connected components of an edge list, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut


def components(edges: DataFrame, a: str, b: str, most: int = 60) -> DataFrame:
    """``node, component``: the least node of each component. Every round is cut by a checkpoint; labels never leave the executors."""
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    e = cut(e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y"))).filter("x <> y").distinct())
    labels = cut(e.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("l")))
    for _ in range(most):
        near = e.join(labels.select(F.col("x").alias("y"), F.col("l").alias("m")), "y").groupBy("x").agg(F.min("m").alias("m"))
        new = labels.join(near, "x").select("x", F.least("l", "m").alias("l"), F.col("l").alias("old"))
        jump = new.select(F.col("x").alias("l"), F.col("l").alias("ll"))
        new = cut(new.join(jump, "l", "left").select("x", F.least("l", F.coalesce("ll", "l")).alias("l"), "old"))
        changed = not new.filter("l <> old").isEmpty()
        labels = new.select("x", "l")
        if not changed:
            return labels.select(F.col("x").alias("node"), F.col("l").alias("component"))
    raise RuntimeError(f"components did not settle in {most} rounds")
