"""Reciprocal rank fusion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.interfaces import BaseFusor


def rrf(lanes: DataFrame, k: int = 60, digits: int | None = None) -> DataFrame:
    """``(query_id, rank, id, score)`` from ``(query_id, lane, rank, id)``: the sum of ``1 / (k + rank)``.

    Ranks start at 1. An id repeated in a lane adds each time. Ties go to the id that appears first, by lane and rank.
    Rows without id or rank are left out; no rows give no rows.
    """
    s = F.sum(F.lit(1.0) / (F.lit(float(k)) + F.col("rank")))
    f = lanes.filter("id is not null and rank is not null").groupBy("query_id", "id").agg((s if digits is None else F.round(s, digits)).alias("score"), F.min(F.struct("lane", "rank")).alias("first"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "first", "id")
    return f.select("query_id", F.row_number().over(w).cast("bigint").alias("rank"), "id", "score")


def as_lanes(*rankings: DataFrame) -> DataFrame:
    """Rankings ``(query_id, rank, id)`` put under each other with their lane number."""
    parts = [r.select("query_id", F.lit(i).alias("lane"), "rank", F.col("id").cast("string").alias("id")) for i, r in enumerate(rankings)]
    if not parts:
        raise ValueError("at least one ranking is needed")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class ReciprocalRankFusor(BaseFusor):
    def __init__(self, k: int = 60) -> None:
        self.k = k

    def fuse(self, lanes: DataFrame) -> DataFrame:
        return rrf(lanes, self.k)
