"""Dense search: exact top-k for a set of query vectors.

The query set is a stated, bounded set. It is cut into blocks of ``block`` vectors that all travel to one scan as matrices.
A task keeps track of the k best scores of each query, so that a row leaves it only where it is among the best so far, and a
window keeps the k best of those. The collection is read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.vectors import HIGHER_IS_BETTER, measure

#: Queries of one call; they pass through the driver and travel to every task.
MOST_QUERIES = 100_000


def _scores(name: str, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    if name == "dot":
        return q @ v.T
    if name == "cosine":
        nq, nv = np.linalg.norm(q, axis=1), np.linalg.norm(v, axis=1)
        nq[nq == 0], nv[nv == 0] = 1, 1
        return (q / nq[:, None]) @ (v / nv[:, None]).T
    if name == "manhattan":
        return np.stack([np.abs(v - x).sum(1) for x in q]) if len(q) else np.zeros((0, len(v)))
    d = np.stack([((v - x) ** 2).sum(1) for x in q]) if len(q) else np.zeros((0, len(v)))
    return np.sqrt(d) if name == "euclid" else d


def knn(
    records: DataFrame, queries: DataFrame, k: int = 5, metric: str = "cosine", *, id_col: str = "id",
    vector_col: str = "vector", digits: int | None = None, block: int = 1024, most: int = MOST_QUERIES,
) -> DataFrame:
    """``(query_id, rank, id, score)``: the k best records of each query.

    queries: ``query_id BIGINT, vector``. Rows without a vector of the queries' length, or with null or NaN in it,
    are no candidates; queries without a vector give no row. Ties go by smaller id. ``digits`` rounds scores before
    ranking. A zero vector has cosine 0. More than ``most`` queries are an error: they are to be asked in batches, since
    the whole set passes through the driver.
    """
    if metric not in HIGHER_IS_BETTER:
        raise ValueError(f"Unknown distance: {metric!r}; use one of {sorted(HIGHER_IS_BETTER)}")
    if k < 1:
        raise ValueError("k must be positive")
    up = HIGHER_IS_BETTER[metric]
    id_type = records.schema[id_col].dataType.simpleString()
    qs = [(r[0], r[1]) for r in queries.select("query_id", "vector").limit(most + 1).toLocalIterator() if r[1] and not any(x is None or x != x for x in r[1])]
    if len(qs) > most:
        raise ValueError(f"{len(qs)} queries at once; ask at most {most}")
    blocks: list[tuple[np.ndarray, np.ndarray]] = []
    for d in sorted({len(v) for _, v in qs}):
        own = [(i, v) for i, v in qs if len(v) == d]
        for s in range(0, len(own), block):
            blocks.append((np.array([i for i, _ in own[s : s + block]], dtype=np.int64), np.array([v for _, v in own[s : s + block]], dtype=np.float64)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worst = [np.full(len(ids), np.inf) for ids, _ in blocks]  # the k-th best key of each query so far
        best = [np.full((len(ids), k), np.inf) for ids, _ in blocks]
        for b in batches:
            lengths = np.asarray(pc.fill_null(b.column(1).value_lengths(), -1))
            rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for n, (ids, q) in enumerate(blocks):
                d = q.shape[1]
                if d not in rows:
                    at = np.flatnonzero(lengths == d)
                    v = np.array(b.column(1).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, d)
                    good = ~np.isnan(v).any(1)
                    rows[d] = at[good], v[good]
                at, v = rows[d]
                if not len(at):
                    continue
                sc = _scores(metric, q, v)
                if digits is not None:
                    sc = np.round(sc, digits) + 0.0
                key = -sc if up else sc
                if len(at) > k:
                    best[n] = np.partition(np.concatenate([best[n], np.partition(key, k - 1, axis=1)[:, :k]], axis=1), k - 1, axis=1)[:, :k]
                    worst[n] = best[n].max(1)
                qi, vi = np.nonzero(key <= worst[n][:, None])  # every row that ties with the k-th stays
                if len(qi):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[qi]), b.column(0).take(pa.array(at[vi])), pa.array(sc[qi, vi])], names=["query_id", "id", "score"])

    if not blocks:
        return records.sparkSession.createDataFrame([], f"query_id BIGINT, rank BIGINT, id {id_type}, score DOUBLE")
    found = records.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(search, f"query_id BIGINT, id {id_type}, score DOUBLE")
    return top_k(found, k, higher_is_better=up)


def top_k(scored: DataFrame, k: int, higher_is_better: bool = True, tie: str = "id") -> DataFrame:
    """The k best rows of each ``query_id`` by ``score``, ties by the tie column, as ``(query_id, rank, id, score)``."""
    order = [F.desc("score") if higher_is_better else F.asc("score"), F.asc(tie)]
    w = Window.partitionBy("query_id").orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("bigint").alias("rank"), "id", "score")


def knn_expression(records: DataFrame, queries: DataFrame, k: int, metric: str, digits: int | None = None) -> DataFrame:
    """The same result from column expressions only; for small collections and for reading."""
    s = measure(metric, F.col("v"), F.col("q"))
    j = records.select("id", F.col("vector").alias("v")).crossJoin(queries.select("query_id", F.col("vector").alias("q")))  # a stated query set
    j = j.select("query_id", "id", (s if digits is None else F.round(s, digits)).alias("score")).filter("score is not null")
    return top_k(j, k, HIGHER_IS_BETTER[metric])
