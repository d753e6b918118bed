"""Reranking of the hits of each query: maximal marginal relevance and pair scorers.

A query's hit list is bounded by the k of the search before it, so a query is one small group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.interfaces import BaseReranker


def cosine_matrix(vectors: np.ndarray) -> np.ndarray:
    """Pairwise cosines, diagonal 1; a zero vector counts as having norm 1."""
    v = np.asarray(vectors, dtype=np.float64)
    n = np.linalg.norm(v, axis=1)
    n[n == 0] = 1.0
    m = (v / n[:, None]) @ (v / n[:, None]).T
    np.fill_diagonal(m, 1.0)
    return m


def mmr_order(vectors: np.ndarray, scores: np.ndarray, top_n: int, lambda_mult: float) -> list[int]:
    """Greedy order: the most relevant first, then the best of ``lambda * relevance - (1 - lambda) * similarity``.

    Ties go to the lower index. The first pick is made whatever ``top_n`` is, so 0 still gives one index.
    """
    n = len(scores)
    if n == 0:
        return []
    sim = cosine_matrix(vectors)
    picked = [int(np.argmax(scores))]
    nearest = sim[picked[0]].copy()
    left = np.ones(n, bool)
    left[picked[0]] = False
    while len(picked) < min(top_n, n):
        value = np.where(left, lambda_mult * scores - (1 - lambda_mult) * nearest, -np.inf)
        i = int(np.argmax(value))
        picked.append(i)
        left[i] = False
        nearest = np.maximum(nearest, sim[i])
    return picked


def mmr(hits: DataFrame, top_n: int = 8, lambda_mult: float = 0.5, higher_is_better: bool = True) -> DataFrame:
    """``(query_id, new_rank, old_rank)`` from ``(query_id, rank, id, vector, score)``.

    Distances (``higher_is_better=False``) become ``1 - score``. A hit without vector or score is an error that names it.
    """
    if not 0 <= lambda_mult <= 1:
        raise ValueError("lambda_mult must lie in 0..1")

    def order(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("rank").reset_index(drop=True)
        for i, r in g.iterrows():
            if r["vector"] is None or r["score"] is None or pd.isna(r["score"]):
                raise ValueError(f"candidate {i} (id={r['id']!r}) lacks a vector or a score")
        s = g["score"].to_numpy(float)
        picks = mmr_order(np.stack(g["vector"].to_numpy()), s if higher_is_better else 1.0 - s, top_n, lambda_mult)
        return pd.DataFrame({"query_id": g["query_id"].iloc[0], "new_rank": range(1, len(picks) + 1), "old_rank": g["rank"].iloc[picks].to_numpy()})

    return hits.select("query_id", "rank", "id", F.col("vector").cast("array<double>").alias("vector"), F.col("score").cast("double").alias("score")).groupBy("query_id").applyInPandas(order, "query_id BIGINT, new_rank BIGINT, old_rank BIGINT")


def candidate_text(document: str = "document", metadata: str = "metadata") -> Column:
    """The document, else ``metadata.document``, else the empty text."""
    return F.coalesce(F.nullif(F.col(document), F.lit("")), F.try_element_at(metadata, F.lit("document")), F.lit(""))


def pair_rerank(hits: DataFrame, scorer: Callable[[], Callable[[list[str], list[str]], list[float]]], top_n: int | None = None) -> DataFrame:
    """``(query_id, new_rank, old_rank, score)`` by a pair scorer over ``(query_id, rank, query, text)``.

    Without a column ``text`` it is taken from ``document``, else from the metadata.

    scorer: a factory, called once per worker, that returns a function of two lists of texts. ``top_n=0`` gives no rows.
    """

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        f = scorer()
        for q, t in parts:
            yield pd.Series(f(q.fillna("").tolist(), t.fillna("").tolist()), dtype="float64")

    if "text" not in hits.columns:
        hits = hits.withColumn("text", candidate_text())
    s = hits.select("query_id", F.col("rank").alias("old_rank"), score("query", "text").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "old_rank")
    out = s.select("query_id", F.row_number().over(w).cast("bigint").alias("new_rank"), "old_rank", "score")
    return out if top_n is None else out.filter(F.col("new_rank") <= top_n)


def overlap_scorer() -> Callable[[list[str], list[str]], list[float]]:
    """A deterministic stand-in for a neural pair scorer: the share of query words found in the text."""

    def f(qs: list[str], ts: list[str]) -> list[float]:
        out = []
        for q, t in zip(qs, ts, strict=True):
            a, b = set(q.lower().split()), set(t.lower().split())
            out.append(len(a & b) / len(a) if a else 0.0)
        return out

    return f


def model_scorer(model_id: str, device: str | None = None, batch_size: int = 32) -> Callable[[], Callable[[list[str], list[str]], list[float]]]:
    """A cross-encoder of sentence-transformers, by name or local directory, loaded once per worker. Needs that package there."""

    def factory() -> Callable[[list[str], list[str]], list[float]]:
        try:
            from sentence_transformers import CrossEncoder
        except ImportError as e:
            raise RuntimeError("sentence-transformers is not installed on the workers") from e
        m = CrossEncoder(model_id, device=device)
        return lambda qs, ts: [float(x) for x in m.predict(list(zip(qs, ts, strict=True)), batch_size=batch_size)] if qs else []

    return factory


class MmrReranker(BaseReranker):
    def __init__(self, lambda_mult: float = 0.5, higher_is_better: bool = True) -> None:
        if not 0 <= lambda_mult <= 1:
            raise ValueError("lambda_mult must lie in 0..1")
        self.lambda_mult, self.higher_is_better = lambda_mult, higher_is_better

    def rerank(self, hits: DataFrame, top_n: int | None = None) -> DataFrame:
        return mmr(hits, 8 if top_n is None else top_n, self.lambda_mult, self.higher_is_better)


class PairReranker(BaseReranker):
    def __init__(self, scorer: Callable[[], Callable[[list[str], list[str]], list[float]]]) -> None:
        self.scorer = scorer

    def rerank(self, hits: DataFrame, top_n: int | None = None) -> DataFrame:
        return pair_rerank(hits, self.scorer, top_n)
