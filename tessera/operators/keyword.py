"""Keyword search for many queries in one plan.

``okapi`` ranks every document (those without a query term score 0), ``sparse_idf`` only documents that share a term.

The queries are a stated, bounded set: their weights travel to the scan, every document is scored within its Arrow batch,
and a task keeps track of the k best scores of each query, so that few rows leave it and nothing is shuffled by token. Only
document frequencies are aggregated over the corpus.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import VOCAB_SIZE, token_index, tokens
from tessera.interfaces import BaseKeywordIndex, SupportsKeywordSearch
from tessera.operators.search import MOST_QUERIES, top_k
from tessera.session import stored

#: The usual constants of Okapi BM25 with a floor for negative weights.
K1, B, EPSILON = 1.5, 0.75, 0.25
#: Scores held at once: rows of a slice times queries of a block; queries of a block.
_CELLS, _BLOCK = 2_000_000, 1024


def tokenized(docs: DataFrame, *, id_col: str = "id", text_col: str = "text", position: str | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """``id, pos, toks`` of all documents as a stored table, for several searches of the same corpus."""
    return stored(docs.select(F.col(id_col).alias("id"), F.col(position or id_col).alias("pos"), tokens(text_col).alias("toks"), *extra))


def _asked(queries: DataFrame, most: int) -> dict[int, Counter]:
    """The tokens of each query; rows of one query count together."""
    rows = queries.filter("query_id is not null").select("query_id", tokens("text").alias("toks")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{len(rows)} queries at once; ask at most {most}")
    out: dict[int, Counter] = {}
    for q, t in rows:
        out.setdefault(q, Counter()).update(t)
    return out


class _Weights:
    """For each term the queries that have it and their weights."""

    def __init__(self, ids: list[int], weights: list[dict], terms: list) -> None:
        at = {t: i for i, t in enumerate(terms)}
        rows = [(at[t], i, x) for i, d in enumerate(weights) for t, x in d.items() if t in at]
        t, q, w = (np.array([r[j] for r in rows]) for j in range(3))
        t = t.astype(np.int64)
        order = np.argsort(t, kind="stable")
        self.ids, self.q, self.w = np.array(ids, dtype=np.int64), q[order].astype(np.int64), w[order].astype(np.float64)
        self.start = np.searchsorted(t[order], np.arange(len(terms) + 1))

    def scores(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores of rows by queries, and whether they share a term."""
        n = self.start[term + 1] - self.start[term]
        at = np.repeat(np.arange(len(row)), n)
        p = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + self.start[term][at]
        cell, size = row[at] * len(self.ids) + self.q[p], rows * len(self.ids)
        shape = (rows, len(self.ids))
        return np.bincount(cell, weights=value[at] * self.w[p], minlength=size).astype(np.float64).reshape(shape), (np.bincount(cell, minlength=size) > 0).reshape(shape)


class _Best:
    """The k best scores of each query so far; what lies under them need not leave the task."""

    def __init__(self, k: int, queries: int) -> None:
        self.k, self.top = k, np.full((k, queries), -np.inf)

    def keep(self, s: np.ndarray) -> np.ndarray:
        """Which of the scores (rows in order of their ties by queries, -inf: none) may be among the k best."""
        k = min(self.k, len(s))
        low = -np.partition(-s, k - 1, axis=0)[:k]
        kth = np.maximum(low.min(0) if k == self.k else -np.inf, self.top.min(0))
        over, tie = s > kth, (s == kth) & (s > -np.inf)
        few = tie & (np.cumsum(tie, axis=0) <= self.k - over.sum(0)) if tie.any() else tie
        self.top = -np.partition(-np.concatenate([self.top, low]), self.k - 1, axis=0)[: self.k]
        return over | few


def _searched(d: DataFrame, blocks: list[_Weights], entries: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]], k: int, digits: int | None, every: bool, columns: list[str]) -> DataFrame:
    """The k best documents of each query from ``id, pos, ...``; ``every``: also those that share no term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k, len(w.ids)) for w in blocks]
        for b in batches:
            b = b.take(pc.sort_indices(b.column(1)))  # in the order of ties
            row, term, value = entries(b)
            for w, top in zip(blocks, best, strict=True):
                step = max(1, _CELLS // max(1, len(w.ids)))
                for s in range(0, b.num_rows, step):
                    n = min(step, b.num_rows - s)
                    lo, hi = np.searchsorted(row, [s, s + n])
                    score, hit = w.scores(row[lo:hi] - s, term[lo:hi], value[lo:hi], n)
                    if digits is not None:
                        score = np.round(score, digits) + 0.0
                    r, q = np.nonzero(top.keep(score if every else np.where(hit, score, -np.inf)))
                    if len(r):
                        at = pa.array(r + s)
                        yield pa.RecordBatch.from_arrays([pa.array(w.ids[q]), b.column(0).take(at), b.column(1).take(at), pa.array(score[r, q])], names=["query_id", "id", "pos", "score"])

    types = {f.name: f.dataType.simpleString() for f in d.schema}
    found = d.select("id", "pos", *columns).mapInArrow(run, f"query_id BIGINT, id {types['id']}, pos {types['pos']}, score DOUBLE")
    return top_k(found, k, tie="pos")


def _rows(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Row number of each element, and the elements."""
    n = np.asarray(pc.fill_null(lists.value_lengths(), 0)).astype(np.int64)
    return np.repeat(np.arange(len(lists)), n), lists.flatten()


def _none(spark, id_type: str) -> DataFrame:
    return spark.createDataFrame([], f"query_id BIGINT, rank BIGINT, id {id_type}, score DOUBLE")


def okapi(
    docs: DataFrame, queries: DataFrame, k: int = 50, *, id_col: str = "id", text_col: str = "text", position: str | None = None,
    digits: int | None = None, corpus: DataFrame | None = None, most: int = MOST_QUERIES,
) -> DataFrame:
    """``(query_id, rank, id, score)`` by Okapi BM25, k1 = 1.5, b = 0.75.

    Weights below 0 become a quarter of the mean weight of the vocabulary. Repeated query tokens count repeatedly.
    Every document takes part, so documents without a query term fill up to k with score 0, and negative scores stay.
    Ties go by ``position`` (insertion order; the id where none is given). No documents, or none with a token: no rows.
    Rows with a repeated id are documents of their own. queries: ``query_id BIGINT, text``; a query without tokens ranks all
    documents at 0, one without an id is left out, and more than ``most`` are an error. ``corpus``: what ``tokenized`` made
    of the documents.
    """
    d = tokenized(docs, id_col=id_col, text_col=text_col, position=position) if corpus is None else corpus
    asked = _asked(queries, most)
    size = d.agg(F.count("*").alias("n"), F.avg(F.size("toks")).alias("avgdl")).first()
    if not asked or not size["avgdl"]:
        return _none(d.sparkSession, d.schema["id"].dataType.simpleString())
    terms = sorted({t for c in asked.values() for t in c})
    df = d.select(F.explode(F.array_distinct("toks")).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    raw = F.log(F.lit(size["n"]) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    q = d.sparkSession.createDataFrame([(t, True) for t in terms], "token STRING, asked BOOLEAN")  # the terms of a bounded query set
    w = df.select("token", raw.alias("raw")).join(F.broadcast(q), "token", "left")
    w = w.agg(F.avg("raw").alias("mean"), F.collect_list(F.when(F.col("asked"), F.struct("token", "raw"))).alias("w")).first()
    idf = {t: x if x >= 0 else EPSILON * w["mean"] for t, x in w["w"]}
    terms, avgdl, ids = sorted(idf), size["avgdl"], sorted(asked)
    known = pa.array(terms, pa.string())
    blocks = [_Weights(ids[s : s + _BLOCK], [{t: n * idf[t] for t, n in asked[i].items() if t in idf} for i in ids[s : s + _BLOCK]], terms) for s in range(0, len(ids), _BLOCK)]

    def entries(b: pa.RecordBatch):
        row, toks = _rows(b.column(2))
        length = np.bincount(row, minlength=b.num_rows)
        t = np.asarray(pc.fill_null(pc.index_in(toks, value_set=known), -1)).astype(np.int64)
        pair, tf = np.unique(row[t >= 0] * len(terms) + t[t >= 0], return_counts=True)
        row, t = np.divmod(pair, max(1, len(terms)))
        return row, t, tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[row] / avgdl))

    return _searched(d, blocks, entries, k, digits, True, ["toks"])


def _index(token: str, vocab_size: int) -> int:
    return int(hashlib.md5(token.encode()).hexdigest(), 16) % vocab_size


def sparse_rows(row: np.ndarray, toks: pa.Array, vocab_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, index and count of the hashed tokens of each row; of two tokens with one index the later one replaces the other."""
    d = toks.dictionary_encode()
    code, index = np.asarray(d.indices).astype(np.int64), np.array([_index(t, vocab_size) for t in d.dictionary.to_pylist()], dtype=np.int64)
    pair, first, n = np.unique(row * max(1, len(index)) + code, return_index=True, return_counts=True)
    row, idx = pair // max(1, len(index)), index[pair % max(1, len(index))] if len(pair) else pair
    order = np.lexsort((first, idx, row))
    row, idx, n = row[order], idx[order], n[order]
    last = np.ones(len(row), bool)
    last[:-1] = (row[1:] != row[:-1]) | (idx[1:] != idx[:-1])
    return row[last], idx[last], n[last].astype(np.float64)


def with_sparse(docs: DataFrame, text_col: str, vocab_size: int = VOCAB_SIZE) -> DataFrame:
    """The columns of a table and ``idx ARRAY<BIGINT>, tf ARRAY<DOUBLE>``, the sparse vector of a text column."""
    d = docs.withColumn("__toks", tokens(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, idx, tf = sparse_rows(*_rows(b.column(b.num_columns - 1)), vocab_size)
            ends = pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32))
            cols = [*b.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(idx)), pa.ListArray.from_arrays(ends, pa.array(tf))]
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names[:-1], "idx", "tf"])

    schema = T.StructType([*docs.schema.fields, T.StructField("idx", T.ArrayType(T.LongType())), T.StructField("tf", T.ArrayType(T.DoubleType()))])
    return d.mapInArrow(run, schema)


def sparse_idf(
    docs: DataFrame, queries: DataFrame, k: int = 50, *, id_col: str = "id", text_col: str = "text", where: Column | None = None,
    vocab_size: int = VOCAB_SIZE, digits: int | None = None, corpus: DataFrame | None = None, most: int = MOST_QUERIES,
) -> DataFrame:
    """``(query_id, rank, id, score)`` by the dot product of hashed term counts with inverse document frequencies.

    ``idf = ln(1 + (N - df + 0.5) / (df + 0.5))`` over the whole collection, N counting documents with a term; ``where``
    restricts the candidates, not the statistics. Only documents sharing a term appear; ties by smaller id. Rows with a
    repeated id are documents of their own. Where the documents have the columns ``idx`` and ``tf`` of ``with_sparse``, their
    texts are not read. ``corpus``: what ``tokenized`` made of the documents (without ``where``).
    """
    ready = corpus is None and {"idx", "tf"} <= set(docs.columns)
    if corpus is not None:
        d = corpus.select("id", "pos", F.lit(True).alias("ok"), "toks")
    else:
        ok = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
        d = docs.select(F.col(id_col).alias("id"), F.col(id_col).alias("pos"), ok.alias("ok"), *(["idx", "tf"] if ready else [tokens(text_col).alias("toks")]))
        d = d if ready else stored(d)
    asked = _asked(queries, most)
    weights: dict[int, dict[int, float]] = {}
    for q, c in asked.items():  # as for documents, of two tokens with one index the later one counts
        weights[q] = {_index(t, vocab_size): float(n) for t, n in c.items()}
    terms = np.array(sorted({i for w in weights.values() for i in w}), dtype=np.int64)
    if not len(terms):
        return _none(d.sparkSession, d.schema["id"].dataType.simpleString())

    def of(b: pa.RecordBatch):
        """Row, number of the term and count of the terms in question, and the rows with any term."""
        if ready:
            row, idx = _rows(b.column(3))
            row, idx, tf = row, np.asarray(idx), np.asarray(b.column(4).flatten())
        else:
            row, idx, tf = sparse_rows(*_rows(b.column(3)), vocab_size)
        at = np.minimum(np.searchsorted(terms, idx), len(terms) - 1)
        hit = terms[at] == idx
        return row[hit], at[hit], tf[hit], len(np.unique(row))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(len(terms), np.int64)
        for b in batches:
            _, t, _, some = of(b)
            n, df = n + some, df + np.bincount(t, minlength=len(terms))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["at", "n"])

    counts = d.mapInArrow(frequencies, "at BIGINT, n BIGINT").groupBy("at").agg(F.sum("n").alias("n"))
    df = {r["at"]: r["n"] for r in counts.collect()}  # a row per term of the queries
    n = df.pop(-1, 0)
    idf = {int(terms[t]): float(np.log(1 + (n - c + 0.5) / (c + 0.5))) for t, c in df.items()}
    ids = sorted(weights)
    blocks = [_Weights(ids[s : s + _BLOCK], [{t: x * idf[t] for t, x in weights[i].items() if t in idf} for i in ids[s : s + _BLOCK]], terms.tolist()) for s in range(0, len(ids), _BLOCK)]

    def entries(b: pa.RecordBatch):
        return of(b)[:3]

    return _searched(d.filter("ok"), blocks, entries, k, digits, False, ["ok", "idx", "tf"] if ready else ["ok", "toks"])


class KeywordIndex(BaseKeywordIndex):
    """An in-memory style index: upsert, delete and search over one DataFrame of ``(id, text)``.

    A replaced id keeps its first position, which breaks ties; within a batch positions follow the ids. Batches must not
    repeat an id. Each upsert is written out, so that the plan does not grow with their number.
    """

    def __init__(self, docs: DataFrame | None = None) -> None:
        self._docs: DataFrame | None = None
        self._batches = 0
        if docs is not None:
            self.upsert(docs)

    def upsert(self, docs: DataFrame) -> None:
        new = docs.select("id", "text", F.concat(F.lit(f"{self._batches:010d}:"), F.col("id")).alias("pos"))
        if self._docs is not None:
            old = self._docs.select("id", F.col("pos").alias("old"))
            new = new.join(old, "id", "left").select("id", "text", F.coalesce("old", "pos").alias("pos"))
            new = self._docs.join(new.select("id"), "id", "left_anti").unionByName(new)
        self._docs, self._batches = stored(new), self._batches + 1

    def delete(self, ids: list[str]) -> None:
        if self._docs is not None and ids:
            self._docs = self._docs.filter(~F.col("id").isin(list(ids)))

    def search(self, queries: DataFrame, k: int = 50) -> DataFrame:
        if self._docs is None:
            return _none(queries.sparkSession, "STRING")
        return okapi(self._docs, queries, k, position="pos")

    def close(self) -> None:
        self._docs, self._batches = None, 0


class NativeKeywordIndex(BaseKeywordIndex):
    """Search delegated to a collection's own sparse index; mutations are left to the collection."""

    def __init__(self, store: SupportsKeywordSearch, collection: str) -> None:
        self._store, self._collection = store, collection

    def search(self, queries: DataFrame, k: int = 50) -> DataFrame:
        return self._store.keyword_search(self._collection, queries, k).withColumn("score", F.coalesce("score", F.lit(0.0)))

    def upsert(self, docs: DataFrame) -> None: ...

    def delete(self, ids: list[str]) -> None: ...

    def close(self) -> None: ...


def query_terms(col: str) -> Column:
    """Hashed indexes of a query's tokens, for reading a plan."""
    return F.transform(tokens(col), lambda t: token_index(t))
