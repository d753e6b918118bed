"""Evaluation texts that leak into a corpus.

Texts are cut into passages of words, weighed by TF-IDF over the corpus, and projected by a randomised SVD that is computed
in passes over all passages: every task adds up its share of ``A'A`` applied to a few random vectors. Corpus passages
overlap so that any ten consecutive words lie within one; their cosine to the item's passages in the latent space chooses
the pairs that are checked: longest common run, longest common subsequence, and for paraphrases the item's own facts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import blocks
from tessera.llm.shingles import Hasher, runs, words
from tessera.session import table

#: The least run that counts; words and step of a corpus passage and of an item's, so that any such run lies within one of
#: each; words, step and bounded number of documents for the fit of the space.
RUN, WINDOW, STEP, ITEM_WINDOW, ITEM_STEP = 10, 16, 7, 12, 3
FIT_WINDOW, FIT_STEP, FIT_DOCS = 20, 10, 10_000
#: Features, rank, further columns and passes of the latent space.
FEATURES, RANK, OVER, PASSES = 1 << 14, 128, 16, 2
#: Least latent cosine of a candidate; least share of a paraphrase's words in order.
COSINE, IN_ORDER = 0.5, 0.6
#: Words of items that travel to the tasks at a time, and at all: their number is stated, larger sets are to be asked in batches.
ROUND, MOST = 100_000, 4_000_000


def _slots(h: np.ndarray) -> np.ndarray:
    return (blocks.mix(h) % np.uint64(FEATURES)).astype(np.int64)


def _windows(n: int, width: int, step: int) -> np.ndarray:
    """Starts of the passages of a text of n words; the last one reaches the end."""
    if n == 0:
        return np.zeros(0, np.int64)
    last = max(0, n - width)
    s = np.arange(0, last + 1, step)
    return s if s[-1] == last else np.append(s, last)


def _sums(x: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Sum of the rows of each passage."""
    c = np.concatenate([np.zeros((1, x.shape[1]), np.float64), np.cumsum(x, axis=0, dtype=np.float64)])
    return (c[np.minimum(starts + width, len(x))] - c[starts]).astype(np.float32)


class _Space:
    """Weights of the features and the basis of the latent space."""

    def __init__(self, idf: np.ndarray, basis: np.ndarray) -> None:
        self.idf, self.basis = idf.astype(np.float32), basis.astype(np.float32)
        self.weighed = self.basis * self.idf[:, None]
        self._padded: np.ndarray | None = None

    def passages(self, h: np.ndarray, width: int, step: int) -> tuple[np.ndarray, np.ndarray]:
        starts = _windows(len(h), width, step)
        v = _sums(self.weighed[_slots(h)], starts, width)
        n = np.linalg.norm(v, axis=1, keepdims=True)
        n[n == 0] = 1
        return starts, v / n


    def passages_of(self, hs: list[np.ndarray], width: int, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Normed passages of several texts, and the text of each."""
        start, of, end, at = [], [], [], 0
        for n, h in enumerate(hs):
            w = _windows(len(h), width, step)
            start.append(at + w)
            end.append(at + np.minimum(w + width, len(h)))
            of.append(np.full(len(w), n))
            at += len(h)
        start, end = np.concatenate(start), np.concatenate(end)
        if self._padded is None:
            self._padded = np.concatenate([self.weighed, np.zeros((1, self.weighed.shape[1]), np.float32)])
        slots = np.append(_slots(np.concatenate(hs)), len(self.weighed))  # the last one stands for words after the end
        v = np.zeros((len(start), self.weighed.shape[1]), np.float32)
        for i in range(width):
            v += self._padded[slots[np.where(start + i < end, start + i, len(slots) - 1)]]
        n = np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
        n[n == 0] = 1
        return v / n, np.concatenate(of)


def _gram(h: np.ndarray, idf: np.ndarray, omega: np.ndarray, width: int, step: int, out: np.ndarray) -> int:
    """Add ``sum a (a . omega)`` over the normed TF-IDF passages of one text to ``out``."""
    f = _slots(h)
    starts = _windows(len(h), width, step)
    if not len(starts):
        return 0
    idx = np.minimum(starts[:, None] + np.arange(width)[None, :], len(h) - 1)
    live = starts[:, None] + np.arange(width)[None, :] < len(h)
    w = idf[f[idx]] * live
    n = np.sqrt((w * w).sum(1, keepdims=True))
    n[n == 0] = 1
    w /= n
    y = np.einsum("pw,pwr->pr", w, omega[f[idx]])
    np.add.at(out, f[idx].ravel(), (w[:, :, None] * y[:, None, :]).reshape(-1, omega.shape[1]))
    return len(starts)


def _corpus_gram(docs: DataFrame, idf: np.ndarray, omega: np.ndarray) -> np.ndarray:
    """The same over the whole corpus; slices of the sum meet in a shuffle, and ``FEATURES x RANK`` numbers reach the driver."""
    r, step = omega.shape[1], FEATURES // blocks.SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, hasher = np.zeros((FEATURES, r), np.float32), Hasher()
        for b in batches:
            hs = [hasher(words(t)) for t in b.column(0).to_pylist()]
            hs = [h for h in hs if len(h)]
            if not hs:
                continue
            # passages as rows of a dense block over the features that occur in the batch
            f = [_slots(h) for h in hs]
            for at in range(0, len(hs), 64):
                part = f[at : at + 64]
                used, inv = np.unique(np.concatenate(part), return_inverse=True)
                rows, cols, off = [], [], 0
                k = 0
                for x in part:
                    s = _windows(len(x), FIT_WINDOW, FIT_STEP)
                    i = np.minimum(s[:, None] + np.arange(FIT_WINDOW), len(x) - 1)
                    ok = s[:, None] + np.arange(FIT_WINDOW) < len(x)
                    rows.append(np.repeat(np.arange(k, k + len(s)), FIT_WINDOW)[ok.ravel()])
                    cols.append(inv[off + i.ravel()[ok.ravel()]])
                    k += len(s)
                    off += len(x)
                a = np.zeros((k, len(used)), np.float32)
                np.add.at(a, (np.concatenate(rows), np.concatenate(cols)), 1.0)
                a *= idf[used].astype(np.float32)
                n = np.linalg.norm(a, axis=1, keepdims=True)
                n[n == 0] = 1
                a /= n
                out[used] += a.T @ (a @ omega[used].astype(np.float32))
        for i, x in enumerate(np.split(out, blocks.SLICES)):
            if x.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["i", "x"])

    def add(g: pd.DataFrame) -> pd.DataFrame:
        s = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in g["x"])
        return pd.DataFrame({"i": [int(g["i"].iloc[0])], "x": [s.astype(np.float32).tobytes()]})

    out = np.zeros((FEATURES, r), np.float64)
    for row in docs.select("text").mapInArrow(run, "i INT, x BINARY").groupBy("i").applyInPandas(add, "i INT, x BINARY").collect():
        out[row["i"] * step : (row["i"] + 1) * step] = np.frombuffer(row["x"], np.float32).reshape(step, r)
    return out


def latent_space(docs: DataFrame, items: list[np.ndarray], seed: int = 5) -> _Space:
    """Weights from all documents; basis by a randomised SVD of the passages of ``FIT_DOCS`` documents, chosen by their
    hash, and, with equal total weight, those of the items."""
    hasher = Hasher()

    def seen(b: pa.RecordBatch) -> np.ndarray:
        got = [_slots(hasher(words(t))) for t in b.column(0).to_pylist()]
        pair = np.unique(np.concatenate([np.repeat(np.arange(len(got)), [len(g) for g in got]) * FEATURES + np.concatenate(got)])) if got else np.zeros(0, np.int64)
        return np.concatenate([pair % FEATURES, np.full(len(got), FEATURES)]).astype(np.int64)

    df = blocks.counts(docs.select("text"), seen, 2 * FEATURES)
    idf = np.log((1 + df[FEATURES]) / (1.0 + df[:FEATURES])) + 0.05
    rate = min(1.0, FIT_DOCS / max(1, df[FEATURES]))
    some = docs.filter(F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1 << 30)) < int(rate * (1 << 30)))
    omega = np.random.default_rng(seed).standard_normal((FEATURES, RANK + OVER))
    for _ in range(PASSES):
        z = _corpus_gram(some, idf, omega)
        own = np.zeros_like(z)
        for h in items:
            _gram(h, idf, omega, RUN, 1, own)
        z = z / max(1e-12, np.linalg.norm(z)) + own / max(1e-12, np.linalg.norm(own))
        omega, _, _ = np.linalg.svd(z, full_matrices=False)  # in the order of their weight
    return _Space(idf, omega[:, :RANK])


def longest_run(a: np.ndarray, b: np.ndarray) -> int:
    """Most consecutive words that two texts share."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        m = (lo + hi + 1) // 2
        if len(np.intersect1d(runs(a, m), runs(b, m))):
            lo = m
        else:
            hi = m - 1
    return lo


def longest_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Most words that two texts share in order."""
    best = np.zeros(len(b) + 1, np.int64)
    for x in a:
        step = np.where(b == x, best[:-1] + 1, 0)
        new = best.copy()
        new[1:] = np.maximum(new[1:], step)
        best = np.maximum.accumulate(new)
    return int(best[-1])


def _facts(ws: list[str], h: np.ndarray, space: _Space) -> np.ndarray:
    """The words that an item is about: numbers, and its third with the greatest weight."""
    w = space.idf[_slots(h)]
    cut = np.sort(w)[::-1][max(0, len(w) // 3 - 1)] if len(w) else 0
    return np.unique(h[(w >= cut) | np.array([x[0].isdigit() for x in ws], bool)]) if len(h) else h


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, run, in_order, facts, kind`` of every document that holds an item or a passage of one.

    docs: ``doc_id, text`` of all documents; items: ``item_id, text``, a held-out set of bounded size. run: longest common
    run of words; in_order: share of the item's words found in order in the passage around; kind: ``exact`` from ten words,
    ``paraphrase`` where most words come in order and all facts of the item are there. Null, empty and short texts have no
    leaks; repeated documents are treated each for itself; no items give no rows.
    """
    hasher, rows, total = Hasher(), [], 0
    for r in items.filter("text is not null").select("item_id", "text").toLocalIterator():
        w = words(r[1])
        total += len(w)
        if total > MOST:
            raise ValueError(f"the items have more than {MOST} words; ask for them in batches")
        if w:
            rows.append((r[0], w, hasher(w)))
    schema = "doc_id BIGINT, item_id BIGINT, run INT, in_order DOUBLE, facts DOUBLE, kind STRING"
    if not rows:
        return docs.sparkSession.createDataFrame([], schema)
    space = latent_space(docs, [h for _, _, h in rows])
    ends = np.cumsum([len(h) for _, _, h in rows]) // ROUND
    found = None
    for n in np.unique(ends):  # the space is the same in all rounds
        some = docs.select("doc_id", "text").mapInArrow(_search(space, [r for r, e in zip(rows, ends, strict=True) if e == n]), schema)
        found = some if found is None else found.unionByName(some)
    return found


def _search(space: _Space, rows: list[tuple[int, list[str], np.ndarray]]):
    vectors = [space.passages(h, ITEM_WINDOW, ITEM_STEP)[1] for _, _, h in rows]
    wanted, owner = np.ascontiguousarray(np.concatenate(vectors).T), np.repeat(np.arange(len(rows)), [len(v) for v in vectors])
    ids, texts = [r[0] for r in rows], [r[2] for r in rows]
    tens = [runs(h, RUN).tolist() for h in texts]
    facts = [_facts(w, h, space).tolist() for _, w, h in rows]
    weighed, idf = space.weighed, space.idf

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, s = Hasher(), _Space.__new__(_Space)
        s.weighed, s.idf, s._padded = weighed, idf, None
        for b in batches:
            docs_ids = b.column(0).to_pylist()
            out = []
            for at in range(0, b.num_rows, 256):
                part = [(d, h) for d, t in zip(docs_ids[at : at + 256], b.column(1)[at : at + 256].to_pylist(), strict=True) if len(h := hasher(words(t)))]
                if not part:
                    continue
                v, of = s.passages_of([h for _, h in part], WINDOW, STEP)
                hits = []
                for k in range(0, len(v), 512):
                    p, n = np.divmod(np.flatnonzero((v[k : k + 512] @ wanted).ravel() >= COSINE), wanted.shape[1])
                    hits.append(np.unique(of[k + p] * len(ids) + owner[n]))
                now, run_set, word_set = -1, set(), set()
                for x in np.unique(np.concatenate(hits)).tolist():
                    d, i = divmod(x, len(ids))
                    h = part[d][1]
                    if d != now:
                        now, run_set, word_set = d, set(runs(h, RUN).tolist()), set(h.tolist())
                    exact = any(x in run_set for x in tens[i])
                    have = sum(x in word_set for x in facts[i]) / max(1, len(facts[i]))
                    if not exact and have < 1.0:
                        continue
                    share = longest_subsequence(texts[i], h) / len(texts[i])
                    if exact or share >= IN_ORDER:
                        out.append((part[d][0], ids[i], longest_run(texts[i], h), share, have, "exact" if exact else "paraphrase"))
            if out:
                c = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int32()), pa.array(c[3]), pa.array(c[4]), pa.array(c[5])], names=["doc_id", "item_id", "run", "in_order", "facts", "kind"])

    return search


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_leaks(spark, sf_dir).filter("kind = 'exact'").select("doc_id", "item_id").distinct()
