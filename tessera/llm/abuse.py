"""Abusive, hateful or sexual content, scored from labelled examples.

A document is as bad as its worst sentence. Sentences are undisguised (leet, spaced, stretched and masked spellings),
weighed by TF-IDF over all documents, and compared by exact cosine with the sentences of labelled documents; neighbours
vote by distance. Labels hold for documents, so the votes that examples cast among themselves first tell which sentences
of a labelled document its verdict rests on. The inverted index keeps the greatest weight of each feature in each block of
examples; a block is opened only while its bound can still change the vote.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import blocks
from tessera.llm.mixing import plain_source
from tessera.session import table

#: Bounds of the fitted sample: labelled documents, chosen by hash of their id, and code points of their texts.
MAX_LABELLED, MAX_SIGNS = 20_000, 64_000_000
#: Features, neighbours, least cosine of a neighbour, power of the distance weight, prior votes and their share of bad.
FEATURES, NEIGHBOURS, NEAR, POWER, PRIOR, PRIOR_BAD = 1 << 18, 9, 0.32, 3.0, 0.12, 0.02
BLOCK = 32
#: Fewest words of a sentence that can be judged; most votes that equal sentences have together.
LEAST_WORDS, MOST_VOTES = 3, 4
#: A sentence is blamed for a verdict that no neighbour explains if it is this far from all good ones and its third most
#: usual pair of words is in no more than this share of all sentences.
STRANGE, USUAL = 0.3, 0.001
#: Share of verdicts taken to be wrong; least score of a bad document.
WRONG, BAD_FROM = 0.05, 0.6
BAD = ("abusive", "hateful", "sexual")
#: Digits and signs that stand for letters.
LEET = str.maketrans("01345789$@!", "oieastbgsai")

_INVISIBLE = re.compile("[" + "".join(c for c in map(chr, range(0x80, 0x10000)) if unicodedata.category(c) in ("Mn", "Cf")) + "]+")
_LEET_WORD = re.compile(r"(?<![\w$@-])(?=[a-z0-9$@!]*[a-z])(?=[a-z0-9$@!]*[0-9$@])[a-z0-9$@!]*[a-z0-9$@](?![\w-])")
_SPACED = re.compile(r"(?<![\w])[a-z](?:([.\-_ ])[a-z])(?:\1[a-z]){2,}(?![\w])")
_STRETCHED = re.compile(r"([a-z])\1{2,}")
_MASKED = re.compile(r"([a-z])\*+([a-z]*)")
_SPLIT = re.compile(r"(?<=[.!?])[\"')\]]*\s+|\n\s*\n|\n(?=\s*(?:[-*•]|\d+[.)]|[qa]:)\s)|(?<=[:;])\n")
_SHORT = re.compile(r"\b(approx|aprox|ca|cf|fig|figs|pag|pp|vgl|bzw|nr|no|vs|etc)\.[ \t]*(?=[\da-z(])")
_TOKEN = re.compile(r"[^\W\d_]+(?:\*[^\W\d_]*)?|\d+")


def undisguised(text: str) -> str:
    """Lower case without accents and invisible signs; leet, stretched, spaced-out and starred words in one plain form."""
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKD", text))
    t = text.lower().replace("\r\n", "\n").replace("\r", "\n")
    t = _SPACED.sub(lambda m: m[0].replace(m[1], ""), t)
    t = _LEET_WORD.sub(lambda m: m[0].translate(LEET), t)
    t = _STRETCHED.sub(r"\1", t)
    return _MASKED.sub(r"\1*\2", t)


def sentences(text: str | None) -> list[list[str]]:
    """Words of each sentence; a line without an end mark is taken alone and together with the next. Numbers are one word."""
    if not text:
        return []
    out = []
    parts = _SPLIT.split(_SHORT.sub(r"\1 ", undisguised(text)))
    for s in [*parts, *(line for p in parts if "\n" in p for line in p.split("\n"))]:
        w = ["#" if x[0].isdigit() else x for x in _TOKEN.findall(s)]
        while len(w) > 1 and w[0] in ("q", "a", "#"):
            w = w[1:]
        if sum(x != "#" for x in w) >= LEAST_WORDS:
            out.append(w)
    return out


class Features:
    """Hashed words and neighbouring words of a sentence, by slot."""

    def __init__(self) -> None:
        self._seen: dict[str, int] = {}

    def _slot(self, x: str) -> int:
        s = self._seen.get(x)
        if s is None:
            if len(self._seen) > 400_000:
                self._seen.clear()
            s = self._seen[x] = xxhash.xxh64_intdigest(x) % FEATURES
        return s

    def __call__(self, w: list[str]) -> np.ndarray:
        f = {self._slot(x) for x in w}
        f.update(self.pairs(w))
        return np.fromiter(f, np.int64, len(f))

    def pairs(self, w: list[str]) -> list[int]:
        return [self._slot(f"{a} {b}") for a, b in zip(w, w[1:], strict=False)]


class Weights:
    def __init__(self, counted: np.ndarray) -> None:
        n = max(1, int(counted[FEATURES]))
        self.n, self.count = n, counted[:FEATURES].astype(np.int32)
        self.idf = np.log1p(n / (counted[:FEATURES] + 12.0)).astype(np.float32)

    def unusual(self, pairs: list[int]) -> bool:
        return len(pairs) > 2 and float(np.sort(self.idf[pairs])[2]) >= np.log1p(1 / USUAL) - 0.2

    def __call__(self, f: np.ndarray) -> np.ndarray:
        w = self.idf[f]
        return w / (np.linalg.norm(w) or 1.0)


def weights(docs: DataFrame) -> Weights:
    """Sentence frequencies of all features over all documents."""

    def seen(b: pa.RecordBatch) -> np.ndarray:
        fs, out = Features(), [np.zeros(0, np.int64)]
        for t in b.column(0).to_pylist():
            for w in sentences(t):
                out.append(np.append(fs(w), FEATURES))
        return np.concatenate(out)

    return Weights(blocks.counts(docs.select("text"), seen, 2 * FEATURES))


class Index:
    """Examples with their features: blocks of similar ones, and for each feature its greatest weight per block.

    Equal sentences are one example with ``count`` documents, ``bad`` of them bad.
    """

    def __init__(self, examples: list[tuple[np.ndarray, np.ndarray]], bad: np.ndarray, count: np.ndarray) -> None:
        self.n = len(examples)
        # bad ones first; then by the heaviest features, so that a block holds one kind of sentence
        lead = [tuple(f[np.argsort(-w, kind="stable")[:3]].tolist()) for f, w in examples]
        self.order = np.array(sorted(range(self.n), key=lambda i: (bad[i] < 0.5 * count[i], lead[i])), np.int64)
        self.place = np.empty(self.n, np.int64)
        self.place[self.order] = np.arange(self.n)
        self.bad, self.count = bad[self.order].astype(np.float64), count[self.order].astype(np.float64)
        examples = [examples[i] for i in self.order]
        size = np.array([len(f) for f, _ in examples], np.int64)
        self.start = np.concatenate([[0], np.cumsum(size)])
        self.feature = np.concatenate([f for f, _ in examples]).astype(np.int32) if self.n else np.zeros(0, np.int32)
        self.weight = np.concatenate([w for _, w in examples]).astype(np.float32) if self.n else np.zeros(0, np.float32)
        self.blocks = -(-self.n // BLOCK)
        at = np.repeat(np.arange(self.n) // BLOCK, size)
        order = np.lexsort((at, self.feature))
        f, b, w = self.feature[order], at[order], self.weight[order]
        edge = np.flatnonzero(np.concatenate([[True], (f[1:] != f[:-1]) | (b[1:] != b[:-1])])) if len(f) else np.zeros(0, np.int64)
        self.top = np.maximum.reduceat(w, edge) if len(f) else w
        self.top_block, tf = b[edge].astype(np.int32), f[edge]
        self.slots, first = np.unique(tf, return_index=True)
        self.first, self.last = first, np.append(first[1:], len(tf)).astype(np.int64)
        # examples of which any share is bad: the features that they have at all, and their number
        self.suspect = np.flatnonzero(self.bad > 0)
        m = self.start[self.suspect + 1] - self.start[self.suspect] if self.n else np.zeros(0, np.int64)
        self.suspect_off = np.concatenate([[0], np.cumsum(m)[:-1]]).astype(np.int64) if len(m) else np.zeros(0, np.int64)
        k = np.repeat(self.start[self.suspect] - self.suspect_off, m) + np.arange(m.sum()) if len(m) else np.zeros(0, np.int64)
        self.suspect_feature, self.suspect_weight = self.feature[k], self.weight[k]
        self.suspect_top = np.zeros(FEATURES, np.float16)
        np.maximum.at(self.suspect_top, self.suspect_feature, (self.suspect_weight * 1.002).astype(np.float16))
        self._dense: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_dense": None}

    def near(self, f: np.ndarray, w: np.ndarray, skip: int = -1, only_bad: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The nearest examples (index, cosine) with at least ``NEAR``, without the one to skip.

        Exact: blocks are opened by falling bound until none can hold a nearer one. With ``only_bad`` nothing is returned
        where no example with any share of bad is a neighbour, as the vote then is the prior.
        """
        none = np.zeros(0, np.int64), np.zeros(0, np.float32)
        if self._dense is None:
            self._dense = np.zeros(FEATURES, np.float32)
        if only_bad:
            # all suspects as one block: its bound first, then their cosines; below NEAR the vote is the prior
            if float(self.suspect_top[f].astype(np.float32) @ w) < NEAR:
                return none
            self._dense[f] = w
            c = np.add.reduceat(self._dense[self.suspect_feature] * self.suspect_weight, self.suspect_off)
            self._dense[f] = 0.0
            if c.max() < NEAR:
                return none
        at = np.searchsorted(self.slots, f)
        ok = at < len(self.slots)
        ok[ok] = self.slots[at[ok]] == f[ok]
        if not ok.any():
            return none
        at, q = at[ok], w[ok]
        a, n = self.first[at], self.last[at] - self.first[at]
        idx = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        bound = np.bincount(self.top_block[idx], weights=np.repeat(q, n) * self.top[idx], minlength=self.blocks)
        open_ = np.flatnonzero(bound >= NEAR)
        open_ = open_[np.argsort(-bound[open_], kind="stable")]
        self._dense[f] = w
        got_i, got_c, kth, step, p = [], [], NEAR, 4, 0
        while p < len(open_) and bound[open_[p]] >= kth:
            take = open_[p : p + step]
            rows = (take[:, None] * BLOCK + np.arange(BLOCK)[None, :]).ravel()
            rows = rows[rows < self.n]
            s, m = self.start[rows], self.start[rows + 1] - self.start[rows]
            off = np.concatenate([[0], np.cumsum(m)[:-1]])
            k = np.repeat(s - off, m) + np.arange(m.sum())
            c = np.add.reduceat(self._dense[self.feature[k]] * self.weight[k], off)
            keep = c >= NEAR
            keep &= rows != skip
            got_i.append(rows[keep])
            got_c.append(c[keep])
            p, step = p + step, step * 2
            all_c = np.concatenate(got_c)
            if len(all_c) >= NEIGHBOURS:
                kth = max(NEAR, float(np.partition(all_c, -NEIGHBOURS)[-NEIGHBOURS]))
        self._dense[f] = 0.0
        if not got_i:
            return none
        i, c = np.concatenate(got_i), np.concatenate(got_c)
        o = np.lexsort((i, -c))[:NEIGHBOURS]
        return i[o], c[o]


def vote(bad: np.ndarray, count: np.ndarray, cosine: np.ndarray) -> float:
    """Share of bad among the documents behind the neighbours, by distance, with a small prior."""
    n = np.minimum(count, MOST_VOTES)
    w = cosine.astype(np.float64) ** POWER * n
    return float(((w * bad / np.maximum(count, 1e-9)).sum() + PRIOR * PRIOR_BAD) / (w.sum() + PRIOR))


def monotone(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic fit (pool adjacent violators): where each pool begins, and its level."""
    o = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b in zip(x[o], y[o], strict=True):
        pools.append([b, 1.0, a])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, n, _ = pools.pop()
            u = pools[-1]
            u[0], u[1] = (u[0] * u[1] + v * n) / (u[1] + n), u[1] + n
    return np.array([p[2] for p in pools]), np.array([p[0] for p in pools])


def document_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, bad``: share of bad among the usable verdicts of a document; repeated rows count once, unsure and null not."""
    v = labels.filter(F.col("verdict").isin(*BAD, "none")).select("doc_id", "reviewer", "verdict").distinct()
    return v.groupBy("doc_id").agg(F.avg((F.col("verdict") != "none").cast("double")).alias("bad"))


def _bounded(labelled: DataFrame) -> list:
    """The rows in the order of their hash as long as their texts together stay within ``MAX_SIGNS``; whole texts only."""
    labelled = labelled.withColumn("h", F.xxhash64("doc_id"))
    left, ids = MAX_SIGNS, []
    for r in sorted(labelled.select("h", "doc_id", F.length("text").alias("n")).collect()):  # numbers of a bounded sample
        left -= r["n"]
        if left < 0:
            break
        ids.append(r["doc_id"])
    return labelled.drop("h").join(F.broadcast(labelled.sparkSession.createDataFrame([(i,) for i in ids], "doc_id BIGINT")), "doc_id", "left_semi").collect() if left < 0 else labelled.drop("h").collect()


class Model:
    """Index of purified examples and the calibration of its votes."""

    def __init__(self, docs: DataFrame, labels: DataFrame) -> None:
        self.weights = weights(docs)
        chosen = document_labels(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
        rows = _bounded(docs.select("doc_id", "text").join(chosen, "doc_id").filter("text is not null").dropDuplicates(["doc_id"]))
        fs, number = Features(), {}
        examples: list[tuple[np.ndarray, np.ndarray]] = []
        odd: list[bool] = []
        often: list[float] = []
        members: dict[int, list[int]] = {}
        truth: dict[int, float] = {}
        for r in sorted(rows, key=lambda r: r["doc_id"]):
            truth[r["doc_id"]] = r["bad"]
            own = members.setdefault(r["doc_id"], [])
            for w in sentences(r["text"]):
                key = tuple(w)
                if key not in number:
                    number[key] = len(examples)
                    f = fs(w)
                    examples.append((f, self.weights(f)))
                    pairs = fs.pairs(w)
                    odd.append(self.weights.unusual(pairs))
                    often.append(float(np.median(self.weights.count[pairs])) if pairs else 0.0)
                if number[key] not in own:
                    own.append(number[key])
        of_doc = np.repeat(np.array(list(members), np.int64), [len(m) for m in members.values()]) if members else np.zeros(0, np.int64)
        of_ex = np.array([i for m in members.values() for i in m], np.int64)
        y = np.array([truth[d] for d in of_doc], np.float64)
        n = len(examples)
        count = np.bincount(of_ex, minlength=n).astype(np.float64)
        raw = Index(examples, np.bincount(of_ex, weights=y, minlength=n), count)
        near = self._among(docs, raw)
        y, votes = self._purified(raw, near, of_doc, of_ex, np.array(odd, bool), np.array(often), len(of_ex) / self.weights.n, truth)
        self.index = Index(examples, np.bincount(of_ex, weights=y, minlength=n), count)
        score = dict.fromkeys(truth, 0.0)
        for d, v in zip(of_doc.tolist(), votes.tolist(), strict=True):
            score[d] = max(score[d], v)
        known = [d for d in truth if truth[d] != 0.5]
        x = np.array([score[d] for d in known])
        self.steps, self.values = monotone(x, np.array([float(truth[d] > 0.5) for d in known])) if known else (np.zeros(0), np.zeros(0))

    @staticmethod
    def _among(docs: DataFrame, raw: Index) -> list[tuple[np.ndarray, np.ndarray]]:
        """Neighbours of every example besides itself, found on the executors; a bounded list per bounded example."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at, js, cs = [], [], []
                for i in b.column(0).to_pylist():
                    s = slice(raw.start[i], raw.start[i + 1])
                    j, c = raw.near(raw.feature[s].astype(np.int64), raw.weight[s], i, only_bad=False)
                    at.append(i)
                    js.append(j.astype(np.int32).tobytes())
                    cs.append(c.astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(js, pa.binary()), pa.array(cs, pa.binary())], names=["i", "j", "c"])

        out = [(np.zeros(0, np.int64), np.zeros(0, np.float32))] * raw.n
        if raw.n:
            parts = min(64, max(1, raw.n // 500))
            for r in docs.sparkSession.range(0, raw.n, 1, parts).mapInArrow(run, "i BIGINT, j BINARY, c BINARY").collect():
                out[r["i"]] = np.frombuffer(r["j"], np.int32).astype(np.int64), np.frombuffer(r["c"], np.float32)
        return out

    @staticmethod
    def _purified(raw: Index, near: list, of_doc: np.ndarray, of_ex: np.ndarray, odd: np.ndarray, often: np.ndarray, sampled: float, truth: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
        """Which sentences a bad verdict rests on: those whose neighbours come from bad documents; without any, the strangest.

        Reviewers see bad documents more often than others. A sentence that is frequent in the corpus, but was seen with one
        bad verdict only, is therefore no bad one: that verdict is among the wrong ones (a share ``WRONG``).

        Returns the label of each (document, example) and its vote without the document's own share.
        """
        place = raw.place[of_ex]
        y = np.array([truth[d] for d in of_doc.tolist()], np.float64)
        groups = np.flatnonzero(np.concatenate([[True], of_doc[1:] != of_doc[:-1], [True]])) if len(of_doc) else np.zeros(1, np.int64)
        votes = np.zeros(len(y))
        # the neighbours of each label one after the other, itself last, and which labels of the same document they bear
        at = {(d, e): k for k, (d, e) in enumerate(zip(of_doc.tolist(), place.tolist(), strict=True))}
        near_of = [np.append(near[e][0], e) for e in place.tolist()]
        j = np.concatenate(near_of) if near_of else np.zeros(0, np.int64)
        cosine = np.concatenate([np.append(near[e][1].astype(np.float64), 1.0) for e in place.tolist()]) if near_of else np.zeros(0)
        start = np.cumsum([0, *(len(x) for x in near_of[:-1])]) if near_of else np.zeros(0, np.int64)
        own = np.array([at.get((d, x), -1) for d, xs in zip(of_doc.tolist(), near_of, strict=True) for x in xs.tolist()], np.int64)
        mine = own >= 0
        for step in range(4 if len(y) else 0):
            bad = np.bincount(place, weights=y, minlength=raw.n)
            b, n = bad[j] - np.where(mine, y[own], 0.0), raw.count[j] - mine
            w = np.where(n > 0.5, cosine**POWER * np.minimum(n, MOST_VOTES), 0.0)
            votes = (np.add.reduceat(w * b / np.maximum(n, 1e-9), start) + PRIOR * PRIOR_BAD) / (np.add.reduceat(w, start) + PRIOR)
            strange = 1.0 - np.maximum.reduceat(np.where((n > 0.5) & (b < 0.5 * n), cosine, 0.0), start)
            if step == 3:
                break
            sure = votes >= 0.5
            shown = max(2 * sampled, sure.sum() / max(1.0, float(often[of_ex[sure]].sum()))) if sure.any() else 2 * sampled
            rare = often[of_ex] * (shown - sampled) <= np.log(shown / sampled / WRONG) if sampled else np.ones(len(of_ex), bool)
            new = np.zeros_like(y)
            for a, z in zip(groups[:-1].tolist(), groups[1:].tolist(), strict=True):
                t = truth[int(of_doc[a])]
                m = np.arange(a, z)
                if t >= 0.5:
                    hit = m[votes[a:z] >= 0.5]
                    if not len(hit) and t > 0.5:
                        can = np.where(odd[of_ex[a:z]] & rare[a:z], strange[a:z], -1.0)
                        hit = m[[int(np.argmax(can))]] if can.max() >= STRANGE else m[:0]
                    new[hit] = 1.0
                else:
                    new[m[votes[a:z] >= 0.75]] = 0.75  # a bad sentence in a document that was passed by mistake
            y = new
        return y, votes

    def calibrated(self, v: float) -> float:
        """The vote and the share of bad documents at such votes, in equal parts, as labels are few and partly wrong.

        Between two pools the lower one holds; a vote of nine in ten stands by itself.
        """
        if not len(self.steps) or v >= 0.9:
            return v
        k = int(np.searchsorted(self.steps, v, "right")) - 1
        return 0.5 * v + 0.5 * float(self.values[max(0, k)])


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, source, score, evidence``: calibrated score of every document and the sentence it rests on.

    docs: ``doc_id, text, source``; labels: ``doc_id, reviewer, verdict``. Null and empty texts score 0 without evidence.
    A labelled document's own sentences are examples like others. Without labels all scores are 0. Extra columns are ignored;
    repeated documents are scored each for itself.
    """
    m = Model(docs, labels)
    index, w = m.index, m.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = Features()
        for b in batches:
            scores, proofs = [], []
            for t in b.column(1).to_pylist():
                best, proof = 0.0, None
                for s in sentences(t) if len(index.suspect) else ():
                    f = fs(s)
                    j, c = index.near(f, w(f))
                    if not len(j):
                        continue
                    v = vote(index.bad[j], index.count[j], c)
                    if v > best:
                        best, proof = v, " ".join(s)
                p = m.calibrated(best) if best > 0 else 0.0
                scores.append(round(p, 6))
                proofs.append(proof if p > 0 else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(scores, pa.float64()), pa.array(proofs, pa.string())], names=["doc_id", "source", "score", "evidence"])

    return docs.select("doc_id", "text", "source").mapInArrow(run, "doc_id BIGINT, source STRING, score DOUBLE, evidence STRING")


def source_rates(scored: DataFrame, least: float = BAD_FROM) -> DataFrame:
    """``source, documents, bad, rate`` by plain source name; documents without a source are one group."""
    g = scored.groupBy(plain_source("source").alias("source")).agg(F.count("*").alias("documents"), F.sum((F.col("score") >= least).cast("bigint")).alias("bad"))
    return g.withColumn("rate", F.round(F.col("bad") / F.col("documents"), 6))


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "review_labels"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_scores(spark, sf_dir).filter(F.col("score") >= BAD_FROM).select("doc_id").distinct()


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_rates(p10_scores(spark, sf_dir))
