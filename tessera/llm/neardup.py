"""Near-duplicate records with small edits.

The universe of word runs is cut into segments by hashing. Two sets of sizes s and l with Jaccard at least t differ in a
bounded number of members, so of any ``s - ceil(t s) + 1`` segments a record picks at least one must agree with the other
record: the pigeonhole. The cost-based allocation picks the segments that hold one member each and are rarest in the
collection, by counters over all records; both sides pick by the same order, so they pick a common one. The size band of a
posting, its place in the order and a 128-bit map of the set's members give three more bounds that can only drop pairs
under the threshold. What is left is verified on the full sets.

Exact copies (equal sets) are collapsed first; a key shared by very many records is cut into row blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import blocks
from tessera.llm.graph import components
from tessera.llm.shingles import Hasher, batch_sets, runs, words
from tessera.session import cut, stored, table

#: ``at``: place in the order as a share of the size, rounded down.
_POST = np.dtype([("cell", "<u4"), ("row", "<i8"), ("m0", "<u8"), ("m1", "<u8"), ("size", "<u4"), ("at", "<u2"), ("side", "u1")])
_FULL = 65_536


class Measure:
    """How records are compared: run length in words, threshold ``num / den``, least number of words."""

    def __init__(self, run: int = 3, num: int = 3, den: int = 5, least_words: int = 20) -> None:
        if not 0 < num <= den or run < 1:
            raise ValueError("0 < num <= den and run >= 1 must hold")
        self.run, self.num, self.den, self.least_words = run, num, den, max(least_words, run)

    def reach(self, a, b):
        """Whether an overlap of ``o`` suffices is ``o * (num + den) >= num * (a + b)``; this is the right side."""
        return self.num * (a + b)


#: Production parameters: five words and 0.8 are the default; the found query is defined on three words and 0.6.
DEFAULT, FOUND = Measure(5, 4, 5, 5), Measure()


#: Members of a set as planned for, and bytes that a record's postings take.
_MEMBERS, _BYTES = 64, 1024


def _slot(x: np.ndarray, sketch: int) -> np.ndarray:
    return (blocks.mix(x) % np.uint64(sketch)).astype(np.int64)


def _starts(rec: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(rec, np.arange(n))


def _read(texts: DataFrame, m: Measure, sketch: int) -> DataFrame:
    """One pass over all versions as they lie: ``key, id, src, u, digest`` of each with enough words, the digest standing
    for its set; and, in rows with ``slice``, counters of the members of all sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, c, kind = Hasher(), np.zeros(sketch, np.int64), None
        for b in batches:
            kind = b.schema.field(0).type
            at, rec, r = batch_sets(b.column(1).to_pylist(), m.run, m.least_words, hasher)
            if sketch <= 8 * len(r):
                c += np.bincount(_slot(r, sketch), minlength=sketch)
            else:
                np.add.at(c, _slot(r, sketch), 1)
            d, ok = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, bool)
            if len(at):
                start = _starts(rec, len(at))
                x = np.add.reduceat(blocks.mix(r), start) ^ (np.add.reduceat(blocks.mix(r + np.uint64(1)), start) >> np.uint64(7))
                d[at], ok[at] = x.astype(np.int64), True
            none = pa.nulls(b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(d), pa.array(ok), none.cast(pa.int32()), none.cast(pa.binary())], names=["n", "digest", "ok", "slice", "c"])
        k, x = blocks.sliced(c)
        if k and kind is not None:
            none = pa.nulls(len(k))
            yield pa.RecordBatch.from_arrays([none.cast(kind), none.cast(pa.int64()), none.cast(pa.bool_()), pa.array(k, pa.int32()), pa.array(x, pa.binary())], names=["n", "digest", "ok", "slice", "c"])

    out = "n STRUCT<key: BIGINT, id: STRING, src: INT, u: TIMESTAMP_NTZ>, digest BIGINT, ok BOOLEAN, slice INT, c BINARY"
    return texts.select(F.struct("key", "id", "src", "u").alias("n"), "text").mapInArrow(run, out).select("n.*", "digest", "ok", "slice", "c")


def _postings(texts: DataFrame, m: Measure, size: np.ndarray, rows: int) -> DataFrame:
    parts = blocks.parts_of(texts, rows * _BYTES)
    mean, over = blocks.hot_over(size, blocks.HOT)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            at, rec, r = batch_sets(b.column(1).to_pylist(), m.run, m.least_words, hasher)
            if not len(at):
                continue
            keys = np.asarray(b.column(0))[at]
            start = _starts(rec, len(at))
            card = np.diff(np.append(start, len(rec)))
            bit = np.uint64(1) << (r & np.uint64(63))
            upper = (r & np.uint64(64)) > 0
            zero = np.uint64(0)
            m0, m1 = np.bitwise_or.reduceat(np.where(upper, zero, bit), start), np.bitwise_or.reduceat(np.where(upper, bit, zero), start)
            n = size[_slot(r, len(size))].astype(np.int64)
            o = np.lexsort((r, n, rec))  # rarest first
            place = np.arange(len(r)) - start[rec]  # rec is sorted either way
            pick = place < (card - -(-card * m.num // m.den) + 1)[rec]
            r, n, rec, place = r[o][pick], n[o][pick], rec[pick], place[pick]
            idx, cell, side = blocks.spread(r, keys[rec], n, blocks.HOT, mean, over)
            who = rec[idx]
            x = np.empty(len(idx), _POST)
            x["cell"], x["row"], x["m0"], x["m1"], x["side"] = blocks.short(cell), keys[who], m0[who], m1[who], side
            x["size"], x["at"] = card[who], place[idx] * _FULL // card[who]
            yield blocks.pack(cell, x, parts)

    return blocks.by_part(texts.select("key", "text").mapInArrow(post, "part INT, rows BINARY"))


def _candidates(postings: DataFrame, m: Measure) -> DataFrame:
    """``a, b``: pairs of rows that share a picked segment and pass the bounds."""
    total = m.num + m.den

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in blocks.unpacked(batches, _POST):
            order, start, end = blocks.groups(x["cell"])
            x = x[order]
            size = x["size"].astype(np.int64)
            at = x["at"].astype(np.int64) * size // _FULL  # at most the true place
            found = []
            for i, j in blocks.pairs_of(start, end):
                s, t = size[i], size[j]
                ok = (m.den * np.minimum(s, t) >= m.num * np.maximum(s, t)) & (x["row"][i] != x["row"][j])
                ok &= ((x["side"][i] & 2) == 0) | ((x["side"][i] & 1) != (x["side"][j] & 1))
                ok &= np.minimum(s - at[i], t - at[j]) * total >= m.reach(s, t)
                i, j = i[ok], j[ok]
                s, t = size[i], size[j]
                apart = np.bitwise_count(x["m0"][i] ^ x["m0"][j]).astype(np.int64) + np.bitwise_count(x["m1"][i] ^ x["m1"][j])
                ok = (s + t - apart) * total >= 2 * m.reach(s, t)
                a, b = x["row"][i[ok]], x["row"][j[ok]]
                found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
            if found:
                p = np.unique(np.concatenate(found), axis=0)
                for k in range(0, len(p), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(p[k : k + 100_000, 0]), pa.array(p[k : k + 100_000, 1])], names=["a", "b"])

    return postings.mapInArrow(meet, "a BIGINT, b BIGINT").distinct()


class NearDuplicates:
    """Classes of equal sets, and the similar pairs between their representatives.

    versions: ``id, src, u, text``; of the versions of an id the greatest ``(src, u)`` counts. ``copies``: ``key, id, rep,
    rep_id`` of every id with enough words, where ``rep`` stands for its class. ``pairs``: ``a, b, similarity`` of
    representatives. Null and short texts take no part; no texts give no rows; any further columns are ignored.
    """

    def __init__(self, versions: DataFrame, m: Measure = DEFAULT) -> None:
        t = versions.filter("id is not null and text is not null").select(blocks.id_hash("id").alias("key"), "id", "src", "u", "text")
        rows = versions.count()
        sketch = blocks.sketch_of(rows * _MEMBERS)
        read = stored(_read(t, m, sketch))
        size = blocks.added(read.filter("slice is not null").select(F.col("slice").alias("i"), "c"), sketch)
        size = np.minimum(size, np.iinfo(np.int32).max).astype(np.int32)
        top = read.filter("slice is null").groupBy("key", "id").agg(F.max_by(F.struct("src", "u", "digest", "ok"), F.struct("src", "u", "digest")).alias("r"))
        sig = stored(top.filter("r.ok").select("key", "id", "r.src", "r.u", "r.digest"))
        rep = sig.groupBy("digest").agg(F.min(F.struct("id", "key")).alias("x"), F.count("*").alias("c")).select("digest", F.col("x.key").alias("rep"), F.col("x.id").alias("rep_id"), "c")
        self.copies = stored(sig.join(rep, "digest").select("key", "id", "src", "u", "rep", "rep_id", "c"))
        chosen = self.copies.filter("key = rep").select("key", F.col("src").alias("s"), F.col("u").alias("v"))
        # the text of each representative, once, placed by key for both the postings and the verification
        placed = t.select("key", "src", "u", "text").repartition("key")
        self.texts = placed.join(chosen, "key").filter("src = s and u <=> v").groupBy("key").agg(F.max("text").alias("text"))
        cand = _candidates(_postings(self.texts, m, size, rows), m)
        self.pairs = self._verify(cand, m)

    def _verify(self, cand: DataFrame, m: Measure) -> DataFrame:
        a = cand.join(self.texts.select(F.col("key").alias("a"), F.col("text").alias("ta")), "a")
        ab = a.join(self.texts.select(F.col("key").alias("b"), F.col("text").alias("tb")), "b")

        @F.pandas_udf("double")
        def similarity(x: pd.Series, y: pd.Series) -> pd.Series:
            hasher, kept = Hasher(), {}

            def members(t: str) -> np.ndarray:
                if t not in kept:
                    if len(kept) > 2000:
                        kept.clear()
                    kept[t] = np.unique(runs(hasher(words(t)), m.run))
                return kept[t]

            out = []
            for s, t in zip(x, y, strict=True):
                p, q = members(s), members(t)
                o = len(np.intersect1d(p, q, assume_unique=True))
                n = len(p) + len(q) - o
                out.append(o / n if o * m.den >= m.num * n else 0.0)
            return pd.Series(out, dtype="float64")

        return ab.select("a", "b", similarity("ta", "tb").alias("similarity")).filter("similarity > 0")


def id_pairs(nd: NearDuplicates) -> DataFrame:
    """``id_a, id_b`` of all similar ids, copies included. Its size is that of the answer, so quadratic in a class of copies."""
    c = nd.copies
    big = c.filter("c > 1").select("rep", "id")
    inside = big.select("rep", F.col("id").alias("x")).join(big.select("rep", F.col("id").alias("y")), "rep").filter("x < y").select("x", "y")
    m = c.select("rep", "id")
    across = nd.pairs.join(m.select(F.col("rep").alias("a"), F.col("id").alias("x")), "a").join(m.select(F.col("rep").alias("b"), F.col("id").alias("y")), "b").select("x", "y")
    return inside.unionByName(across).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def groups(nd: NearDuplicates) -> DataFrame:
    """``id, group_id, links``: every id of a group, named by its least id, with the number of similar ids."""
    pairs = cut(nd.pairs.select("a", "b"))
    size = nd.copies.select("rep", "c").distinct()
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = both.join(size.select(F.col("rep").alias("b"), "c"), "b").groupBy("a").agg(F.sum("c").alias("n"))
    comp = components(pairs, "a", "b")
    j = nd.copies.join(links.withColumnRenamed("a", "rep"), "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    j = j.select("id", F.coalesce("component", "rep").alias("g"), (F.col("c") - 1 + F.coalesce("n", F.lit(0))).alias("links")).filter("links > 0")
    name = j.groupBy("g").agg(F.min("id").alias("group_id"))
    return j.join(name, "g").select("id", "group_id", "links")


def record_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of an id is its chunk's, else the document of its live row; a live row without document gives none."""
    none = F.lit(None).cast("timestamp_ntz")
    c = table(spark, sf_dir, "chunks").select("id", F.lit(1).alias("src"), none.alias("u"), "text")
    s = table(spark, sf_dir, "stored_records").select("id", F.lit(0).alias("src"), F.col("updated_at").alias("u"), F.coalesce("document", F.lit("")).alias("text"))
    return c.unionByName(s)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_pairs(NearDuplicates(record_texts(spark, sf_dir), FOUND))


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(NearDuplicates(record_texts(spark, sf_dir), DEFAULT))
