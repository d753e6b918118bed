"""Mixing sources to target weights, in blocks of tokens.

The tokens of a source are one stream, documents in pseudorandom order, cut into blocks of fixed length. Quotas of blocks
follow the targets, bounded by what a source can give when each block is used at most ``max_repeats`` times. Output shards
draw how many of their slots go to each source; a slot's number within its source is turned into a block by a pseudorandom
permutation of the source's blocks, a new one for each repetition; slots and blocks meet by index.

A token lies in one block only and a block is used at most ``max_repeats`` times, so no document is used more often.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import blocks
from tessera.operators.chunking import codec
from tessera.session import cut, table

#: Production parameters: tokens of a block, blocks of an output shard, seed.
BLOCK, SHARD, SEED = 512, 2048, 11
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def plain_source(col: str) -> Column:
    """A source name without case, outer blanks and the choice between ``_`` and ``-``."""
    return F.replace(F.lower(F.trim(F.col(col))), F.lit("_"), F.lit("-"))


def tokenized(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The documents with ``tokens`` and their number ``n`` in place of ``text``; those without tokens are left out."""

    @F.pandas_udf("array<int>")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = codec(vocabulary)
        for s in parts:
            yield pd.Series([np.asarray(e.encode(t), np.int32) for t in s.fillna("")], dtype=object)

    return docs.withColumn("tokens", encode("text")).drop("text").withColumn("n", F.size("tokens").cast("bigint")).filter("n > 0")


def source_blocks(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = BLOCK) -> DataFrame:
    """``source, block, tokens, documents``: the stream of each source, cut every ``length`` tokens; the last block is shorter.

    Offsets are counted over range partitions and shifted by the partitions before, so a source of any size is never
    in one task. Documents with equal keys follow each other by text order of their tokens.
    """
    d = docs.select(plain_source("source").alias("source"), "doc_id", F.xxhash64("doc_id", F.lit(SEED)).alias("h"), "text").filter("source is not null and text <> ''")
    # placed before they are tokenized: the bounds of the ranges are found on the plain documents
    ranged = d.repartitionByRange("source", "h", "doc_id").withColumn("part", F.spark_partition_id()).withColumn("u", F.monotonically_increasing_id())
    placed = cut(tokenized(ranged, vocabulary))
    totals = placed.groupBy("source", "part").agg(F.sum("n").alias("own"))
    before = totals.select("source", "part", (F.sum("own").over(Window.partitionBy("source").orderBy("part")) - F.col("own")).alias("before"))
    run = F.sum("n").over(Window.partitionBy("source", "part").orderBy("h", "doc_id", "u")) - F.col("n")
    at = placed.withColumn("run", run).join(before, ["source", "part"]).withColumn("at", F.col("before") + F.col("run"))
    size = F.lit(length).cast("bigint")
    first, last = F.floor(F.col("at") / size), F.floor((F.col("at") + F.col("n") - 1) / size)
    piece = at.select("source", "doc_id", "at", "n", "tokens", F.explode(F.sequence(first, last)).alias("block"))
    lo = F.greatest(F.col("block") * size - F.col("at"), F.lit(0).cast("bigint"))
    hi = F.least((F.col("block") + 1) * size - F.col("at"), F.col("n"))
    piece = piece.select("source", "block", "doc_id", F.greatest(F.col("at"), F.col("block") * size).alias("pos"), F.slice("tokens", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("tokens"))
    g = piece.groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "doc_id", "tokens"))).alias("x"))  # at most ``length`` tokens
    return g.select("source", "block", F.flatten(F.transform("x", lambda v: v["tokens"])).alias("tokens"), F.transform("x", lambda v: v["doc_id"]).alias("documents"))


def quotas(sizes: dict[str, int], targets: dict[str, tuple[float, int]], total: int) -> dict[str, int]:
    """Blocks per source: the target share of ``total``, at most ``blocks * repeats``; what a source lacks goes to the others by target."""
    cap = {s: sizes.get(s, 0) * max(0, r) for s, (_, r) in targets.items()}
    want = dict.fromkeys(targets, 0.0)
    free, left = {s for s in targets if targets[s][0] > 0 and cap[s] > 0}, float(min(total, sum(cap.values())))
    while free and left > 1e-9:
        weight = sum(targets[s][0] for s in free)
        add = {s: left * targets[s][0] / weight for s in free}
        full = {s for s in free if want[s] + add[s] >= cap[s]}
        for s in full or free:
            give = cap[s] - want[s] if s in full else add[s]
            want[s] += give
            left -= give
        if not full:
            break
        free -= full
    out = {s: int(w + 1e-9) for s, w in want.items()}
    rest = round(sum(want.values())) - sum(out.values())
    for s in sorted(out, key=lambda s: (out[s] - want[s], s)):
        if rest > 0 and out[s] < cap[s]:
            out[s] += 1
            rest -= 1
    return out


def permuted(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of ``0..n-1``: four Feistel rounds, walked until the value is below n."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask, h = np.uint64((1 << half) - 1), np.uint64(half)
    out, todo = x.astype(np.uint64), np.arange(len(x))
    while len(todo):
        v = out[todo]
        a, b = v >> h, v & mask
        for r in range(4):
            a, b = b, a ^ (blocks.mix(b + np.uint64((key * 4 + r) * 0x9E3779B1 & 0xFFFFFFFFFFFF)) & mask)
        out[todo] = a << h | b
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _plan(targets: DataFrame, sizes: DataFrame, total: int | None) -> tuple[list[str], np.ndarray, np.ndarray, dict]:
    """Sources, quotas and block counts. targets is a small table: one row per source of the mixture."""
    rows = targets.filter("source is not null").groupBy(plain_source("source").alias("source")).agg(F.sum("target_share").alias("t"), F.max("max_repeats").alias("r")).orderBy("source").limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("more than 100,000 target sources")
    goal = {r["source"]: (float(r["t"] or 0), int(r["r"] or 0)) for r in rows}
    there = {r["source"]: r["n"] for r in sizes.join(F.broadcast(sizes.sparkSession.createDataFrame([(s,) for s in goal] or [("",)], "source STRING")), "source", "left_semi").collect()}
    q = quotas(there, goal, sum(there.values()) if total is None else total)
    names = sorted(goal)
    return names, np.array([q[s] for s in names], np.int64), np.array([there.get(s, 0) for s in names], np.int64), goal


class ShardDraws:
    """How many slots of each source every shard has, found from the shard's number alone.

    Draws are made down a binary tree of shards: a node's slots fall to its two halves by a draw without replacement whose
    seed is the node, so that all shards together meet the quotas and a task needs the nodes above its shards only.
    """

    def __init__(self, quota: np.ndarray, shard: int = SHARD, seed: int = SEED) -> None:
        self.quota, self.shard, self.seed = quota.astype(np.int64), shard, seed
        self.shards = int(-(-int(quota.sum()) // shard))
        self._kept: dict[tuple[int, int], np.ndarray] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_kept": {}}

    def _drawn(self, left: np.ndarray, need: int, node: tuple[int, int]) -> np.ndarray:
        rng, draw, rest = np.random.default_rng((self.seed, *node)), np.zeros_like(left), int(left.sum())
        # one draw per source given the rest, which is exact at any size
        for i, k in enumerate(left.tolist()):
            rest -= k
            if rest + k >= 1_000_000_000:  # the generator's bound; there the two distributions do not differ measurably
                d = max(min(k, int(rng.binomial(need, k / (rest + k)))), need - rest)
            else:
                d = int(rng.hypergeometric(k, rest, need)) if need and k else 0
            draw[i], need = d, need - d
        return draw

    def __call__(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Slots of each source in shard k, and in all shards before it."""
        lo, hi, here, before = 0, self.shards, self.quota, np.zeros_like(self.quota)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            left = self._kept.get((lo, hi))
            if left is None:
                if len(self._kept) > 4096:
                    self._kept.clear()
                left = self._kept[lo, hi] = self._drawn(here, (mid - lo) * self.shard, (lo, hi))
            if k < mid:
                hi, here = mid, left
            else:
                lo, here, before = mid, here - left, before + left
        return here, before


def shard_counts(quota: np.ndarray, shard: int = SHARD, seed: int = SEED) -> np.ndarray:
    """The draws of all shards, for looking at them."""
    d = ShardDraws(quota, shard, seed)
    return np.array([d(k)[0] for k in range(d.shards)], np.int64).reshape(d.shards, len(quota))


def mixture(docs: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY, total: int | None = None, length: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """``shard, slot, source, block, repeat, n_tokens, tokens, documents``: the mixture, one row per used block.

    docs: ``doc_id, text, source``; targets: ``source, target_share, max_repeats``. Source names are compared without case,
    outer blanks and ``_`` for ``-``. total: blocks of the mixture, by default as many as the targeted sources have. Null
    and empty texts have no tokens; documents of other or null sources are not used; without targets the mixture is empty.
    """
    b = cut(source_blocks(docs, vocabulary, length))
    names, quota, size, _ = _plan(targets, b.groupBy("source").agg(F.count("*").alias("n")), total)
    draws = ShardDraws(quota, shard, seed)
    spark = docs.sparkSession

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                n, before = draws(k)
                src = np.repeat(np.arange(len(names)), n)
                g = before[src] + np.arange(len(src)) - np.repeat(np.cumsum(n) - n, n)
                rep = g // np.maximum(size[src], 1)
                block = np.empty(len(src), np.int64)
                for s, r in {*zip(src.tolist(), rep.tolist(), strict=True)}:
                    at = (src == s) & (rep == r)
                    block[at] = permuted(g[at] % size[s], int(size[s]), seed * 1_000_003 + s * 1009 + r)
                order = np.random.default_rng((seed, k)).permutation(len(src))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(src), k)), pa.array(np.arange(len(src))), pa.array([names[i] for i in src[order]], pa.string()), pa.array(block[order]), pa.array(rep[order].astype(np.int32))],
                    names=["shard", "slot", "source", "block", "repeat"],
                )

    s = spark.range(draws.shards).mapInArrow(slots, "shard BIGINT, slot BIGINT, source STRING, block BIGINT, repeat INT")
    return s.join(b, ["source", "block"]).select("shard", "slot", "source", "block", "repeat", F.size("tokens").alias("n_tokens"), "tokens", "documents")


def shares(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, target_share, actual_share, tokens, most_uses, max_repeats`` of every target; unreachable ones have share 0."""
    t = targets.filter("source is not null").groupBy(plain_source("source").alias("source")).agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    used = mix.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.max(F.col("repeat") + 1).alias("most_uses"))
    whole = used.agg(F.sum("tokens").alias("whole"))
    j = t.join(used, "source", "left").crossJoin(whole)  # one row
    n = F.coalesce("tokens", F.lit(0))
    return j.select("source", "target_share", F.round(F.coalesce(n / F.nullif(F.col("whole"), F.lit(0)), F.lit(0.0)), 6).alias("actual_share"), n.cast("bigint").alias("tokens"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"), "max_repeats")


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(p9_mixture(spark, sf_dir), table(spark, sf_dir, "mix_targets"))
