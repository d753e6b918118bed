"""Splitting texts into token-bounded chunks.

``token_windows`` stays in the JVM (words as tokens); ``recursive_chunks`` packs pieces along a list of separators in an
Arrow UDF, measured by a pluggable length function.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.interfaces import BaseChunker
from tessera.functions.ids import chunk_id

#: Separators from coarse to fine; the last one means single characters.
SEPARATORS = ("\n\n", "\n", " ", "")
_WORDS = re.compile(r"\w+|[^\w\s]|\s+")


#: Fixed value: how the tokenizer of a rank file cuts a text before merging.
BYTE_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class RegexCodec:
    """Words, single signs and runs of blanks as tokens; needs no vocabulary."""

    def encode(self, text: str) -> list[str]:
        return _WORDS.findall(text)

    def decode(self, toks: list[str]) -> str:
        return "".join(toks)


class RankCodec:
    """A byte-level BPE from a rank file (lines of base64 bytes and rank)."""

    def __init__(self, path: str, pattern: str = BYTE_PATTERN) -> None:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._e = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self._e.encode_ordinary(text)

    def decode(self, toks: list[int]) -> str:
        return self._e.decode(toks)


@lru_cache(maxsize=4)
def codec(path: str | None):
    """One codec per worker: the regex codec without a path, else the rank file's."""
    return RankCodec(path) if path else RegexCodec()


def check_sizes(size: int, overlap: int) -> None:
    if size < 1 or not 0 <= overlap < size:
        raise ValueError("0 <= overlap < size and size >= 1 must hold")


def _pieces(text: str, sep: str) -> list[str]:
    if sep == "":
        return list(text)
    parts = re.split(f"({re.escape(sep)})", text)
    return [p for p in parts if p]


def pack(pieces: list[str], lengths: list[int], size: int, overlap: int) -> list[str]:
    """Greedy runs of pieces up to the size; a new run starts with the tail of the last one, up to the overlap."""
    out: list[str] = []
    lo = hi = total = 0
    while hi < len(pieces):
        if hi > lo and total + lengths[hi] > size:
            out.append("".join(pieces[lo:hi]))
            while lo < hi and (total > overlap or total + lengths[hi] > size):
                total -= lengths[lo]
                lo += 1
        total += lengths[hi]
        hi += 1
    if hi > lo:
        out.append("".join(pieces[lo:hi]))
    return out


def window_tokens(toks: list, size: int, overlap: int) -> list[list]:
    """Windows of ``size`` tokens, each ``size - overlap`` further on; the last one reaches the end."""
    starts = range(0, max(1, len(toks) - overlap), size - overlap)
    return [toks[s : s + size] for s in starts]


def split_recursive(text: str, size: int, overlap: int, enc, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Chunks of at most ``size`` tokens, measured as the sum of their pieces. Empty text is one empty chunk."""
    length: Callable[[str], int] = lambda s: len(enc.encode(s))
    if length(text) <= size:
        return [text]
    for depth, sep in enumerate(separators):
        pieces = _pieces(text, sep)
        if len(pieces) > 1:
            break
    else:
        return [enc.decode(w) for w in window_tokens(enc.encode(text), size, overlap)]
    flat: list[str] = []
    for p in pieces:
        flat.extend([p] if length(p) <= size else split_recursive(p, size, overlap, enc, separators[depth:] if len(p) < len(text) else separators[depth + 1 :]))
    return pack(flat, [length(p) for p in flat], size, overlap)


def recursive_chunks(
    docs: DataFrame, size: int = 200, overlap: int = 20, *, id_col: str = "doc_id", text_col: str = "text", metadata: str | None = None,
    vocabulary: str | None = None, separators: tuple[str, ...] = SEPARATORS,
) -> DataFrame:
    """``(id, text, metadata)``: chunk ``doc:000000`` onwards with ``order``, ``doc_id`` and ``tok`` in the metadata.

    These three win over keys of the document's own metadata. Null text gives no chunk, empty text one empty chunk.
    vocabulary: path of a rank file on every worker; without one, words and signs are counted.
    """
    check_sizes(size, overlap)

    @F.pandas_udf("array<struct<text: string, tok: int>>")
    def split(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = codec(vocabulary)
        for s in parts:
            yield s.map(lambda t: None if t is None else [{"text": c, "tok": len(enc.encode(c))} for c in split_recursive(t, size, overlap, enc, separators)])

    own = F.col(metadata) if metadata else F.lit(None).cast("map<string,string>")
    d = docs.select(F.col(id_col).cast("string").alias("doc"), own.alias("own"), F.posexplode(split(text_col)).alias("n", "c"))
    return d.select(chunk_id(F.col("doc"), F.col("n")).alias("id"), F.col("c.text").alias("text"), chunk_metadata(F.col("own"), F.col("doc"), F.col("n"), F.col("c.tok")).alias("metadata"))


def chunk_metadata(own: Column, doc: Column, order: Column, tok: Column) -> Column:
    kept = F.map_filter(F.coalesce(own, F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin("order", "doc_id", "tok"))
    return F.map_concat(kept, F.create_map(F.lit("order"), order.cast("string"), F.lit("doc_id"), doc, F.lit("tok"), tok.cast("string")))


def token_windows(docs: DataFrame, size: int = 200, overlap: int = 20, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, doc_id, order, tok, text)``: windows of words, joined by one blank; a document without words gives none."""
    check_sizes(size, overlap)
    words = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "[ \\n\\t\\r]+"), lambda w: w != "")
    d = docs.select(F.col(id_col).cast("string").alias("doc_id"), words.alias("w")).filter(F.size("w") > 0)
    d = d.select("doc_id", "w", F.posexplode(F.sequence(F.lit(0), F.greatest(F.size("w") - overlap - 1, F.lit(0)), F.lit(size - overlap))).alias("order", "start"))
    s = F.slice("w", F.col("start") + 1, size)
    return d.select(chunk_id(F.col("doc_id"), F.col("order")).alias("id"), "doc_id", F.col("order").cast("bigint").alias("order"), F.size(s).cast("bigint").alias("tok"), F.array_join(s, " ").alias("text"))


class RecursiveChunker(BaseChunker):
    def __init__(self, size: int = 200, overlap: int = 20, **options) -> None:
        check_sizes(size, overlap)
        self.size, self.overlap, self.options = size, overlap, options

    def chunk(self, docs: DataFrame) -> DataFrame:
        return recursive_chunks(docs, self.size, self.overlap, **self.options)


class WindowChunker(BaseChunker):
    def __init__(self, size: int = 200, overlap: int = 20, **options) -> None:
        check_sizes(size, overlap)
        self.size, self.overlap, self.options = size, overlap, options

    def chunk(self, docs: DataFrame) -> DataFrame:
        w = token_windows(docs, self.size, self.overlap, **self.options)
        return w.select("id", "text", chunk_metadata(F.lit(None).cast("map<string,string>"), F.col("doc_id"), F.col("order"), F.col("tok")).alias("metadata"))
