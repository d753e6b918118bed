"""Postings that travel as blocks, bounded counts, and pairs of row blocks for hot keys.

A mapper packs the postings of an Arrow batch that go to one part into one binary row; a part is a share of the key
space. So the JVM moves few rows, and a reducer sorts plain arrays. A key whose count exceeds ``HOT`` is cut into row
blocks: a posting goes to every pair of blocks that holds its own, so no task sees more than two blocks of a key, and
each pair of rows meets exactly once.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Postings of one key in one block; parts per shuffle partition at least, and bytes of a part as planned.
HOT, PARTS, PART_BYTES = 8192, 4, 32 << 20
#: Fewest and most counters of a sketch, and postings for each as planned; they travel in this many slices.
SKETCH, MOST_SKETCH, LOAD, SLICES = 1 << 18, 1 << 24, 256, 16
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * _MIX
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def parts_of(df: DataFrame, size: int = 0) -> int:
    """Parts for so many bytes of postings: a task holds one at a time."""
    return max(PARTS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def sketch_of(postings: int) -> int:
    """Counters for so many postings, a power of two: few enough fall on one counter to tell rare keys from frequent ones."""
    return min(MOST_SKETCH, max(SKETCH, 1 << max(0, int(postings) // LOAD).bit_length()))


def hot_over(counted: np.ndarray, hot: int) -> tuple[int, int]:
    """What a counter holds by chance, and from which count on its keys count as hot: never the mean of all keys."""
    mean = int(counted.sum() // max(1, len(counted)))
    return mean, max(hot, 4 * mean)


def sliced(c: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Counters as slices for the shuffle, compressed; slices of zeros are left out."""
    parts = [(i, x) for i, x in enumerate(np.split(c, SLICES)) if x.any()]
    return [i for i, _ in parts], [zlib.compress(x.astype("<i8").tobytes(), 1) for _, x in parts]


def added(slices: DataFrame, size: int) -> np.ndarray:
    """The sum of slices ``i INT, c BINARY``: an array of ``size`` counters, ``8 * size`` bytes for the driver, whatever the data."""

    def add(g: pd.DataFrame) -> pd.DataFrame:
        s = sum(np.frombuffer(zlib.decompress(c), "<i8") for c in g["c"])
        return pd.DataFrame({"i": [int(g["i"].iloc[0])], "c": [s.tobytes()]})

    out = np.zeros(size, np.int64)
    step = size // SLICES
    for r in slices.groupBy("i").applyInPandas(add, "i INT, c BINARY").collect():
        out[r["i"] * step : (r["i"] + 1) * step] = np.frombuffer(r["c"], "<i8")
    return out


def counts(df: DataFrame, slots: Callable[[pa.RecordBatch], np.ndarray], size: int = SKETCH) -> np.ndarray:
    """How often each slot occurs in all rows, added up per task, then per slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = np.zeros(size, np.int64)
        for b in batches:
            c += np.bincount(slots(b), minlength=size)
        i, x = sliced(c)
        if i:
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(x, pa.binary())], names=["i", "c"])

    return added(df.mapInArrow(run, "i INT, c BINARY"), size)


def spread(key: np.ndarray, row: np.ndarray, n: np.ndarray, hot: int = HOT, mean: int = 0, over: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of postings: index of the posting, cell, and side (0: the lower block of the pair, 1: the higher).

    n: estimated count of each posting's key, equal for equal keys. Up to ``hot`` (or to ``over``, if that is more) the cell is
    the key and the side 0; beyond, blocks are counted without ``mean``, the postings of other keys on the same counter.
    """
    s = np.where(n > max(hot, over), np.maximum(1, -(-(n - mean) // hot)), 1).astype(np.int64)
    own = (mix(row) % s.astype(np.uint64)).astype(np.int64)
    at = np.repeat(np.arange(len(key)), s)
    other = np.arange(len(at)) - np.repeat(np.cumsum(s) - s, s)
    mine = own[at]
    lo, hi = np.minimum(mine, other), np.maximum(mine, other)
    big = s[at] > 1
    cell = key[at].astype(np.uint64)
    with np.errstate(over="ignore"):
        cell = np.where(big, mix(cell + _MIX * (lo * 65_536 + hi + 1).astype(np.uint64)), cell)
    return at, cell, np.where(big & (mine > other), 1, 0).astype(np.uint8) + np.where(big & (lo != hi), 2, 0).astype(np.uint8)


def short(cell: np.ndarray) -> np.ndarray:
    """32 bits of a cell; cells that fall together only bring more rows together."""
    return (mix(cell) >> np.uint64(32)).astype(np.uint32)


def pack(cell: np.ndarray, rows: np.ndarray, parts: int) -> pa.RecordBatch:
    """One binary row per part with the rows (a structured array) whose cells belong to it."""
    p = (mix(cell) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(p, kind="stable")
    p, rows = p[order], rows[order]
    cut = np.flatnonzero(np.diff(p)) + 1
    chunks = [x.tobytes() for x in np.split(rows, cut)] if len(rows) else []
    return pa.RecordBatch.from_arrays([pa.array(p[np.concatenate([[0], cut]).astype(int)] if len(rows) else [], pa.int32()), pa.array(chunks, pa.binary())], names=["part", "rows"])


def unpacked(batches: Iterator[pa.RecordBatch], dtype: np.dtype) -> Iterator[np.ndarray]:
    """The rows of each part, one part after the other; the stream is sorted by part."""
    now, held = None, []
    for b in batches:
        for p, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if now is not None and p != now:
                yield np.concatenate(held)
                held = []
            now = p
            held.append(np.frombuffer(x.as_py(), dtype))
    if held:
        yield np.concatenate(held)


def by_part(df: DataFrame) -> DataFrame:
    return df.repartition("part").sortWithinPartitions("part")


def groups(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts by cell, and start and end of each run of at least two."""
    order = np.argsort(cells, kind="stable")
    c = cells[order]
    edge = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1], [True]]))
    start, end = edge[:-1], edge[1:]
    two = end - start > 1
    return order, start[two], end[two]


def pairs_of(start: np.ndarray, end: np.ndarray, most: int = 4_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs i < j inside the runs, some millions at a time."""
    i = np.concatenate([np.arange(a, b - 1) for a, b in zip(start, end, strict=True)]) if len(start) else np.zeros(0, np.int64)
    last = np.repeat(end, end - start - 1)
    n = last - i - 1
    total = np.cumsum(n)
    at = 0
    while at < len(i):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        m = n[at:to]
        a = np.repeat(i[at:to], m)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(m) - m, m)
        yield a, b
        at = to


def id_hash(col: str):
    """The 64-bit key of a string id; equal for equal ids."""
    return F.xxhash64(col)
