"""Most similar vectors for every vector, and crowds of almost equal vectors, by collision counting.

Lists: centroids are fitted on a bounded sample, every vector is kept in the list of its nearest centroid and asks the lists of
its nearest centroids. How many it asks is calibrated on the sample, where all neighbours are known.

Search in a list: one sorted array per projection. A query opens a window around its own projection in each array and counts
for every vector in how many windows it lies; those that reach the threshold are verified by their exact cosine. Windows
start at the width that belongs to a close neighbour and are widened (virtual rehashing) until the k-th verified vector is as
close as the width stands for. The projections are a rotation of the space, so their differences add up to the distance: a
vector within distance d misses at most ``(d / w) ** 2`` windows of half width w. With this as the threshold no vector is lost;
only lists that are not asked lose any.

Exact copies are collapsed beforehand: one of them takes part, the others share its neighbours. A list that is longer than
planned is cut into blocks, so that no task holds more than a block and the queries pass by.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import blocks
from tessera.session import stored, table

DIM = 64
#: Neighbours per vector and least cosine of a pair; members of a crowd.
K, LEAST, CROWD = 5, 0.9, 20
#: Vectors of a list as planned, most lists (their centroids travel to all tasks: 4 MB), and rows of the sample: this many, or
#: ``PER_LIST`` for each list.
LIST, LISTS, SAMPLE, PER_LIST = 2048, 16_384, 32_768, 16
#: Share of the sample's true neighbours that the lists asked must hold, with a least cosine and without one.
SURE, USUAL = 0.999, 0.98
#: Half width of a window in standard deviations of the projections' difference at the cosine that it stands for; the cosines
#: through which windows widen before they hold all; queries of a tile.
WIDTH, LEVELS, TILE = 2.0, (0.9,), 64
_CALIBRATE = 1024


def usable(v: str):
    """64 numbers, none null or NaN or infinite, not all zero."""
    c = F.col(v)
    return c.isNotNull() & (F.size(c) == DIM) & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e300)) & F.exists(c, lambda x: x != 0)


def stored_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, o, vector``: all versions of all stored rows; the live one has the greatest ``o``."""
    s = table(spark, sf_dir, "stored_records").filter("id is not null")
    return s.select("id", F.struct(F.lit(1).alias("s"), F.col("updated_at").alias("u")).alias("o"), "vector")


def response_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "embed_responses").select(F.explode(F.arrays_zip("ids", "vectors")).alias("x"))
    r = r.select(F.col("x.ids").alias("id"), F.struct(F.lit(0).alias("s"), F.lit(None).cast("timestamp_ntz").alias("u")).alias("o"), F.col("x.vectors").alias("vector"))
    return r.filter("id is not null")


def live(versions: DataFrame, columns: list[str]) -> DataFrame:
    """The live rows of ``id, o, ...``: those with the greatest ``o`` of their id. Rows identical in all count as one later."""
    v = versions.withColumn("key", blocks.id_hash("id")).select("key", "id", "o", *columns).repartition("key")
    top = F.max("o").over(Window.partitionBy("key", "id"))
    return v.withColumn("top", top).filter("o = top").select("key", "id", *columns)


def _unit(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    v = np.asarray(col.flatten(), dtype=np.float64).reshape(-1, DIM)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1)[:, None]


def rotation(seed: int = 7) -> np.ndarray:
    """The directions of the sorted arrays: a random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((DIM, DIM)))
    return q * np.sign(np.diag(r))


# ---- lists


def _sampled(vectors: DataFrame, rows: int, lists: int) -> np.ndarray:
    """Distinct unit vectors of about ``max(SAMPLE, PER_LIST * lists)`` rows, chosen by their hash ``h``."""
    want = max(SAMPLE, PER_LIST * lists)
    some = vectors.filter(F.pmod(F.xxhash64("h", F.lit(5)), F.lit(1 << 30)) < int(min(1.0, want / max(1, rows)) * (1 << 30)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, at = np.unique(np.asarray(b.column(0)), return_index=True)
                u = _unit(b.column(1))[at].astype("<f4")
                yield pa.RecordBatch.from_arrays([pa.array([u.tobytes()], pa.binary())], names=["rows"])

    got = [np.frombuffer(r["rows"], "<f4").reshape(-1, DIM) for r in some.select("h", "vector").mapInArrow(pack, "rows BINARY").collect()]
    return np.unique(np.concatenate(got), axis=0) if got else np.zeros((0, DIM), np.float32)


def centroids(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Unit centroids of a sample by cosine; empty ones start again from a random row."""
    rng = np.random.default_rng(1)
    c = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        home = np.concatenate([(sample[s : s + 8192] @ c.T).argmax(1) for s in range(0, len(sample), 8192)])
        total = np.zeros_like(c)
        np.add.at(total, home, sample)
        n = np.linalg.norm(total, axis=1)
        c = np.where((n > 0)[:, None], total / np.maximum(n, 1e-30)[:, None], sample[rng.choice(len(sample), len(c))])
    return c


def probes(sample: np.ndarray, c: np.ndarray, k: int, least: float | None) -> int:
    """How many lists hold the stated share of the k nearest (of at least that cosine) of rows of the sample."""
    q = np.random.default_rng(2).permutation(len(sample))[:_CALIBRATE]
    near = sample[q] @ sample.T
    near[np.arange(len(q)), q] = -2
    k = min(k, len(sample) - 1)
    if k < 1 or len(c) == 1:
        return 1
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    ok = np.take_along_axis(near, best, 1) >= (-1.5 if least is None else least)
    home = (sample[best[ok]] @ c.T).argmax(1)
    mine = sample[q[np.nonzero(ok)[0]]] @ c.T
    place = (mine > np.take_along_axis(mine, home[:, None], 1)).sum(1) + 1
    if not len(place):
        return min(2, len(c))
    need = int(np.quantile(place, USUAL if least is None else SURE, method="higher"))
    return min(len(c), max(2, need))


class Lists:
    """The lists of a collection.

    versions: ``id, o, vector``. ``members``: ``h, id`` of all live usable rows; ``classes``: of each distinct live vector its
    hash ``h``, its list, the least id that has it (``name``) and the number of ids (``size``). Two vectors with one 64-bit
    hash would count as copies.
    """

    def __init__(self, versions: DataFrame, k: int, least: float | None) -> None:
        v = versions.withColumn("vector", F.col("vector").cast("array<double>"))
        v = v.withColumn("ok", usable("vector")).withColumn("h", F.when(F.col("ok"), F.xxhash64("vector")))
        self.vectors = v.filter("ok").select("h", "vector")
        rows = versions.count()
        lists = int(min(LISTS, max(1, rows // LIST)))
        self.sample = sample = _sampled(self.vectors, rows, lists)
        self.centroids = centroids(sample, lists) if len(sample) else np.zeros((1, DIM), np.float32)
        self.probes = probes(sample, self.centroids, k, least)
        o = f"STRUCT<{','.join(f'{x.name}: {x.dataType.simpleString()}' for x in v.schema['o'].dataType)}>"
        there = v.select("id", "o", "h", "vector").mapInArrow(placed(self.centroids), f"id STRING, o {o}, h BIGINT, home INT")
        self.members = stored(live(there, ["h", "home"]).filter("h is not null").select("h", "home", "id").distinct())
        self.classes = stored(self.members.groupBy("h").agg(F.first("home").alias("home"), F.min("id").alias("name"), F.count("*").alias("size")))
        self.blocks = np.ones(len(self.centroids), np.int64)
        for r in self.classes.groupBy("home").agg(F.count("*").alias("n")).collect():  # a row per list
            self.blocks[r["home"]] = -(-r["n"] // (2 * LIST))

    def search(self, visit: Callable, schema: str) -> DataFrame:
        """``visit`` of each block of a list with each batch of vectors that ask it."""
        cells = int(self.blocks.sum())
        asked = self.vectors.mapInArrow(_asked(self.centroids, self.blocks, self.probes), _SENT)
        names = self.classes.mapInArrow(_named(self.blocks), _SENT)
        n = int(self.vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sent = asked.unionByName(names).repartition(max(n, min(cells, 16 * n)), "cell").sortWithinPartitions("cell", "kind")
        return sent.mapInArrow(_visited(visit), schema)


_SENT = "cell INT, kind INT, rows BINARY"
_ROW = np.dtype([("h", "<i8"), ("v", "<f8", (DIM,))])
#: What a cell gets, in this order: names of its own vectors, its own vectors, vectors from elsewhere that ask it.
_NAMES, _OWN, _ASKING = 0, 1, 2


def _near(u: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosines to all centroids, and the nearest one, which is the same whatever rows stand beside a row in its batch."""
    near = u.astype(np.float32) @ c.T
    home = near.argmax(1)
    close = near >= near.max(1, keepdims=True) - 1e-4
    for i in np.flatnonzero(close.sum(1) > 1):
        at = np.flatnonzero(close[i])
        home[i] = at[(u[i] * c[at].astype(np.float64)).sum(1).argmax()]
    return near, home


def placed(c: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.flatnonzero(np.asarray(b.column(2).is_valid()))
            home = np.full(b.num_rows, -1, np.int32)
            if len(ok):
                home[ok] = _near(_unit(b.column(3).take(pa.array(ok))), c)[1]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(home)], names=["id", "o", "h", "home"])

    return run


def _own_block(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (blocks.mix(h) % n.astype(np.uint64)).astype(np.int64)


def _sent(cell: np.ndarray, kind: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """One compressed binary row per cell and kind."""
    order = np.lexsort((kind, cell))
    cell, kind, rows = cell[order], kind[order], rows[order]
    at = np.concatenate([[0], np.flatnonzero((np.diff(cell) != 0) | (np.diff(kind) != 0)) + 1])
    zip_ = zstandard.ZstdCompressor(level=1)
    packed = [zip_.compress(x.tobytes()) for x in np.split(rows, at[1:])]
    return pa.RecordBatch.from_arrays([pa.array(cell[at], pa.int32()), pa.array(kind[at], pa.int32()), pa.array(packed, pa.binary())], names=["cell", "kind", "rows"])


def _asked(c: np.ndarray, size: np.ndarray, n: int):
    base = np.cumsum(size) - size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            h, first = np.unique(np.asarray(b.column(0)), return_index=True)  # copies within the batch count once
            rows = np.empty(len(h), _ROW)
            rows["h"], rows["v"] = h, np.asarray(b.column(1).flatten(), dtype=np.float64).reshape(-1, DIM)[first]
            near, home = _near(_unit(b.column(1))[first], c)
            near[np.arange(len(h)), home] = 2
            lists = np.argpartition(-near, n - 1, axis=1)[:, :n]
            row = np.repeat(np.arange(len(h)), n)
            lists = lists.ravel()
            at = np.repeat(np.arange(len(row)), size[lists])
            cell = np.repeat(base[lists], size[lists]) + np.arange(len(at)) - np.repeat(np.cumsum(size[lists]) - size[lists], size[lists])
            own = (base[home] + _own_block(h, size[home]))[row[at]]
            yield _sent(cell, np.where(cell == own, _OWN, _ASKING), rows[row[at]])

    return run


def _named(size: np.ndarray):
    base = np.cumsum(size) - size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            h, home = np.asarray(b.column(0)), np.asarray(b.column(1))
            cell = base[home] + _own_block(h, size[home])
            order = np.argsort(cell, kind="stable")
            at = np.concatenate([[0], np.flatnonzero(np.diff(cell[order])) + 1, [len(h)]])
            packed = []
            for x, y in zip(at[:-1], at[1:], strict=True):
                to = pa.BufferOutputStream()
                t = b.take(pa.array(order[x:y]))
                with pa.ipc.new_stream(to, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_batch(t)
                packed.append(to.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(cell[order[at[:-1]]], pa.int32()), pa.array([_NAMES] * len(packed), pa.int32()), pa.array(packed, pa.binary())], names=["cell", "kind", "rows"])

    return run


# ---- search in a cell


class Cell:
    """The distinct vectors of a block of a list, in the order of their names, under sorted arrays of their projections."""

    def __init__(self, h: np.ndarray, names: pa.Array, size: np.ndarray, v: np.ndarray) -> None:
        self.h, self.names, self.size = h, names, size
        self.v = v / np.linalg.norm(v, axis=1)[:, None]
        self.v4 = self.v.astype(np.float32)
        self.turn = rotation()
        p = self.v @ self.turn
        order = np.argsort(p, axis=0)
        self.sorted = np.take_along_axis(p, order, 0)
        # places in the arrays by runs of at most 256, to compare them as bytes; windows are widened to whole runs
        self.run = -(-len(h) // 256)
        self.place = np.empty((DIM, len(h)), np.uint8)
        np.put_along_axis(self.place, order.T, np.broadcast_to((np.arange(len(h)) // self.run).astype(np.uint8), (DIM, len(h))), 1)

    def windows(self, q: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """First run and number of further runs of each query's window in each array, which of them are empty, and the threshold."""
        d2 = 2 - 2 * cosine + 1e-5
        w = WIDTH * np.sqrt(d2 / DIM)
        p = q @ self.turn
        first, last = np.empty((DIM, len(q)), np.int64), np.empty((DIM, len(q)), np.int64)
        for j in range(DIM):
            first[j] = np.searchsorted(self.sorted[:, j], p[:, j] - w, "left")
            last[j] = np.searchsorted(self.sorted[:, j], p[:, j] + w, "right") - 1
        lo, hi = np.minimum(first // self.run, 255), np.maximum(last, 0) // self.run
        return lo.astype(np.uint8)[:, :, None], (hi - lo).astype(np.uint8)[:, :, None], last < first, DIM - int(d2 / w**2 + 1e-9)

    def collisions(self, q: np.ndarray, cosine: float) -> Iterator[np.ndarray]:
        """A tile after the other, which vectors lie in so many windows of each query that they may have that cosine: all that have it do."""
        lo, n, empty, least = self.windows(q, cosine)
        seen = np.empty((TILE, len(self.h)), np.uint8)
        off, inside = np.empty(seen.shape, np.uint8), np.empty(seen.shape, bool)
        as_bytes, hollow = inside.view(np.uint8), empty.any()
        for s in range(0, len(q), TILE):
            m = min(TILE, len(q) - s)
            seen[:] = 0
            for j in range(DIM):
                np.subtract(self.place[j], lo[j, s : s + m], out=off[:m])  # before the window it wraps to a large number
                np.less_equal(off[:m], n[j, s : s + m], out=inside[:m])
                if hollow:
                    inside[:m][empty[j, s : s + m]] = False
                np.add(seen[:m], as_bytes[:m], out=seen[:m])
            yield seen[:m] >= least

    def verified(self, qh: np.ndarray, q: np.ndarray, may: np.ndarray | None, least: float):
        """Query, vector and rounded cosine of the pairs in ``may`` (all where it is None) that reach ``least``; not a vector with itself."""
        if may is not None and np.count_nonzero(may) * 8 < may.size:
            r, j = np.nonzero(may)
        else:
            hit = q.astype(np.float32) @ self.v4.T >= least - 1e-5
            r, j = np.nonzero(hit if may is None else hit & may)
        ok = qh[r] != self.h[j]
        r, j = r[ok], j[ok]
        c = np.concatenate([np.round(np.einsum("ij,ij->i", q[r[s : s + 65_536]], self.v[j[s : s + 65_536]]), 6) for s in range(0, max(1, len(r)), 65_536)])
        ok = c >= least
        return r[ok], j[ok], c[ok]

    def kth(self, q: np.ndarray, k: int) -> np.ndarray:
        """A lower bound of each query's k-th best cosine, from some of the vectors (one of which may be its own)."""
        some = self.v4[:: max(1, len(self.v4) // 512)]
        if len(some) <= k:
            return np.full(len(q), -2.0)
        return -np.partition(-(q.astype(np.float32) @ some.T), k, axis=1)[:, k] - 1e-5


def _ordered(r: np.ndarray, j: np.ndarray, c: np.ndarray, k: int):
    """The k best of each query by cosine and position, and their ranks."""
    o = np.lexsort((j, -c, r))
    r, j, c = r[o], j[o], c[o]
    rank = np.arange(len(r)) - np.searchsorted(r, r)
    ok = rank < k
    return r[ok], j[ok], c[ok], rank[ok]


def _nearest(k: int, least: float | None):
    levels = [x for x in LEVELS if least is None or x > least] + ([None] if least is None else [least])

    def visit(cell: Cell, qh: np.ndarray, q: np.ndarray) -> Iterator[pa.RecordBatch]:
        for level in levels:
            if level is None:  # windows so wide hold all; only those that may be among the k best are verified
                low = cell.kth(q, k).astype(np.float32)[:, None]
                tiles = (q[s : s + TILE].astype(np.float32) @ cell.v4.T >= low[s : s + TILE] for s in range(0, len(q), TILE))
            else:
                tiles = cell.collisions(q, level)
            closed = np.zeros(len(q), bool)
            s = 0
            for may in tiles:
                own = slice(s, s := s + len(may))
                r, j, c, rank = _ordered(*cell.verified(qh[own], q[own], may, -2.0 if level is None else level), k)
                done = np.full(len(may), level is levels[-1])
                done[r[rank == k - 1]] = True
                closed[own] = done
                ok = done[r]
                if ok.any():
                    yield pa.RecordBatch.from_arrays([pa.array(qh[own][r[ok]]), cell.names.take(pa.array(j[ok])), pa.array(c[ok])], names=["h", "other", "cosine"])
            qh, q = qh[~closed], q[~closed]
            if not len(q):
                return

    return visit


def _counted(least: float):
    def visit(cell: Cell, qh: np.ndarray, q: np.ndarray) -> Iterator[pa.RecordBatch]:
        s = 0
        for may in cell.collisions(q, least):
            own = slice(s, s := s + len(may))
            r, j, _ = cell.verified(qh[own], q[own], may, least)
            if len(r):
                n = np.bincount(r, weights=cell.size[j], minlength=len(may)).astype(np.int64)
                low = np.full(len(may), np.iinfo(np.int64).max)
                np.minimum.at(low, r, cell.h[j])
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(qh[own][at]), pa.array(n[at]), pa.array(low[at])], names=["h", "n", "low"])

    return visit


def _visited(visit: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        un = zstandard.ZstdDecompressor()

        def rows_of(data: list[bytes]) -> np.ndarray:
            x = np.concatenate([np.frombuffer(un.decompress(d), _ROW) for d in data])
            x = x[np.unique(x["h"], return_index=True)[1]]
            v = x["v"] / np.abs(x["v"]).max(1, keepdims=True)
            x["v"] = v / np.linalg.norm(v, axis=1)[:, None]
            return x

        def made(names: list[pa.RecordBatch], own: np.ndarray) -> Cell:
            t = pa.Table.from_batches(names)
            t = t.take(pc.sort_indices(t["name"]))
            return Cell(t["h"].to_numpy(), t["name"].combine_chunks(), t["size"].to_numpy(), own["v"][np.searchsorted(own["h"], t["h"].to_numpy())])

        def asked(cell: Cell, x: np.ndarray) -> Iterator[pa.RecordBatch]:
            for s in range(0, len(x), 32 * TILE):
                yield from visit(cell, x["h"][s : s + 32 * TILE], x["v"][s : s + 32 * TILE])

        stream = (x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True))
        for _, parts in itertools.groupby(stream, key=lambda x: x[0]):
            names, cell, seen = [], None, np.zeros(0, np.int64)
            for kind, some in itertools.groupby(parts, key=lambda x: x[1]):
                if kind == _NAMES:
                    names = [b for x in some for b in pa.ipc.open_stream(x[2].as_py())]
                elif kind == _OWN and names:
                    x = rows_of([x[2].as_py() for x in some])
                    cell = made(names, x)
                    yield from asked(cell, x)
                elif cell is not None:
                    for y in some:
                        x = rows_of([y[2].as_py()])
                        x = x[~np.isin(x["h"], seen)]
                        seen = np.append(seen, x["h"])
                        yield from asked(cell, x)

    return run


def neighbours(versions: DataFrame, k: int = K, least: float | None = LEAST) -> DataFrame:
    """``id, rank, other, cosine``: of each vector its k most similar others, ties by smaller id.

    versions: ``id, o, vector`` and any other columns; the row with the greatest ``o`` of an id counts, identical rows once.
    With ``least`` only neighbours of at least that cosine. Rows without a usable vector take no part; no vectors give no
    rows. Cosines are taken in double precision and rounded to 6 decimals.
    """
    c = Lists(versions, k, least)
    near = c.search(_nearest(k, least), "h BIGINT, other STRING, cosine DOUBLE")
    best = F.row_number().over(Window.partitionBy("h").orderBy(F.desc("cosine"), "other"))
    near = near.withColumn("n", best).filter(F.col("n") <= k).select("h", "other", "cosine")
    many = c.classes.filter("size > 1").select("h", "name")
    # the k + 1 least ids of a class are all that can be among k neighbours
    few = c.members.join(many, "h").withColumn("n", F.row_number().over(Window.partitionBy("name").orderBy("id"))).filter(F.col("n") <= k + 1).select(F.col("name").alias("other"), F.col("id").alias("member"))
    near = near.unionByName(many.select("h", F.col("name").alias("other"), F.lit(1.0).alias("cosine"))).join(few, "other", "left")
    near = near.join(c.members.select("h", "id"), "h").select("id", F.coalesce("member", "other").alias("other"), "cosine").filter("id <> other")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine"), "other"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("id", F.col("rank").cast("bigint").alias("rank"), "other", "cosine")


def counted(c: Lists, least: float = LEAST) -> DataFrame:
    """``h, n, low``: how many other ids a vector has at that cosine in each list it asks, and the least hash among them."""
    return stored(c.search(_counted(least), "h BIGINT, n BIGINT, low BIGINT"))


def crowded(c: Lists, seen: DataFrame, k: int = CROWD) -> DataFrame:
    """``id`` of the vectors with at least k others: those counted in the lists and their own copies."""
    n = seen.select("h", "n").unionByName(c.classes.filter("size > 1").select("h", (F.col("size") - 1).alias("n")))
    return c.members.join(n.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= k).select("h"), "h", "left_semi").select("id")


def crowd_members(versions: DataFrame, k: int = CROWD, least: float = LEAST) -> DataFrame:
    """``id`` of the vectors with at least k other ids at that cosine; rows as for ``neighbours``."""
    c = Lists(versions, k, least)
    return crowded(c, counted(c, least), k)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = neighbours(stored_vectors(spark, sf_dir).unionByName(response_vectors(spark, sf_dir)))
    return near.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()


def p1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(stored_vectors(spark, sf_dir).unionByName(response_vectors(spark, sf_dir)), least=None)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crowd_members(stored_vectors(spark, sf_dir))
