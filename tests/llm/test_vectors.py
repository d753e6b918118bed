import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.llm import blocks, subset
from tessera.llm import vectors as V

SCHEMA = "id STRING, u INT, vector ARRAY<DOUBLE>, extra STRING"


def versions(spark, rows):
    df = spark.createDataFrame([(i, u, None if v is None else [None if x is None else float(x) for x in v], "e") for i, u, v in rows], SCHEMA)
    return df.select("id", F.struct(F.lit(1).alias("s"), F.col("u").alias("u")).alias("o"), "vector")


def brute(rows, k=V.K, least=V.LEAST):
    x = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    out = set()
    for a in x:
        c = sorted((-round(float(x[a] @ x[b]), 6), b) for b in x if b != a)
        out |= {(a, b) for s, b in c[:k] if -s >= least}
    return out


def test_neighbours_copies_ties_and_unusable(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 64))
    good = [(f"n{i:03d}", base[i % 6] + rng.normal(size=64) * 0.12) for i in range(90)]
    good += [(f"c{i:02d}", base[0] * 2) for i in range(12)]  # exact copies: ties by id
    good = [(i, v.astype(np.float32).astype(float)) for i, v in good]
    rows = [(i, 2, v) for i, v in good]
    rows += [(i, 1, rng.normal(size=64)) for i, _ in good[:5]] + rows[:3]  # superseded and repeated rows
    rows += [("x1", 1, None), ("x2", 1, np.zeros(64)), ("x3", 1, np.ones(3)), ("x4", 1, [float("nan")] * 64), ("x5", 1, [None] * 64), ("x6", 2, None), ("x6", 1, base[0])]
    want = brute(good)
    got = [(r["id"], r["other"]) for r in V.neighbours(versions(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) > 0.98 * len(want)
    assert {(a, b) for a, b in got if a[0] == "c"} == {(a, b) for a, b in want if a[0] == "c"}
    crowd = {r["id"] for r in V.crowd_members(versions(spark, rows)).collect()}
    x = {i: v / np.linalg.norm(v) for i, v in good}
    assert crowd == {a for a in x if sum(round(float(x[a] @ x[b]), 6) >= V.LEAST for b in x if b != a) >= V.CROWD}


def test_all_neighbours_without_a_least_cosine(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(4, 64))
    good = [(f"n{i:03d}", np.round(rng.normal(size=64) + base[i % 4] * (i % 3), 4)) for i in range(300)]
    good += [(f"{'za'[i % 2]}{i:02d}", base[0]) for i in range(12)] + [(f"t{i}", base[1] * (i + 1)) for i in range(9)]  # copies and ties
    good += [("huge", base[2] * 1e200), ("tiny", base[3] * 1e-200)]
    for levels, tile in ((V.LEVELS, V.TILE), ((0.95, 0.7, 0.4), 7)):
        monkeypatch.setattr(V, "LEVELS", levels)
        monkeypatch.setattr(V, "TILE", tile)
        df = spark.createDataFrame([(i, 1, v.tolist(), "e") for i, v in good + [("x", np.zeros(64)), ("y", np.ones(3))]], SCHEMA).repartition(7)
        df = df.select("id", F.struct(F.lit(1).alias("s"), F.col("u").alias("u")).alias("o"), "vector")
        with_batches = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
        got = [(r["id"], r["other"]) for r in V.neighbours(df, least=None).collect()]
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", with_batches)
        scaled = [(i, v / np.abs(v).max()) for i, v in good]
        assert len(got) == 5 * len(good) and set(got) == brute(scaled, least=-2)
    assert V.neighbours(df.filter("false"), least=None).count() == V.neighbours(df.filter("id = 'n000'"), least=None).count() == 0
    assert [(r["id"], r["other"]) for r in V.neighbours(df.filter("id in ('n000', 'n001')"), least=None).orderBy("id").collect()] == [("n000", "n001"), ("n001", "n000")]


def test_windows_lose_no_vector():
    rng = np.random.default_rng(8)
    for times in (1, 10, 40):  # also with one dominant coordinate
        a = rng.normal(size=(700, 64))
        a[:, 0] *= times
        b = a + rng.normal(size=a.shape) * np.linalg.norm(a, axis=1)[:, None] * rng.uniform(0, 0.2, (700, 1))
        cell = V.Cell(np.arange(700), pa.array([f"{i:03d}" for i in range(700)]), np.ones(700), b)
        q = a / np.linalg.norm(a, axis=1)[:, None]
        cosine = np.round(q @ cell.v.T, 6)
        for level in (0.97, 0.9, 0.6):
            may = np.concatenate(list(cell.collisions(q, level)))
            assert may[cosine >= level].all() and (times > 1 or level < 0.9 or may.mean() < 0.02)


def test_lists_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(20, 64))
    rows = [(f"n{i:04d}", 1, np.round(base[i % 20] + rng.normal(size=64) * (0.3 if i % 3 else 1), 4)) for i in range(1500)]
    want = brute([(i, v) for i, _, v in rows], least=-2)
    for size, n in ((150, 0.9), (20, 0.9)):  # longer lists than planned are cut into blocks
        monkeypatch.setattr(V, "LIST", size)
        monkeypatch.setattr(V, "LISTS", 10)
        got = [(r["id"], r["other"]) for r in V.neighbours(versions(spark, rows), least=None).collect()]
        assert len(got) == len(set(got)) == 5 * len(rows) and len(want & set(got)) >= n * len(want)
        crowd = {r["id"] for r in V.crowd_members(versions(spark, rows), 10).collect()}
        x = np.array([v / np.linalg.norm(v) for _, _, v in rows])
        many = {rows[i][0] for i in np.flatnonzero((np.round(x @ x.T, 6) >= V.LEAST).sum(1) > 10)}
        assert crowd <= many and len(crowd) >= 0.98 * len(many) > 0


def test_empty_and_single(spark):
    assert V.neighbours(versions(spark, [])).count() == 0
    assert V.neighbours(versions(spark, [("a", 1, np.ones(64))])).count() == 0
    assert V.crowd_members(versions(spark, [("a", 1, None)])).count() == 0


def test_spread_meets_every_pair_once():
    row = np.arange(200).astype(np.int64)
    at, cell, side = blocks.spread(np.full(200, 7, np.uint64), row, np.full(200, 200), 30)
    met = {}
    order, start, end = blocks.groups(cell)
    for i, j in blocks.pairs_of(start, end):
        a, b = order[i], order[j]
        ok = ((side[a] & 2) == 0) | ((side[a] & 1) != (side[b] & 1))
        for x, y in zip(at[a[ok]], at[b[ok]], strict=True):
            met[min(x, y), max(x, y)] = met.get((min(x, y), max(x, y)), 0) + 1
    assert len(met) == 200 * 199 // 2 and set(met.values()) == {1}
    assert max(end - start) < 120


def test_copies_of_a_posting_stay_flat_as_rows_grow():
    rng = np.random.default_rng(1)
    copies = []
    for rows in (10**6, 10**7, 10**8, 10**9, 10**10):
        postings = 64 * rows
        sketch = blocks.sketch_of(postings)
        counted = rng.poisson(postings / sketch, 4096)  # a sample of the counters: keys that are not hot
        mean, over = blocks.hot_over(counted, blocks.HOT)
        at, _, side = blocks.spread(np.arange(4096).astype(np.uint64), np.arange(4096), counted, blocks.HOT, mean, over)
        copies.append(len(at) / 4096)
        hot = np.full(100, counted.mean() * 4 + 100 * blocks.HOT).astype(np.int64)
        assert len(blocks.spread(np.full(100, 7, np.uint64), np.arange(100), hot, blocks.HOT, mean, over)[0]) >= 100 * 100
    assert max(copies) == 1.0


def test_counts(spark):
    df = spark.range(1000).repartition(7)
    c = blocks.counts(df, lambda b: np.asarray(b.column(0)) % 10, 32)
    assert c[:10].tolist() == [100] * 10 and c[10:].sum() == 0


def test_quotas_balance_both_kinds():
    counts = {("a", "x"): 1000, ("a", "y"): 10, ("b", "x"): 5, ("b", "y"): 100}
    q = subset.balanced_quotas(counts, 40)
    assert sum(q.values()) == 40 and all(q[k] <= counts[k] for k in q)
    a = sum(n for (r, _), n in q.items() if r == "a")
    x = sum(n for (_, c), n in q.items() if c == "x")
    assert abs(a - 20) <= 2 and abs(x - 20) <= 2
    assert subset.balanced_quotas(counts, 10**6) == counts and subset.balanced_quotas({}, 5) == {}


def test_varied_subset(spark):
    rng = np.random.default_rng(5)
    center = rng.normal(size=64)
    rows = [(f"crowd{i:03d}", center + rng.normal(size=64) * 0.05, "k", i / 200) for i in range(120)] + [(f"free{i:02d}", rng.normal(size=64), None if i % 2 else "k", None if i == 0 else 0.5) for i in range(40)]
    df = spark.createDataFrame([(i, v.tolist(), c, s) for i, v, c, s in rows], "id STRING, vector ARRAY<DOUBLE>, collection STRING, score DOUBLE")
    df = df.select("id", F.struct(F.lit(1).alias("s"), F.lit(1).alias("u")).alias("o"), "vector", "collection", "score")
    got = [r["id"] for r in subset.varied_subset(df, 30).collect()]
    assert len(got) == len(set(got)) == 30 and sum(i.startswith("crowd") for i in got) <= 1
    assert {i for i in got if i.startswith("crowd")} <= {"crowd119"}
    assert subset.varied_subset(df, 10_000).count() == 160 and subset.varied_subset(df.filter("false"), 5).count() == 0


def test_subset_of_many_small_collections(spark):
    rng = np.random.default_rng(9)
    rows = [(f"r{i:03d}", rng.normal(size=64).tolist(), f"c{i % 300:03d}", 0.5) for i in range(600)]
    df = spark.createDataFrame(rows, "id STRING, vector ARRAY<DOUBLE>, collection STRING, score DOUBLE")
    df = df.select("id", F.struct(F.lit(1).alias("s"), F.lit(1).alias("u")).alias("o"), "vector", "collection", "score")
    got = {r["id"] for r in subset.varied_subset(df, 300).collect()}
    assert len(got) == 300 and len({int(i[1:]) % 300 for i in got}) == 300
