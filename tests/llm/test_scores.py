import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import abuse, mixing, ranking

HITS = "query_id BIGINT, lane STRING, id STRING, score DOUBLE, higher_is_better BOOLEAN, rank INT"


def test_inverse_normal(spark):
    ps = [1e-9, 1e-4, 0.02, 0.3, 0.5, 0.7, 0.98, 0.9999]
    got = spark.createDataFrame([(p,) for p in ps], "p DOUBLE").select(ranking.inverse_normal(F.col("p"))).collect()
    for p, r in zip(ps, got, strict=True):
        assert r[0] == pytest.approx(statistics.NormalDist().inv_cdf(p), abs=1e-7)


def test_combined_ranking(spark):
    rows = [
        (1, "k", "a", 10.0, True), (1, "k", "b", 9.0, True), (1, "k", "b", 3.0, True), (1, "k", "c", None, True), (1, "k", "d", float("nan"), True),
        (1, "l2", "a", 0.1, False), (1, "l2", "b", 0.5, False), (1, "l2", "c", 900.0, False),
        (2, "k", "x", 1.0, True), (2, "k", "y", 1.0, True), (3, "k", "z", None, True), (4, "k", None, 1.0, True),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], HITS)
    got = ranking.combined_ranking(df).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["id"]) for r in got] == [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "x"), (2, 2, "y")]
    assert {(r["query_id"], r["id"]) for r in got if r["wins"] == r["query_lanes"]} == {(1, "a")}
    z = statistics.NormalDist().inv_cdf
    assert got[0]["score"] == pytest.approx((z(0.75) + z(2.5 / 3)) / 2, abs=1e-6)
    assert ranking.combined_ranking(df.filter("false")).count() == 0
    scaled = ranking.combined_ranking(df.withColumn("score", F.col("score") * F.when(F.col("lane") == "k", 1e6).otherwise(1.0)))
    assert [r["id"] for r in scaled.orderBy("query_id", "rank").collect()] == [r["id"] for r in got]


def test_percentiles_of_one_hot_query(spark):
    rng = np.random.default_rng(3)
    s = rng.integers(0, 50, 2000)
    df = spark.createDataFrame([(1, "k", f"i{i}", float(x), True, 1) for i, x in enumerate(s)], HITS)
    got = {r["id"]: r for r in ranking.percentiles(ranking.best_hits(df)).collect()}
    for i in range(0, 2000, 97):
        r = got[f"i{i}"]
        assert r["better"] == (s > s[i]).sum() and r["equal"] == (s == s[i]).sum() and r["p"] == pytest.approx(((s < s[i]).sum() + (s == s[i]).sum() / 2) / 2000)


def test_permutation_and_quotas():
    for n in (1, 2, 3, 10, 100, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 5)) == list(range(n))
    q = mixing.quotas({"a": 1000, "b": 10, "c": 100}, {"a": (0.5, 1), "b": (0.3, 2), "c": (0.2, 1), "none": (0.1, 3)}, 200)
    assert q["b"] == 20 and q["none"] == 0 and sum(q.values()) == 200 and abs(q["a"] / q["c"] - 2.5) < 0.1
    assert mixing.quotas({}, {"a": (1.0, 1)}, 10) == {"a": 0}
    d = mixing.ShardDraws(np.array([5 * 10**12, 3 * 10**10, 7]), 2048)
    (a, x), (b, y) = d(10**9), d(10**9 + 1)
    assert a.sum() == b.sum() == 2048 and (x + a == y).all() and x.sum() == 2048 * 10**9 and len(d._kept) < 100
    c = mixing.shard_counts(np.array([500, 30, 0, 70]), 100)
    assert c.sum(0).tolist() == [500, 30, 0, 70] and (c.sum(1) == 100).all()


def test_mixture(spark):
    docs = [(i, f"text number {i} " * 20, ["Big", " big_ ".strip("_ "), "small", None, "other"][i % 5], "x") for i in range(200)] + [(900, None, "big", "x"), (901, "", "big", "x"), (5, "again " * 30, "Big", "x")]
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING, source STRING, block STRING")
    t = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 2), ("absent", 0.1, 3)], "source STRING, target_share DOUBLE, max_repeats INT")
    m = mixing.mixture(df, t, length=32, shard=16)
    rows = m.collect()
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows) and {r["source"] for r in rows} == {"big", "small"}
    uses = {}
    for r in rows:
        uses[r["source"], r["block"]] = uses.get((r["source"], r["block"]), 0) + 1
    assert max(n for (s, _), n in uses.items() if s == "big") == 1 and max(uses.values()) <= 2
    whole = mixing.source_blocks(df, length=32).collect()
    enc = mixing.codec(mixing.VOCABULARY)
    want = sum(len(enc.encode(d[1] or "")) for d in docs if d[2])
    assert sum(len(r["tokens"]) for r in whole) == want and max(len(r["tokens"]) for r in whole) == 32
    sh = {r["source"]: r for r in mixing.shares(m, t).collect()}
    assert sh["absent"]["tokens"] == 0 and abs(sum(r["actual_share"] for r in sh.values()) - 1) < 1e-4
    assert mixing.mixture(df, t.filter("false"), length=32).count() == 0 and mixing.mixture(df.filter("false"), t, length=32).count() == 0
    assert [r.asDict() for r in m.orderBy("shard", "slot").collect()] == [r.asDict() for r in mixing.mixture(df, t, length=32, shard=16).orderBy("shard", "slot").collect()]


def test_undisguised():
    for bad in ("p4r4$173", "c.l.o.w.n", "m a l d i t o", "IDIIIIOT", "ha\u200blfwit", "h-a-l-f-w-i-t", "l0$3r"):
        assert abuse.undisguised(bad) in {"parasite", "clown", "maldito", "idiot", "halfwit", "loser"}
    assert abuse.undisguised("code FX-3176 costs $5") == "code fx-3176 costs $5"
    assert abuse.sentences(None) == [] and abuse.sentences("1. 2. 3.") == []
    assert abuse.sentences("This is one. This is two!") == [["this", "is", "one"], ["this", "is", "two"]]


def test_index_is_exact():
    rng = np.random.default_rng(6)
    ex = []
    for _ in range(300):
        f = np.unique(rng.integers(0, 200, 12))
        w = rng.random(len(f)).astype(np.float32)
        ex.append((f, w / np.linalg.norm(w)))
    ix = abuse.Index(ex, (rng.random(300) < 0.3).astype(float), np.ones(300))
    dense = np.zeros((300, 200))
    for i, (f, w) in enumerate(ex):
        dense[ix.place[i], f] = w
    for f, w in ex[:60]:
        j, c = ix.near(f, w, only_bad=False)
        q = np.zeros(200)
        q[f] = w
        s = np.sort(dense @ q)[::-1][: abuse.NEIGHBOURS]
        assert np.allclose(np.sort(c)[::-1], s[s >= abuse.NEAR], atol=1e-5)


def test_low_shares_of_bad_are_voted_on():
    f = np.arange(4)
    w = np.full(4, 0.5, np.float32)
    ix = abuse.Index([(f, w), (f + 10, w)], np.array([1.0, 0.0]), np.array([5.0, 1.0]))
    j, c = ix.near(f, w)
    assert 0.15 < abuse.vote(ix.bad[j], ix.count[j], c) < 0.2
    assert not len(ix.near(f + 10, w)[0])


def test_scores(spark):
    good = "Please tell the {0} in {1} which {2} copies the mapping today"
    bad = "You {0} fool nobody in {1} wants your stupid face around"
    rows, labels = [], []
    for i in range(240):
        n = [f"name{i % 7}", f"place{i % 11}", f"thing{i % 5}"]
        is_bad = i % 6 == 0
        rows.append((i, good.format(*n) + ". " + (bad.format(*n) if is_bad else good.format(*n[::-1])) + ".", "S" if i % 2 else "s ", "x"))
        if i % 3 == 0:
            labels += [(i, "r", "abusive" if is_bad else "none")] * 2
    rows += [(900, None, "s", "x"), (901, "", None, "x"), (902, bad.format("F00L", "place3"), None, "x"), (902, bad.format("F00L", "place3"), None, "x")]
    labels += [(1, "r", None), (1, "r", "unsure"), (5000, "r", "abusive")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING, score STRING")
    lb = spark.createDataFrame(labels, "doc_id BIGINT, reviewer STRING, verdict STRING")
    s = abuse.score_documents(df, lb)
    got = [(r["doc_id"], r["score"]) for r in s.collect()]
    assert {d for d, p in got if p >= 0.5} == {i for i in range(0, 240, 6)} | {902} and len(got) == len(rows)
    rates = {r["source"]: (r["documents"], r["bad"]) for r in abuse.source_rates(s).collect()}
    assert rates["s"] == (241, 40) and rates[None] == (3, 2)
    none = abuse.score_documents(df, lb.filter("false"))
    assert none.filter("score > 0").count() == 0 and abuse.score_documents(df.filter("false"), lb).count() == 0
