import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from tessera.operators import incremental as I

T = dt.datetime(2025, 1, 1, 12)
H = dt.timedelta(hours=1)
R = "id BIGINT, source_key STRING, updated_at TIMESTAMP_NTZ, loaded_at TIMESTAMP_NTZ, name STRING"
C = "run_id BIGINT, source_key STRING, updated_at STRING, last_id BIGINT, ts BIGINT, status STRING"


def epoch(t):
    return int((t - dt.datetime(1970, 1, 1)).total_seconds())


def found(spark, tmp_path, rows, runs, name="t"):
    r = spark.createDataFrame(rows, R) if rows else spark.createDataFrame([], R)
    c = spark.createDataFrame(runs, C) if runs else spark.createDataFrame([], C)
    return sorted((x["source_key"] or "", x["row_id"]) for x in I.pending_rows(r, c, str(tmp_path / name)).collect())


def test_iso_spellings(spark):
    vals = ["2025-01-01T12:00:00Z", "2025-01-01 12:00:00", "2025-01-01T14:00:00+02:00", "2025-01-01T09:00:00-0300", "", None, "soon", "2025-01-01T12:00:00.5"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "u STRING").select(I.iso_utc("u")).collect()]
    assert got == [T, T, T, T, None, None, None, T.replace(microsecond=500000)]


def test_pending(spark, tmp_path):
    runs = [(1, "s", "2025-01-01T12:00:00", 5, epoch(T + 2 * H), "ok"), (2, "s", "2026-01-01", 99, epoch(T + 9 * H), "failed"), (3, "e", "", 0, epoch(T + 2 * H), "ok"), (1, "s", "2025-01-01T12:00:00", 5, epoch(T + 2 * H), "ok")]
    rows = [
        (1, "s", T - H, T, None),  # done
        (2, "s", T - H, T + 3 * H, None),  # late
        (3, "s", T - H, T + 3 * H, None), (3, "s", T - H, T, None),  # delivered again
        (5, "s", T, T, None), (6, "s", T, T, None),  # the tie is cut by the id
        (7, "s", None, T, None), (8, "s", None, T + 3 * H, None),
        (9, "s", T - H, T, None), (9, "s", T + H, T + H, None),  # a new version
        (1, "e", T, T, None), (2, "e", None, T, None),  # the run has no mark
        (1, "x", T, T, None),  # no run at all
        (1, None, T, T, None), (1, None, T, T, None),
    ]
    want = sorted([("s", 2), ("s", 6), ("s", 8), ("s", 9), ("e", 1), ("x", 1), ("", 1)])
    assert found(spark, tmp_path, rows, runs) == want
    assert found(spark, tmp_path, rows, runs) == want  # nothing changed
    assert found(spark, tmp_path, rows[:-1] + [(2, "x", T, T, None)], runs) == sorted([*want, ("x", 2)])
    assert found(spark, tmp_path, [], []) == []


def test_only_changed_partitions_are_recomputed(spark, tmp_path):
    t = I.ChangedPartitions(spark, str(tmp_path / "p"), ["g"])
    seen = []

    def compute(df):
        seen.append(sorted({r["g"] for r in df.select("g").collect()}))
        return df.groupBy("g").agg(F.sum("v").alias("v"))

    def run(rows):
        t.refresh(spark.createDataFrame(rows, "g STRING, v BIGINT"), ["v"], compute)
        return {r["g"]: r["v"] for r in t.read().collect()}

    assert run([("a", 1), ("b", 2), ("c", 3)]) == {"a": 1, "b": 2, "c": 3}
    assert run([("c", 3), ("b", 5), ("a", 1)]) == {"a": 1, "b": 5, "c": 3}
    assert run([("a", 1), ("b", 5)]) == {"a": 1, "b": 5}  # a partition that lost all its rows is emptied
    assert seen[1:] == [["b"], []]


def test_failure_before_the_state_is_repeated(spark, tmp_path):
    t = I.ChangedPartitions(spark, str(tmp_path / "q"), ["g"])
    df = spark.createDataFrame([("a", 1)], "g STRING, v BIGINT")

    def fail(_):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        t.refresh(df, ["v"], fail)
    t.refresh(df, ["v"], lambda x: x.groupBy("g").agg(F.sum("v").alias("v")))
    assert t.read().collect()[0]["v"] == 1


def test_failure_inside_the_overwrite(spark, tmp_path, monkeypatch):
    t = I.ChangedPartitions(spark, str(tmp_path / "o"), ["g"])
    add = lambda x: x.groupBy("g").agg(F.sum("v").alias("v"))
    old = spark.createDataFrame([("a", 1), ("b", 2)], "g STRING, v BIGINT")
    t.refresh(old, ["v"], add)
    replace = t.files.replace

    def lost(path, text):
        if path.endswith("state.json"):
            raise OSError("lost")
        replace(path, text)

    monkeypatch.setattr(t.files, "replace", lost)
    with pytest.raises(OSError):
        t.refresh(spark.createDataFrame([("a", 7), ("b", 2)], "g STRING, v BIGINT"), ["v"], add)
    monkeypatch.setattr(t.files, "replace", replace)
    shutil.rmtree(tmp_path / "o" / "rows" / "g=a")  # the old partition is gone, the new one has not come
    with pytest.raises(RuntimeError):
        t.read()
    assert [r["g"] for r in t.refresh(old, ["v"], add).collect()] == ["a"]  # though its fingerprint is the old one
    assert {r["g"]: r["v"] for r in t.read().collect()} == {"a": 1, "b": 2}


def test_buckets_grow_with_a_source(spark):
    rows = spark.createDataFrame([(i, "big" if i % 10 else "small", None, T, None) for i in range(100)], R)
    d = I.deliveries(rows, I.last_runs(spark.createDataFrame([], C)), 10)
    n = {r["source_key"]: r["n"] for r in d.groupBy("source_key").agg(F.count_distinct("bucket").alias("n")).collect()}
    assert 10 <= n["big"] <= 16 and n["small"] == 1 and d.count() == 100


def test_additive_hash_ignores_order_and_counts_copies(spark):
    a = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2)], "g STRING, v BIGINT")
    f = [I.fingerprints(x, ["g"], ["v"]).first() for x in (a, a.orderBy(F.desc("v")), a.distinct())]
    assert f[0] == f[1] != f[2]
