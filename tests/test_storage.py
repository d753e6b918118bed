import datetime as dt
import json
import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pyspark
import pytest
from pyspark.sql import functions as F

from tessera.operators import collections, embedding
from tessera.sources import checkpoints, files, ingest, retry
from tessera.streaming import upserts

ROWS = [("a", [1.0, 0.0], "cat", {"lang": "en"}), ("b", [0.0, 1.0], "dog", {"lang": "pt"}), ("c", [0.7, 0.7], None, None)]
SCHEMA = "id STRING, vector ARRAY<DOUBLE>, document STRING, metadata MAP<STRING,STRING>"


@pytest.fixture
def store(spark, tmp_path):
    s = collections.open_store(spark, "persistent", str(tmp_path), keyword=True, buckets=3)
    s.upsert("t", spark.createDataFrame(ROWS, SCHEMA))
    return s


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_upsert_get_delete_count(spark, store):
    assert store.count("t") == 3
    store.upsert("t", spark.createDataFrame([("a", [0.0, 2.0], "new", None), ("d", None, "x", None), ("d", None, "x", None)], SCHEMA))
    assert store.count("t") == 4 and store.get("t", ids=["a"]).first()["document"] == "new"
    assert ids(store.get("t", ids=[])) == [] and ids(store.get("t", where={"lang": ["en", "pt"]})) == ["b"]
    assert "vector" not in store.get("t", ids=["a"], include_vectors=False).columns and store.get("t", ids=["a"]).first()["score"] is None
    store.delete("t", ids=["d"], where={"lang": "pt"})
    assert ids(store.get_collection("t")) == ["a", "b", "c"]
    store.delete("t", where={"lang": "pt"})
    store.delete("t")
    store.delete("t", ids=[])
    assert ids(store.get_collection("t")) == ["a", "c"]
    store.create_collection("t")
    assert store.count("t") == 2 and store.count("fresh") == 0
    store.delete_collection("t")
    assert store.count("t") == 0
    with pytest.raises(Exception, match="needs an id"):
        store.upsert("t", spark.createDataFrame([(None, None, "x", None)], SCHEMA))


def test_query_and_keyword(spark, store):
    q = spark.createDataFrame([(1, [1.0, 0.1])], "query_id BIGINT, vector ARRAY<DOUBLE>")
    r = store.query("t", q, 2).orderBy("rank").collect()
    assert [x["id"] for x in r] == ["a", "c"] and r[0]["metric"] == "cosine"
    assert [x["id"] for x in store.query("t", q, 2, where={"lang": "pt"}).collect()] == ["b"]
    with pytest.raises(ValueError):
        store.query("t", q, where_document={"$contains": "x"})
    k = spark.createDataFrame([(1, "dog")], "query_id BIGINT, text STRING")
    assert ids(store.keyword_search("t", k)) == ["b"]
    with pytest.raises(ValueError):
        collections.open_store(spark, "memory").keyword_search("t", k)
    with pytest.raises(ValueError, match="Unknown engine"):
        collections.open_store(spark, "cloud")


def test_merge_and_operator_dialect(spark, tmp_path):
    s = collections.open_store(spark, "persistent", str(tmp_path), dialect="operators", merge=True, distance="l2sq", embedder=embedding.hashing_embedder(4))
    s.upsert("t", spark.createDataFrame(ROWS, SCHEMA))
    s.upsert("t", spark.createDataFrame([("a", None, "later", None)], SCHEMA))
    a = s.get("t", ids=["a"]).first()
    assert a["vector"] == [1.0, 0.0] and a["document"] == "later" and a["metadata"] == {"lang": "en"}
    s.delete("t", where={"lang": {"$ne": "en"}}, where_document={"$contains": "do"})
    assert ids(s.get_collection("t")) == ["a", "c"]
    s.upsert("e", spark.createDataFrame([("x", "some text")], "id STRING, document STRING"))
    assert len(s.get("e", ids=["x"]).first()["vector"]) == 4
    s.persist()
    s.close()
    s.close()


def test_payload(spark):
    df = spark.createDataFrame([("a", "doc", {"k": "v", "document": "old", "_kb_id": "z"}), ("b", None, None)], "id STRING, d STRING, m MAP<STRING,STRING>")
    p = df.select("id", collections.payload(F.col("m"), F.col("d"), F.col("id")).alias("p"))
    got = {r["id"]: r["p"] for r in p.collect()}
    assert got["a"] == {"k": "v", "document": "doc", "_kb_id": "a"} and got["b"] == {"_kb_id": "b"}
    assert {r["id"]: r["m"] for r in p.select("id", collections.record_metadata(F.col("p")).alias("m")).collect()}["b"] is None


def test_ingest_and_sinks(spark, tmp_path):
    spark.createDataFrame([(1, "x"), (2, "'; drop table t; --")], "id INT, name STRING").createOrReplaceTempView("t_ingest")
    with ingest.SqlIngestor(spark) as i:
        assert i.ingest("select id from t_ingest where name = :n", {"n": "'; drop table t; --"}).collect()[0][0] == 2
        assert i.a_ingest("select * from t_ingest").result().count() == 2
        assert len(list(ingest.SqlIngestor(spark, stream=True).ingest("select * from t_ingest"))) == 2
    i.close()
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3, 4, 5), "é")], "id INT, at TIMESTAMP, s STRING").withColumn("d", F.lit("1.50").cast("decimal(5,2)")).withColumn("day", F.lit("2024-01-02").cast("date"))
    ingest.write_json_array(df, str(tmp_path / "sub" / "a.json"))
    text = (tmp_path / "sub" / "a.json").read_text()
    assert json.loads(text) == [{"id": 1, "at": "2024-01-02T03:04:05", "s": "é", "d": "1.50", "day": "2024-01-02"}] and "é" in text
    ingest.write_json_array(df.filter("false"), str(tmp_path / "e.json"))
    assert json.loads((tmp_path / "e.json").read_text()) == []
    ingest.write_ndjson(df, str(tmp_path / "n"))
    assert spark.read.json(str(tmp_path / "n")).count() == 1
    ingest.write_result(spark, {"a": dt.date(2024, 1, 2)}, str(tmp_path / "o.json"))
    ingest.write_result(spark, df.select("id", "s", "day").toLocalIterator(), str(tmp_path / "l.json"))
    assert (tmp_path / "l.json").read_text() == '{"id": 1, "s": "é", "day": "2024-01-02"}\n'
    assert json.loads((tmp_path / "o.json").read_text()) == {"a": "2024-01-02"}


def test_jdbc(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    with ingest.SqlIngestor(spark, url) as i:
        assert i.ingest("CREATE TABLE people (id INT, name VARCHAR(40), born DATE, seen TIMESTAMP)") == {"rowcount": 0}
        for n, name in enumerate(["ann", "o'hara", ":ann", None]):
            p = {"i": n, "n": name, "b": dt.date(2000, 1, n + 1), "s": dt.datetime(2024, 1, 1, 12, n)}
            assert i.ingest("INSERT INTO people VALUES (:i, :n, :b, :s)" if name else "INSERT INTO people VALUES (:i, NULL, :b, :s)", p) == {"rowcount": 1}
        assert i.ingest("UPDATE people SET name = :n WHERE id >= :i", {"n": "x; DROP TABLE people", "i": 3}) == {"rowcount": 1}
        got = lambda q, **p: sorted(r[0] for r in i.ingest(q, p).collect())
        assert got("SELECT id FROM people WHERE name = :n", n="o'hara") == [1] and got("SELECT id FROM people WHERE name = ':ann' AND id > :i", i=1) == [2]
        assert got("SELECT id FROM people WHERE born >= :b", b=dt.date(2000, 1, 3)) == [2, 3] and got("SELECT id FROM people WHERE seen < :s", s=dt.datetime(2024, 1, 1, 12, 2)) == [0, 1]
        with pytest.raises(ValueError, match="no value"):
            i.ingest("SELECT id FROM people WHERE id = :nope", {})
        with pytest.raises(ValueError, match="backslashes"):
            i.ingest("SELECT id FROM people WHERE name = :n", {"n": "\\"})
        assert i.frame("SELECT id FROM people", split=("ID", 0, 4, 2)).rdd.getNumPartitions() == 2
        assert len(list(ingest.SqlIngestor(spark, url, stream=True).ingest("SELECT id FROM people"))) == 4
        assert i.a_ingest("SELECT id FROM people").result().count() == 4


def test_jdbc_read_by_the_driver(spark, tmp_path, monkeypatch):
    url = f"jdbc:derby:memory:{tmp_path.name};create=true"
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    plain = ingest.SqlIngestor(spark, url)
    plain.execute("CREATE TABLE t (k BIGINT, s CLOB, d DATE, seen TIMESTAMP, x DOUBLE, c CHAR(5), n DECIMAL(9,2), b BOOLEAN, y BLOB)")
    for k in range(7):
        plain.execute("INSERT INTO t (k, s, d, seen, x, c, n, b) VALUES (:k, :s, :d, :seen, :x, 'ab', 1.25, :b)", {"k": k, "s": "é" * k, "d": dt.date(2024, 1, 1 + k), "seen": dt.datetime(2024, 1, 2, 3, 4, k, 123456), "x": k / 4, "b": k > 3})
    plain.execute("INSERT INTO t (k) VALUES (NULL)")
    q, p = "SELECT * FROM t WHERE k >= :low OR k IS NULL ORDER BY k DESC", {"low": 1}
    want = plain.frame(q, p)
    rows = want.collect()
    monkeypatch.setattr(ingest.SqlIngestor, "_driver_only", lambda self: True)
    i, s = ingest.SqlIngestor(spark, url), ingest.SqlIngestor(spark, url, stream=True)
    for n in (1, 3, 7, 1000, 0):  # blocks of one row, with a rest, without one, larger than the result, and of the usual size
        got = i.ingest(q, p, chunk_size=n)
        assert len(rows) == 7 and got.schema == want.schema and sorted(got.collect(), key=str) == sorted(rows, key=str)
        assert list(s.ingest(q, p, chunk_size=n)) == rows
    assert i.ingest(q.replace(" OR ", " AND "), p).collect() == [] == list(s.ingest(q.replace(" OR ", " AND "), p))
    next(s.ingest(q, p, chunk_size=1))  # a stream that is given up leaves nothing locked
    assert i.ingest("UPDATE t SET k = 0 WHERE k > :low", p) == {"rowcount": 5}


@pytest.mark.parametrize(("url", "inside"), [("derby:/a/b", True), ("derby:memory:x", True), ("derby://h:1527/x", False), ("h2:mem:x", True), ("h2:tcp://h/x", False), ("hsqldb:file:x", True), ("hsqldb:hsqls://h/x", False), ("sqlite:x", True), ("mysql://h/x", False), ("postgresql://h/x", False)])
def test_databases_inside_the_driver(spark, monkeypatch, url, inside):
    i = ingest.SqlIngestor(spark, f"jdbc:{url}")
    assert not i._driver_only()  # here executors are the driver
    monkeypatch.setattr(i, "spark", SimpleNamespace(sparkContext=SimpleNamespace(_jsc=SimpleNamespace(sc=lambda: SimpleNamespace(isLocal=lambda: False)))))
    assert i._driver_only() == inside


ON_CLUSTER = """
import sys
from pyspark.sql import SparkSession
conf = {"spark.master": "local-cluster[2,1,1024]", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.checkpoint.dir": "file://" + sys.argv[1] + "/shared", "spark.sql.session.timeZone": "UTC"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
from tessera.plans import catalog
from tessera.sources.ingest import SqlIngestor
print("ROW", *catalog.QUERIES["ingest_jdbc"](spark, sys.argv[2]).first())
with SqlIngestor(spark, "jdbc:derby:memory:x;create=true", stream=True) as i:
    i.ingest("CREATE TABLE t (k INT)")
    print("ROW", i.ingest("INSERT INTO t VALUES 3, 1, 2")["rowcount"], *[r[0] for r in i.ingest("SELECT k FROM t ORDER BY k", chunk_size=2)])
spark.stop()
"""


def test_jdbc_on_a_cluster(spark, tmp_path):
    """Executors are processes of their own; the nations are many, some without a region or of a negative one, one with a long name."""
    rows = [(k, "n" * (k == 5 and 99 or 3), None if k % 9 == 8 else k % 9 - 3) for k in range(1100)]
    data, home = tmp_path / "in", tmp_path / "home"
    spark.createDataFrame(rows, "n_nationkey INT, n_name STRING, n_regionkey INT").write.parquet(str(data / "nation.parquet"))
    (home / "work").mkdir(parents=True)
    for p in Path(pyspark.__file__).parent.iterdir():  # the executors' logs go to work in Spark's home
        if p.name != "work":
            (home / p.name).symlink_to(p)
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_", "SPARK_"))}
    env |= {"SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_DIRS": str(tmp_path / "local"), "PYTHONPATH": str(Path(__file__).parents[1]), "PYSPARK_PYTHON": sys.executable}
    said = subprocess.run([sys.executable, "-c", ON_CLUSTER, str(tmp_path), str(data)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=240)
    total = sum(0 if r == 2 else k for k, _, r in rows)
    got = [x for x in said.stdout.splitlines() if x.startswith("ROW")]
    assert got == [f"ROW 1100 {sum(r == 2 for *_, r in rows)} {total}", "ROW 3 1 2 3"], said.stderr[-2000:]


def test_reading_is_repeated(spark, monkeypatch):
    calls = []

    def lost(df):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("lost")
        return df

    monkeypatch.setattr(ingest, "stored", lost)
    assert ingest.SqlIngestor(spark).fetched("select 1 as x").count() == 1 and len(calls) == 3


def test_retry():
    naps, calls = [], []

    @retry.retryable(sleep=naps.append)
    def flaky(n):
        calls.append(n)
        if len(calls) < 3:
            raise OSError("again")
        return n

    assert flaky(5) == 5 and naps == [0.25, 0.5]

    @retry.retryable(sleep=naps.append)
    def always():
        raise OSError("down")

    naps.clear()
    with pytest.raises(OSError, match="down"):
        always()
    assert naps == [0.25, 0.5, 1.0, 2.0, 4.0]


def test_checkpoints(spark, tmp_path):
    c = checkpoints.Marks(spark, str(tmp_path / "cp.json"))
    assert c.of("k") is None and c.all() == {}
    (tmp_path / "cp.json").write_text('{"half": {"ts": 1}, "odd": {"updated_at": null, "more": 5}}')
    c.advance("k", "2024-01-01T00:00:00", 5)
    assert c.of("k")[:2] == ("2024-01-01T00:00:00", 5) and c.of("k").ts > 0 and c.of("half") == ("", 0, 1) and c.of("odd") == ("", 0, 0)
    assert json.loads((tmp_path / "cp.json").read_text())["k"]["last_id"] == 5
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "t INT, id INT")
    assert checkpoints.read_after(df, "t", "id", (F.lit(1), F.lit(1))).count() == 2 and checkpoints.read_after(df, "t", "id", None).count() == 3
    assert checkpoints.new_mark(df, "t", "id") == (2, 1) and checkpoints.new_mark(df.filter("false"), "t", "id") is None


def test_whole_texts(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.md").write_text("# A\n\nx")
    assert files.whole_texts(spark, str(tmp_path), str(tmp_path)).collect()[0].asDict() == {"source_path": "p/a.md", "text": "# A\n\nx"}


def test_stream(spark, tmp_path):
    s = collections.open_store(spark, "persistent", str(tmp_path / "store"))
    src = str(tmp_path / "in")
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(src)
    for n in (3, 4):
        upserts.upsert_stream(upserts.read_stream(spark, src, SCHEMA), s, "t", str(tmp_path / "cp")).awaitTermination(60)
        assert s.count("t") == n
        spark.createDataFrame([("z", None, "new", None)], SCHEMA).write.mode("append").parquet(src)
