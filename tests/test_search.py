import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.operators import fusion, keyword, rerank, search
from tessera.operators.filters import document_filter, operator_filter, plain_filter


@pytest.mark.parametrize("metric", sorted(V.MEASURES))
def test_knn_ties_nulls_and_odd_vectors(spark, metric):
    rows = [("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.0, 1.0]), ("z", [0.0, 0.0]), ("n", None), ("s", [1.0]), ("x", [float("nan"), 1.0])]
    r = spark.createDataFrame(rows, "id STRING, vector ARRAY<DOUBLE>")
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "query_id BIGINT, vector ARRAY<DOUBLE>")
    got = [x["id"] for x in search.knn(r, q, 2, metric, digits=6).orderBy("query_id", "rank").collect()]
    assert got == ["a", "b"]
    assert search.knn(r, q.filter("query_id = 2"), 2, metric).count() == 0
    assert search.knn(r.filter("false"), q, 2, metric).count() == 0


def test_knn_equals_expression(spark):
    rng = np.random.default_rng(1)
    r = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(300)], "id BIGINT, vector ARRAY<DOUBLE>")
    q = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(9)], "query_id BIGINT, vector ARRAY<DOUBLE>")
    for m in V.MEASURES:
        a = search.knn(r, q, 5, m, digits=6, block=4).select("query_id", "rank", "id").collect()
        assert set(a) == set(search.knn_expression(r, q, 5, m, digits=6).select("query_id", "rank", "id").collect())
    with pytest.raises(ValueError, match="Unknown distance"):
        search.knn(r, q, 5, "other")


def test_zero_vector_cosine(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0]), (None, [1.0]), ([1.0], [1.0, 2.0])], "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>")
    assert [r[0] for r in df.select(V.cosine(F.col("a"), F.col("b"))).collect()] == [0.0, None, None]


def test_masked_mean(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0], 1), ("a", [3.0, 4.0], 1), ("a", [9.0, 9.0], 0), ("b", [5.0, 5.0], 0)], "k STRING, v ARRAY<DOUBLE>, m INT")
    got = {r["k"]: r["vector"] for r in V.masked_mean(df, "k", "v", "m").collect()}
    assert got == {"a": [2.0, 3.0], "b": [0.0, 0.0]}


def okapi_plain(docs, query):
    toks = {i: t.split() for i, t in docs.items()}
    n, avg = len(docs), sum(map(len, toks.values())) / len(docs)
    df = {}
    for t in toks.values():
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: floor if x < 0 else x for w, x in idf.items()}
    return {i: sum(idf.get(w, 0) * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / avg)) for w in query.split()) for i, t in toks.items()}


def test_okapi(spark):
    docs = {"a": "the cat sat", "b": "the dog sat sat", "c": "the the fish", "d": "bird"}
    df = spark.createDataFrame(list(docs.items()), "id STRING, text STRING")
    q = spark.createDataFrame([(1, "sat the sat"), (2, "zzz"), (3, "")], "query_id BIGINT, text STRING")
    got = {(r["query_id"], r["id"]): (r["rank"], r["score"]) for r in keyword.okapi(df, q, 10).collect()}
    assert len(got) == 12
    for i, s in okapi_plain(docs, "sat the sat").items():
        assert got[1, i][1] == pytest.approx(s, abs=1e-9)
    assert [got[2, i] for i in "abcd"] == [(1, 0.0), (2, 0.0), (3, 0.0), (4, 0.0)]
    assert keyword.okapi(df.filter("false"), q, 10).count() == 0
    assert keyword.okapi(df.select("id", F.lit("").alias("text")), q, 10).count() == 0


def test_single_document_scores_negative_and_stays(spark):
    df = spark.createDataFrame([("a", "cat dog")], "id STRING, text STRING")
    r = keyword.okapi(df, spark.createDataFrame([(1, "cat")], "query_id BIGINT, text STRING"), 5).collect()
    assert [x["id"] for x in r] == ["a"] and r[0]["score"] < 0


def test_sparse_only_matching(spark):
    df = spark.createDataFrame([("a", "cat dog", "x"), ("b", "cat", "y"), ("c", "fish", "x"), ("e", None, "x")], "id STRING, text STRING, zone STRING")
    q = spark.createDataFrame([(1, "cat"), (2, "zzz")], "query_id BIGINT, text STRING")
    assert {r["id"] for r in keyword.sparse_idf(df, q).collect()} == {"a", "b"}
    assert [r["id"] for r in keyword.sparse_idf(df, q, where=plain_filter(df, {"zone": "x"})).collect()] == ["a"]


def test_keyword_index_keeps_first_position(spark):
    ix = keyword.KeywordIndex(spark.createDataFrame([("b", "same"), ("a", "same")], "id STRING, text STRING"))
    ix.upsert(spark.createDataFrame([("0", "same"), ("b", "same")], "id STRING, text STRING"))
    q = spark.createDataFrame([(1, "other")], "query_id BIGINT, text STRING")
    assert [r["id"] for r in ix.search(q).orderBy("rank").collect()] == ["a", "b", "0"]
    ix.delete(["a"])
    assert [r["id"] for r in ix.search(q).orderBy("rank").collect()] == ["b", "0"]
    ix.close()
    assert ix.search(q).count() == 0


def test_rrf(spark):
    a = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "a")], "query_id BIGINT, rank BIGINT, id STRING")
    b = spark.createDataFrame([(1, 1, "c"), (1, 2, "a")], "query_id BIGINT, rank BIGINT, id STRING")
    got = fusion.rrf(fusion.as_lanes(a, b)).orderBy("rank").collect()
    assert [(r["id"], r["score"]) for r in got] == [("a", pytest.approx(1 / 61 + 1 / 63 + 1 / 62)), ("c", pytest.approx(1 / 61)), ("b", pytest.approx(1 / 62))]
    assert fusion.rrf(fusion.as_lanes(a.filter("false"))).count() == 0


def test_mmr(spark):
    v = np.array([[1, 0, 0], [0.99, 0.01, 0], [0, 1, 0]])
    s = np.array([0.9, 0.85, 0.5])
    assert rerank.mmr_order(v, s, 3, 1.0) == [0, 1, 2]
    assert rerank.mmr_order(v, s, 3, 0.3) == [0, 2, 1]
    assert rerank.mmr_order(v, s, 0, 0.5) == [0]
    assert rerank.mmr_order(np.zeros((2, 3)), np.array([1.0, 1.0]), 2, 0.5) == [0, 1]
    assert rerank.mmr_order(v[:0], s[:0], 2, 0.5) == []
    h = spark.createDataFrame([(1, i + 1, str(i), v[i].tolist(), float(s[i])) for i in range(3)], "query_id BIGINT, rank BIGINT, id STRING, vector ARRAY<DOUBLE>, score DOUBLE")
    assert [r["old_rank"] for r in rerank.mmr(h, 2, 0.3).orderBy("new_rank").collect()] == [1, 3]
    with pytest.raises(Exception, match="lacks a vector or a score"):
        rerank.mmr(h.withColumn("score", F.lit(None).cast("double"))).collect()


def test_pair_rerank(spark):
    h = spark.createDataFrame([(1, 1, "red cat", "a dog"), (1, 2, "red cat", "the red cat"), (1, 3, "red cat", None)], "query_id BIGINT, rank BIGINT, query STRING, text STRING")
    assert [r["old_rank"] for r in rerank.pair_rerank(h, rerank.overlap_scorer).orderBy("new_rank").collect()] == [2, 1, 3]
    assert rerank.pair_rerank(h, rerank.overlap_scorer, 0).count() == 0


def test_filters(spark):
    df = spark.createDataFrame([("a", "x", {"lang": "en", "n": "5"}), ("b", None, {"lang": "pt"}), ("c", "y", None)], "id STRING, zone STRING, metadata MAP<STRING,STRING>")

    def ids(c):
        return [r["id"] for r in df.filter(c).orderBy("id").collect()]

    assert ids(plain_filter(df, None)) == ids(plain_filter(df, {})) == ["a", "b", "c"]
    assert ids(plain_filter(df, {"zone": ["x", "y"]})) == ["a", "c"]
    assert ids(plain_filter(df, {"zone": "x", "lang": "en"})) == ["a"]
    assert ids(~plain_filter(df, {"zone": "x"})) == ["b", "c"]
    assert ids(operator_filter(df, {"$or": [{"zone": {"$eq": "y"}}, {"n": {"$gte": 5}}]})) == ["a", "c"]
    assert ids(operator_filter(df, {"lang": {"$nin": ["en"]}})) == ["b"]
    assert ids(document_filter({"$or": [{"$contains": "x"}, {"$contains": "y"}]}, "zone")) == ["a", "c"]
    with pytest.raises(ValueError):
        operator_filter(df, {"zone": {"$like": "x"}})


def test_components_share_their_interfaces(spark):
    from tessera import interfaces
    from tessera.operators import chunking, collections, html

    assert issubclass(keyword.KeywordIndex, interfaces.BaseKeywordIndex) and issubclass(keyword.NativeKeywordIndex, interfaces.BaseKeywordIndex)
    assert isinstance(collections.open_store(spark, "memory"), interfaces.SupportsKeywordSearch) and not isinstance(object(), interfaces.SupportsKeywordSearch)
    for base in (interfaces.BaseIngestor, interfaces.BasePreprocessor, interfaces.BaseChunker, interfaces.BaseKeywordIndex, interfaces.BaseFusor, interfaces.BaseReranker):
        with pytest.raises(TypeError):
            base()
    lanes = spark.createDataFrame([(1, 0, 1, "a"), (1, 0, 2, "b"), (1, 1, 1, "b")], "query_id BIGINT, lane INT, rank INT, id STRING")
    assert [r["id"] for r in fusion.ReciprocalRankFusor(60).fuse(lanes).orderBy("rank").collect()] == ["b", "a"]
    docs = spark.createDataFrame([("d", "one two three four five"), ("n", None), ("e", "")], "doc_id STRING, text STRING")
    assert [r["id"] for r in chunking.WindowChunker(3, 1).chunk(docs).orderBy("id").collect()] == ["d:000000", "d:000001"]
    assert chunking.RecursiveChunker(50, 5).chunk(docs).count() == 2
    with pytest.raises(ValueError):
        chunking.RecursiveChunker(5, 5)
    page = spark.createDataFrame([("p", "<h1>A</h1>")], "doc_key STRING, html STRING")
    assert html.HtmlPreprocessor().process(page).first()["markdown"] == "# A"
    with pytest.raises(ValueError):
        rerank.MmrReranker(1.5)


def test_pair_scores_take_the_text_from_document_or_metadata(spark):
    rows = [(1, 1, "red fox", None, {"document": "a red fox"}), (1, 2, "red fox", "", None), (1, 3, "red fox", "red", {"document": "x"})]
    hits = spark.createDataFrame(rows, "query_id BIGINT, rank BIGINT, query STRING, document STRING, metadata MAP<STRING,STRING>")
    got = rerank.PairReranker(rerank.overlap_scorer).rerank(hits).orderBy("new_rank").collect()
    assert [(r["old_rank"], r["score"]) for r in got] == [(1, 1.0), (3, 0.5), (2, 0.0)]


def test_models_are_loaded_by_the_worker(tmp_path, monkeypatch):
    import sys
    import types

    from tessera.operators import embedding

    with pytest.raises(FileNotFoundError):
        embedding.local_embedder(str(tmp_path / "none"))()
    with pytest.raises(RuntimeError, match="raw checkpoint"):
        embedding.local_embedder(str(tmp_path))()
    fake = types.ModuleType("sentence_transformers")
    fake.SentenceTransformer = lambda name, device=None: types.SimpleNamespace(encode=lambda texts, **_: np.ones((len(texts), 2)))
    fake.CrossEncoder = lambda name, device=None: types.SimpleNamespace(predict=lambda pairs, batch_size: [len(b) for _, b in pairs])
    monkeypatch.setitem(sys.modules, "sentence_transformers", fake)
    (tmp_path / "modules.json").write_text("[]")
    assert embedding.packaged(str(tmp_path)) and embedding.local_embedder(str(tmp_path))()(["a", "b"]) == [[1.0, 1.0], [1.0, 1.0]]
    assert rerank.model_scorer("m")()(["q", "q"], ["a", "bcd"]) == [1.0, 3.0] and rerank.model_scorer("m")()([], []) == []
    monkeypatch.setitem(sys.modules, "sentence_transformers", None)
    with pytest.raises(RuntimeError):
        rerank.model_scorer("m")()


def test_keyword_edge_cases(spark):
    docs = spark.createDataFrame([("a", "cat cat dog", 1), ("b", None, 2), ("c", "", 3), ("d", "dog", 4)], "id STRING, text STRING, score INT")
    qs = spark.createDataFrame([(1, "cat"), (2, None), (3, "zebra"), (None, "cat"), (1, "dog")], "query_id BIGINT, text STRING")
    o = {(r["query_id"], r["rank"]): r["id"] for r in keyword.okapi(docs, qs, 3).collect()}
    assert o[1, 1] == "a" and [o[2, k] for k in (1, 2, 3)] == ["a", "b", "c"] == [o[3, k] for k in (1, 2, 3)] and len(o) == 9
    s = keyword.sparse_idf(docs, qs, 3).collect()
    assert {(r["query_id"], r["id"]) for r in s} == {(1, "a"), (1, "d")}
    ready = keyword.with_sparse(docs.select("id", "text"), "text")
    assert sorted(map(tuple, keyword.sparse_idf(ready, qs, 3).collect())) == sorted(map(tuple, s))
    none = docs.filter("false")
    assert keyword.okapi(none, qs, 3).count() == keyword.sparse_idf(none, qs, 3).count() == keyword.okapi(docs, qs.filter("false"), 3).count() == keyword.sparse_idf(docs, qs.filter("false"), 3).count() == 0
    with pytest.raises(ValueError, match="at most"):
        keyword.okapi(docs, qs, 3, most=2)
    long = spark.createDataFrame([(1, "word " * 200_000)], "query_id BIGINT, text STRING")
    assert keyword.okapi(docs, long, 1).count() == 1


def test_best_scores_keep_ties_in_order():
    best = keyword._Best(2, 1)
    assert best.keep(np.array([[1.0], [3.0], [3.0], [3.0]])).ravel().tolist() == [False, True, True, False]
    assert best.keep(np.array([[2.0], [3.0], [4.0]])).ravel().tolist() == [False, True, True]
    assert best.keep(np.array([[2.0], [5.0]])).ravel().tolist() == [False, True]
