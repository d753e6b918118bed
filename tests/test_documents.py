import base64
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import chunking, documents, embedding, html, postprocess

PNG = b"\x89PNG-not-really"
URI = "data:image/png;base64," + base64.b64encode(PNG).decode()
ENC = chunking.RegexCodec()


@settings(max_examples=60, deadline=None)
@given(st.text("ab .\n", max_size=200), st.integers(2, 12), st.integers(0, 5))
def test_recursive_chunks_respect_size_and_lose_nothing(text, size, overlap):
    overlap = min(overlap, size - 1)
    parts = chunking.split_recursive(text, size, overlap, ENC)
    assert all(sum(len(ENC.encode(x)) for x in [p]) <= size or size < 3 for p in parts)
    if overlap == 0:
        assert "".join(parts) == text


def test_recursive_chunks_table(spark):
    df = spark.createDataFrame([("d", "one two three. " * 30, {"order": "own", "lang": "en"}), ("e", "", None), ("n", None, None)], "doc_id STRING, text STRING, m MAP<STRING,STRING>")
    got = chunking.recursive_chunks(df, 50, 10, metadata="m").orderBy("id").collect()
    assert [r["id"] for r in got if r["id"].startswith("d")][:2] == ["d:000000", "d:000001"]
    assert got[0]["metadata"]["lang"] == "en" and got[0]["metadata"]["order"] == "0"
    assert [(r["id"], r["text"]) for r in got if r["id"][0] in "en"] == [("e:000000", "")]
    with pytest.raises(ValueError):
        chunking.recursive_chunks(df, 10, 10)


def test_letters_without_separators():
    assert chunking.split_recursive("x" * 100, 10, 2, type("L", (), {"encode": lambda s, t: list(t), "decode": lambda s, t: "".join(t)})()) != []


def test_token_windows(spark):
    df = spark.createDataFrame([("a", " ".join(map(str, range(25)))), ("b", "x"), ("c", "  "), ("d", None)], "doc_id STRING, text STRING")
    got = {r["id"]: r["text"].split() for r in chunking.token_windows(df, 10, 2).collect()}
    assert got["a:000000"] == [str(i) for i in range(10)] and got["a:000001"][0] == "8" and got["a:000002"][-1] == "24" and "a:000003" not in got
    assert got["b:000000"] == ["x"] and not any(k[0] in "cd" for k in got)


def test_html_markdown_and_text():
    r = html.convert("<h1>Title</h1><p>Some <b>bold</b> and <a href='https://x.invalid'>link</a></p><ul><li>one<li>two</ul>", "d")
    assert r["markdown"] == "# Title\n\nSome **bold** and [link](https://x.invalid)\n\n* one\n* two"
    assert r["text"] == "Title Some bold and link one two"
    assert html.convert("", "d") == {"markdown": "", "text": "", "images": []}
    assert "alert" in html.convert("<script>alert(1)</script>x")["text"] and "alert" not in html.convert("<script>alert(1)</script>x", drop_script=True)["text"]
    assert "javascript" not in html.convert("<a href='javascript:x()'>y</a>")["markdown"]


def test_html_images():
    sha = hashlib.sha256(PNG).hexdigest()
    r = html.convert(f"<p>a <img src='{URI}' alt='tiny'> b</p>", "doc")
    assert r["images"][0]["sha256"] == sha and r["images"][0]["path"] == f"images/doc-{sha[:12]}.png"
    assert f"![tiny](images/doc-{sha[:12]}.png)" in r["markdown"] and "data:" not in r["markdown"] and r["text"] == "a tiny b"
    assert "[image: invalid-data-uri]" in html.convert("<img src='data:image/png;base64,@@@'>")["markdown"]
    fig = html.convert(f"<figure><img src='{URI}'><figcaption>A cap</figcaption></figure>")
    assert fig["images"][0]["caption"] == "A cap" and "![A cap]" in fig["markdown"]
    em = html.convert("<p><img src='https://x.invalid/i.png' title='t'><em>says</em></p>")
    assert "![t](https://x.invalid/i.png) _says_" in em["markdown"] and em["text"].startswith("says")
    assert "[image]" in html.convert("<img src='https://x.invalid/i.png'>", keep_remote=False)["markdown"]
    two = html.convert(f"<img src='{URI}'><img src='{URI}'>")
    assert len(two["images"]) == 2 and len({i["path"] for i in two["images"]}) == 1
    assert html.decode_data_uri("data:,a%20b") == (b"a b", "text/plain")


def test_html_protocols_and_depth():
    page = '<p><a href="tel:+1">call</a> <a href="file:///etc/passwd">file</a> <a href="JavaScript:x">js</a> <a href="mailto:a@b.c">mail</a></p>'
    assert html.convert(page)["markdown"] == "[call](tel:+1) file js [mail](mailto:a@b.c)"
    r = html.convert('<img src="DATA:Image/PNG;BASE64,aGk=" alt="x">')
    assert r["images"][0]["content"] == b"hi" and r["images"][0]["mime"] == "image/png" and r["images"][0]["path"].endswith(".png")
    for n in (1_000, 10_000):
        r = html.convert("<div>" * n + "deep bold" + "</div>" * n + "<p>after</p>")
        assert r["text"] == "deep bold after" and r["markdown"] == "deep bold\n\nafter"


def test_html_table_and_files(spark, tmp_path):
    df = spark.createDataFrame([("a", f"<p>x</p><img src='{URI}'>"), ("b", None), ("c", "")], "doc_key STRING, html STRING")
    r = html.html_to_result(df)
    got = {x["doc_key"]: x for x in r.collect()}
    assert got["b"]["text"] is None and got["b"]["images"] == [] and got["c"]["text"] == ""
    html.write_images(r, str(tmp_path))
    assert (tmp_path / got["a"]["images"][0]["path"]).read_bytes() == PNG


def test_required_fields(spark):
    df = spark.createDataFrame([("{\"a\": 1, \"b\": null}",), ("{}",), (None,), ("broken",)], "j STRING").withColumn("doc", documents.parse_documents("j"))
    m = [r["missing"] for r in documents.require_fields(df, "doc", ["a", "b"], strict=False).collect()]
    assert m == [[], ["a", "b"], ["a", "b"], ["a", "b"]]
    assert documents.require_fields(df.limit(1), "doc", ["a"]).count() == 1
    with pytest.raises(Exception, match="Missing required fields: a, b"):
        documents.require_fields(df, "doc", ["a", "b"]).collect()
    assert df.select(documents.field_or(F.col("doc"), "a", "-")).first()[0] == "1"


def test_embedding(spark):
    seen = list(embedding.batches([str(i) for i in range(5)], 2))
    assert [len(b) for b in seen] == [2, 2, 1] and len(list(embedding.batches(["x"] * 65, None))) == 2
    df = spark.createDataFrame([(1, "a b c d e"), (2, None), (3, "")], "id INT, document STRING")
    got = {r["id"]: r["vector"] for r in embedding.embed_table(embedding.hashing_embedder(8), df, "id", "document").collect()}
    assert got[2] is None and sum(x * x for x in got[1]) == pytest.approx(1.0, abs=1e-6) and got[3] == [0.0] * 8
    assert "vector" in embedding.resolve_vectors(df, None).columns
    import numpy as np

    h = np.arange(24).reshape(2, 3, 4)
    assert embedding.mean_pool(h, np.array([[1, 1, 0], [0, 0, 0]]))[0].tolist() == [2.0, 3.0, 4.0, 5.0]
    calls = []
    f = embedding.service_embedder("https://x.invalid", "m", "k", post=lambda b: calls.append(b) or {"data": [{"index": 1, "embedding": [2]}, {"index": 0, "embedding": [1]}]})()
    assert f(["a", "b"]) == [[1], [2]] and f([]) == [] and len(calls) == 1
    with pytest.raises(ValueError):
        embedding.service_embedder("u", "m", "")


def test_postprocess(spark):
    h = spark.createDataFrame(
        [(1, 1, "d1:0", 0.9, None, {"doc_id": "d1", "source_path": "p1"}), (1, 2, "d1:1", 0.8, "x", {"doc_id": "d1"}), (1, 3, "solo", None, "body", None)],
        "query_id BIGINT, rank BIGINT, id STRING, score DOUBLE, document STRING, metadata MAP<STRING,STRING>",
    )
    g = postprocess.group_by_parent(h)
    assert [(r["rank"], r["id"]) for r in g.orderBy("rank").collect()] == [(1, "d1:0"), (2, "solo")]
    p = spark.createDataFrame([("p1", "Full")], "source_path STRING, text STRING")
    r = {x["id"]: x for x in postprocess.resolve_parents(g, p).collect()}
    assert r["d1"]["document"] == "Full" and r["solo"]["document"] is None and r["solo"]["metadata"] == {}
    c = postprocess.context_window(h.withColumn("metadata", F.create_map(F.lit("title"), F.lit("T")))).first()["context"]
    assert c.startswith("=== RETRIEVED CONTEXT (top 3) ===\n\n[1] id=d1:0  title=T  score=0.9000\n\n\n[2]") and "[3] id=solo  title=T  score=n/a\nbody\n" in c
    assert "…" in postprocess.results_text(h.withColumn("document", F.lit("word " * 60)))
    assert postprocess.context_window(h.filter("false")).count() == 0
