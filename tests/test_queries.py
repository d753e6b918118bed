"""Every registered query of the core against its SQL, or at least run to the end."""

import re

import pytest

from tessera.plans import catalog

from .oracle import assert_same, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_as_sql(spark, sf_dir, con, name):
    assert_same(catalog.QUERIES[name](spark, sf_dir), con, catalog.SQL[name])


def test_every_query_is_checked():
    assert set(catalog.QUERIES) - set(catalog.SQL) == {"chunk_recursive", "html_markdown"}  # these two below


def test_recursive_chunks_of_documents(spark, sf_dir):
    texts = {str(r["doc_id"]): r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    by_doc = {}
    for r in catalog.QUERIES["chunk_recursive"](spark, sf_dir).collect():
        m = {e["key"]: e["value"] for e in r["metadata"]}
        assert r["id"] == f"{m['doc_id']}:{int(m['order']):06d}" and int(m["tok"]) <= 200 and r["text"] in texts[m["doc_id"]]
        by_doc.setdefault(m["doc_id"], {})[int(m["order"])] = r["text"]
    assert set(by_doc) == {k for k, t in texts.items() if t is not None}
    for doc, parts in by_doc.items():
        assert sorted(parts) == list(range(len(parts)))
        reach = 0  # chunks follow each other, each from within or at the end of the one before
        for k in range(len(parts)):
            at = texts[doc].find(parts[k], max(0, reach - len(parts[k])))
            assert 0 <= at <= reach or not parts[k]
            reach = max(reach, at + len(parts[k]))
        assert reach == len(texts[doc])


def test_markdown_of_results(spark, sf_dir):
    got = sorted((r["doc_key"], r["markdown"] or "", r["text"] or "") for r in catalog.QUERIES["html_markdown"](spark, sf_dir).collect())
    rows = spark.read.parquet(f"{sf_dir}/preprocess_results.parquet").select("doc_key", "text").collect()
    assert len(got) == len(rows) > 50
    for key, markdown, text in got:
        assert "<script" not in markdown.lower() and not re.search(r"\]\((?:javascript|file):", markdown, re.I)
    plain = [r for r in rows if r["text"] and not re.search("[<>&]", r["text"])]
    by_key = {k: (m, t) for k, m, t in got}
    assert plain and all(re.sub(r"\s+", " ", by_key[r["doc_key"]][0]).strip() == re.sub(r"\s+", " ", r["text"]).strip() for r in plain)


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(catalog.QUERIES) <= set(e.queries())
