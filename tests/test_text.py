import hashlib
import re
import uuid
from collections import Counter

from pyspark.sql import functions as F

from tessera.functions.ids import chunk_id, parent_of, point_uuid
from tessera.functions.text import normalize_accents, strip_marks, term_frequencies, term_frequency_map, token_index, tokens

TEXTS = ["SN-X2047-QR", "verificação de São Paulo", "ação-teste", "hello world hello", "", None, "a--b", "3×4 ÷ 2", "éte", "İstanbul", "日本語 text", "a_b.c/d"]


def plain_tokens(text):
    out = []
    for m in re.finditer("[a-z0-9À-ž]+(?:[-_./][a-z0-9À-ž]+)*", (text or "").lower()):
        forms = []
        for f in (m[0], re.sub("[-_./]", "", m[0])):
            forms.append(f)
        forms = [forms[0], forms[1], strip_marks(forms[0]), strip_marks(forms[1])]
        out += list(dict.fromkeys(forms))
    return out


def test_tokens(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i INT, t STRING")
    for r in df.select("t", tokens("t").alias("x")).collect():
        assert r["x"] == plain_tokens(r["t"])


def test_accents(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, "Ṩ ａ क़"]], "t STRING")
    for r in df.select("t", normalize_accents("t").alias("x")).collect():
        assert r["x"] == (None if r["t"] is None else strip_marks(r["t"]))


def test_token_index(spark):
    ts = [f"t{i}" for i in range(200)] + ["ação", ""]
    for size in (2**31 - 1, 1000, 7, 2**31):
        got = spark.createDataFrame([(t,) for t in ts], "t STRING").select("t", token_index("t", size).alias("i")).collect()
        assert all(r["i"] == int(hashlib.md5(r["t"].encode()).hexdigest(), 16) % size for r in got)


def test_later_token_replaces_on_collision(spark):
    df = spark.createDataFrame([(1, "a b a c"), (2, ""), (3, None)], "id INT, text STRING")
    got = {(r["id"], r["idx"]): r["tf"] for r in term_frequencies(df, "id", "text", 1).collect()}
    assert got == {(1, 0): 1.0}  # c comes last, once
    full = {r["id"]: r["tf"] for r in term_frequency_map(df, "id", "text").collect()}
    assert sum(full[1].values()) == 4.0 and full[2] == {} and full[3] == {}
    assert Counter(full[1].values()) == {2.0: 1, 1.0: 2}


def test_point_uuid(spark):
    ids = ["doc-1:000042", "é", "", "x" * 300]
    ns = uuid.UUID("b3c9d7e8-4f2a-5b6c-8d9e-0a1b2c3d4e5f")
    for r in spark.createDataFrame([(i,) for i in [*ids, None]], "i STRING").select("i", point_uuid("i").alias("u")).collect():
        assert r["u"] == (None if r["i"] is None else str(uuid.uuid5(ns, r["i"])))


def test_chunk_and_parent_ids(spark):
    df = spark.createDataFrame([("a", {"doc_id": "d"}), ("b", {"doc_id": ""}), ("c", None)], "id STRING, m MAP<STRING,STRING>")
    assert [r[0] for r in df.select(parent_of(F.col("m"), F.col("id"))).collect()] == ["d", "b", "c"]
    assert df.select(chunk_id(F.lit("d"), F.lit(7))).first()[0] == "d:000007"
