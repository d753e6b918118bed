"""The package's queries on the test tables: with SQL, against brute force, or at least to the end."""

import collections
import re
import unicodedata

import numpy as np
import pytest

from tessera.llm import markup, registry

from ..oracle import assert_same, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_sql(spark, sf_dir, con, name):
    assert_same(registry.QUERIES[name](spark, sf_dir), con, registry.SQL[name])


def run(spark, sf_dir, name):
    return registry.QUERIES[name](spark, sf_dir).collect()


def test_every_query_is_checked():
    assert set(registry.QUERIES) - set(registry.SQL) == {"p3_pieces", "p6_clean", "p6_found", "p7_subset", "p8_leaks", "p9_mixture", "p9_shares", "p10_found", "p10_rates", "p10_scores"}  # all below


def test_pieces(spark, sf_dir, con):
    texts = {("result", k): (t, 3000) for k, t in con.execute("SELECT doc_key, text FROM preprocess_results WHERE text IS NOT NULL").fetchall()}
    texts |= {("chunk", k): (t, 900) for k, t in con.execute("SELECT id, text FROM chunks WHERE text IS NOT NULL").fetchall()}
    got = collections.defaultdict(dict)
    for r in run(spark, sf_dir, "p3_pieces"):
        got[r["record_kind"], r["record_id"]][r["piece"]] = r
    assert set(got) == set(texts)
    for key, pieces in got.items():
        t, most = texts[key]
        assert "".join(t[pieces[k]["start"] : pieces[k]["end"]] for k in range(len(pieces))) == t
        for p in pieces.values():
            assert p["text"] == t[p["overlap_start"] : p["end"]] and (len(pieces) == 1 or len(re.sub("[ \t\r\n\u00a0]+", " ", p["text"]).strip()) <= most)


def test_residue_of_all_texts(spark, sf_dir, con):
    rows = con.execute("SELECT DISTINCT doc_key, text, markdown FROM preprocess_results").fetchall()
    want = {(k, f, m) for k, t, d in rows for f, x in (("text", t), ("markdown", d)) for m in markup.scan(x, f == "markdown")}
    assert {tuple(r) for r in run(spark, sf_dir, "p6_found")} == want and len({m for _, _, m in want}) == 4
    cleaned = {(r["doc_key"], r["field_name"], r["cleaned"]) for r in run(spark, sf_dir, "p6_clean")}
    assert cleaned == {(k, f, markup.clean(x, f == "markdown")) for k, t, d in rows for f, x in (("text", t), ("markdown", d))}
    dirty = {(k, f) for k, f, _ in want}
    texts = {(k, f, x) for k, t, d in rows for f, x in (("text", t), ("markdown", d))}
    assert all((k, f, x) in cleaned for k, f, x in texts if (k, f) not in dirty)
    escaped = {(k, f) for k, f, x in texts if x and "&lt;" in x}  # a tag that was only spelled out comes out as it reads
    assert not [x for k, f, x in cleaned if x and (k, f) not in escaped and set(markup.scan(x, f == "markdown")) & {"html", "wiki"}]


def test_subset_of_records(spark, sf_dir, con):
    ids, _ = live_vectors(con, False)
    got = [r["id"] for r in run(spark, sf_dir, "p7_subset")]
    assert len(got) == len(set(got)) == min(1000, len(ids)) and set(got) <= set(ids)


def test_leaks_with_their_kinds(spark, sf_dir):
    rows = run(spark, sf_dir, "p8_leaks")
    found = {tuple(r) for r in run(spark, sf_dir, "p8_found")}
    assert found == {(r["doc_id"], r["item_id"]) for r in rows if r["kind"] == "exact"} and {r["kind"] for r in rows} <= {"exact", "paraphrase"}
    assert all((r["run"] >= 10) == (r["kind"] == "exact") and 0 <= r["in_order"] <= 1 and r["facts"] <= 1 for r in rows)
    assert all(r["facts"] == 1 and r["in_order"] >= 0.6 for r in rows if r["kind"] == "paraphrase")


def test_mixture_and_shares(spark, sf_dir, con):
    mix, targets = run(spark, sf_dir, "p9_mixture"), {k.strip().lower().replace("_", "-"): (t, m) for k, t, m in con.execute("SELECT * FROM mix_targets").fetchall()}
    used, tokens = collections.Counter((r["source"], r["block"]) for r in mix), collections.Counter()
    for r in mix:
        tokens[r["source"]] += r["n_tokens"]
        assert 0 < r["n_tokens"] == len(r["tokens"]) <= 512
    assert set(tokens) <= set(targets) and all(n <= targets[s][1] for (s, _), n in used.items())
    assert len({(r["shard"], r["slot"]) for r in mix}) == len(mix) > 0
    shares = {r["source"]: r for r in run(spark, sf_dir, "p9_shares")}
    assert set(shares) == set(targets)
    for s, r in shares.items():
        assert r["tokens"] == tokens[s] and r["actual_share"] == pytest.approx(tokens[s] / sum(tokens.values()), abs=1e-6) and r["most_uses"] <= r["max_repeats"]


def test_scores_of_all_documents(spark, sf_dir, con):
    scores = run(spark, sf_dir, "p10_scores")
    docs = dict(con.execute("SELECT doc_id, source FROM documents").fetchall())
    assert len(scores) == len(docs) and {r["doc_id"] for r in scores} == set(docs) and all(0 <= r["score"] <= 1 and (r["evidence"] is not None) == (r["score"] > 0) for r in scores)
    assert {r["doc_id"] for r in run(spark, sf_dir, "p10_found")} == {r["doc_id"] for r in scores if r["score"] >= 0.6}
    rates = run(spark, sf_dir, "p10_rates")
    assert sum(r["documents"] for r in rates) == len(docs) and sum(r["bad"] for r in rates) == sum(r["score"] >= 0.6 for r in scores)


def words(t):
    return re.findall("[0-9a-z]+", "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c)).lower())


def live_vectors(con, responses):
    got = {}
    for i, v in con.execute("SELECT id, vector FROM stored_records QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1").fetchall():
        got[i] = v
    if responses:
        for ids, vs in con.execute("SELECT ids, vectors FROM embed_responses").fetchall():
            for i, v in zip(ids, vs, strict=True):
                got.setdefault(i, v)
    ok = sorted(i for i, v in got.items() if v is not None and len(v) == 64 and all(x is not None and x == x for x in v) and any(v))
    x = np.array([got[i] for i in ok])
    x /= np.linalg.norm(x, axis=1)[:, None]
    c = np.round(x @ x.T, 6)
    np.fill_diagonal(c, -2)
    return ok, c


def test_similar_vectors(spark, sf_dir, con):
    ids, c = live_vectors(con, True)
    want = {tuple(sorted((ids[i], ids[j]))) for i in range(len(ids)) for j in np.argsort(-c[i], kind="stable")[:5] if c[i, j] >= 0.9}
    got = [tuple(r) for r in registry.QUERIES["p1_found"](spark, sf_dir).collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.95 * len(want)


def test_all_neighbours(spark, sf_dir, con):
    ids, c = live_vectors(con, True)
    want = {(ids[i], r + 1, ids[j], c[i, j]) for i in range(len(ids)) for r, j in enumerate(np.argsort(-c[i], kind="stable")[:5])}
    got = {tuple(r) for r in registry.QUERIES["p1_neighbours"](spark, sf_dir).collect()}
    assert len(got) == 5 * len(ids) and got == want


def test_crowds(spark, sf_dir, con):
    ids, c = live_vectors(con, False)
    want = {ids[i] for i in np.flatnonzero((c >= 0.9).sum(1) >= 20)}
    assert {r["id"] for r in registry.QUERIES["p7_found"](spark, sf_dir).collect()} == want


def test_near_duplicates(spark, sf_dir, con):
    t = dict(con.execute("SELECT id, text FROM chunks").fetchall())
    for i, d in con.execute("SELECT id, document FROM stored_records QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1").fetchall():
        if d is not None:
            t.setdefault(i, d)
    sets = {i: {*zip(w, w[1:], w[2:])} for i, w in ((i, words(x)) for i, x in t.items()) if len(w) >= 20}
    ids = sorted(sets)
    want = {(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if 5 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])}
    got = [tuple(r) for r in registry.QUERIES["p2_found"](spark, sf_dir).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_leaks(spark, sf_dir, con):
    runs = collections.defaultdict(set)
    for i, t in con.execute("SELECT item_id, text FROM eval_items").fetchall():
        w = words(t)
        for k in range(len(w) - 9):
            runs[tuple(w[k : k + 10])].add(i)
    want = set()
    for d, t in con.execute("SELECT doc_id, text FROM documents").fetchall():
        w = words(t)
        for k in range(len(w) - 9):
            want |= {(d, i) for i in runs.get(tuple(w[k : k + 10]), ())}
    assert {tuple(r) for r in registry.QUERIES["p8_found"](spark, sf_dir).collect()} == want
