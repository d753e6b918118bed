import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import graph, leakage, markup, neardup, splitting
from tessera.llm.shingles import words


def size(t):
    return len(re.sub("[ \t\r\n\u00a0]+", " ", t).strip(" "))


TEXT = st.one_of(st.text("ab .!\n\t\u00a0é\u0301👩\u200d", max_size=400), st.text(max_size=100), st.lists(st.sampled_from(["# Head\n", "Para one. Two? ", "\n\n", "- item\n", "word ", "x" * 40, "\\section{A}\n", "== W ==\n"]), max_size=40).map("".join))


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(8, 60), st.integers(0, 7))
def test_pieces_lose_nothing_and_keep_the_limit(text, limit, overlap):
    p = splitting.split_text(text, limit, overlap)
    assert "".join(text[a:b] for _, a, b in p) == text
    assert (len(p) == 1) == (size(text) <= limit) or size(text) <= limit
    for n, (o, a, b) in enumerate(p):
        assert o <= a <= b and size(text[o:b]) <= limit
        assert n == 0 or o >= p[n - 1][1]


def test_cuts_lie_at_the_coarsest_boundary():
    t = "# A\n\nOne two three. Four five.\n\n# B\n\nSix seven eight nine ten eleven."
    assert [t[a:b] for _, a, b in splitting.split_text(t, 40)] == [t[: t.index("# B")], t[t.index("# B") :]]
    s = "First sentence here. Second sentence here. Third one."
    assert [s[a:b] for _, a, b in splitting.split_text(s, 45)] == ["First sentence here. Second sentence here. ", "Third one."]
    o = splitting.split_text("alpha beta gamma delta epsilon zeta eta theta", 20, 8)
    assert all(x[0] < x[1] for x in o[1:])
    family = "👨\u200d👩\u200d👧" * 10
    assert all(family[a:b].startswith("👨") for _, a, b in splitting.split_text(family, 12))


def test_an_opened_section_takes_in_nothing_of_its_sibling():
    a, b, c = "# A\n\n" + "one two three four. " * 4 + "\n\n", "# B\n\nfive six.\n\n", "# C\n\nseven eight.\n"
    got = [(a + b + c)[x:y] for _, x, y in splitting.split_text(a + b + c, 50)]
    assert got[-1] == b + c and "".join(got[:-1]) == a
    assert splitting.split_text(" aaaaaaaaa", 8) != [(0, 0, 10)] and splitting.split_text(" aaaaaaaa", 8) == [(0, 0, 9)]


def test_split_table(spark):
    rows = [("result", "a", "word " * 100, 50, 10, "x"), ("result", "a", "word " * 100, 50, 10, "x"), ("chunk", "b", "short", 50, 10, "x"), ("chunk", "n", None, 50, 10, "x"), ("chunk", "e", "", 50, 10, "x")]
    got = splitting.split_oversized(spark.createDataFrame(rows, "record_kind STRING, record_id STRING, text STRING, max_size INT, overlap INT, pieces STRING")).collect()
    assert {r["record_id"] for r in got} == {"a", "b", "e"} and [r["text"] for r in got if r["record_id"] == "b"] == ["short"]
    a = sorted((r["piece"], r["start"], r["end"]) for r in got if r["record_id"] == "a")
    assert a[0] == a[1] and a[-1][2] == 500


def test_markup_kinds():
    cases = {
        "a <b>x</b> y": ["html"], "x <br/> y": ["html"], "gone <td colspan=2\nnext": ["html"], "end </div\nnext": ["html"], "fine./span>": ["html"], "<!-- c -->": ["html"], "A &amp; B&nbsp;c": ["html"],
        "'''bold''' text": ["wiki"], "see [[Page|p]]": ["wiki"], "{{note|x}}": ["wiki"], "== Head ==": ["wiki"], "{| class=w\n|-\n| a\n|}": ["wiki"], "__TOC__": ["wiki"], "[http://x.invalid/a label]": ["wiki"],
        "\\textbf{x}": ["latex"], "\\begin{equation}\nx\n\\end{equation}": ["latex"], "is $n^{2}$ big": ["latex"], "\\(d(p,q) < r\\)": ["latex"], "a~\\cite{b1}": ["latex"],
        "# Head\nx": ["markdown"], "a **b** c": ["markdown"], "`x`": ["markdown"], "- [x] do": ["markdown"], "| a | b |\n|:---|---:|": ["markdown"], "[t](/u)": ["markdown"], "Head\n====": ["markdown"], "~~x~~": ["markdown"], "[^1]: note": ["markdown"],
    }
    for t, want in cases.items():
        assert markup.scan(t) == want, t


def test_long_formula():
    body = "x_0 = " + " + ".join(f"a_{i} y" for i in range(80))
    assert len(body) > 500 and markup.scan(f"Take ${body}$ here.") == ["latex"]
    assert f"${body}$" in markup.clean(f"Take ${body}$ and <b>it</b>.")
    assert markup.scan("It cost $5, " + "then as said " * 40 + "it was $7 in all.") == []


PLAIN = [
    "The price rose from $1 to $5 per seat.", "Costs $2, later $7.", "Use it only if a < b and c > d holds.", "Temperatures <3 or >32 degrees.", "Copy it to C:\\temp\\new\\logs first.", "The area is 7 * 3 * 6 units.",
    "See ticket #87 and note [5].", "Press Ctrl + [ or ] to move.", "If x == 3 then y != 8.", "Set {a, b} as the pair.", "R&D and Q&A share one inbox.", "The file is named long_field_name_v3.", "\\\\depot\\share is gone; it's the crew's, isn't it.", "", "   ", None,
]


def test_deep_and_hostile_texts_stay_linear():
    import time

    for t in ("<div>" * 10_000 + "x" + "</div>" * 10_000, "[a" * 500_000, "\\a{" * 100_000, "{{a|" * 100_000, "<script>" * 50_000, "[^a" * 100_000, "== a" + " " * 300_000, "\\(a" * 100_000, "<ref" * 100_000):
        began = time.process_time()
        markup.scan(t)
        assert markup.clean(t) is not None
        assert time.process_time() - began < 20
    assert markup.scan("<div>" * 10_000) == ["html"] and "x" in markup.clean("<div>" * 10_000 + "x")


def test_braces_of_any_depth():
    t = r"\textbf{a \emph{b {c {d}}} e} and \section{One \emph{two}} see~\cite{x} \footnote{f}"
    assert markup.scan(t) == ["latex"]
    assert markup.clean(t) == "a b {c {d}} e and # One two see  (f)"
    assert markup.clean(r"\textbf{open") == r"\textbf{open" and markup.scan(r"\textbf{open") == []


def test_lookalikes_are_left_alone():
    for t in PLAIN:
        assert markup.scan(t) == [] and markup.clean(t) == t, t
    for t in ["Open <https://kb.invalid/start> first.", "Write `<br/>` in the source.", "Type `[[Page]]`.", "The name is long\\_field\\_name.", "```tex\n\\textbf{x} and $x$\n```", "```html\n<div>\n```", "# Head\n\n- item **b**"]:
        assert markup.scan(t, True) == [] and markup.clean(t, True) == t, t


def test_cleaning_keeps_structure():
    t = "<h2>Head</h2><ul><li>one<li>two</ul><pre>code  x</pre><p>a &lt; b &eacute;</p><script>bad()</script>"
    c = markup.clean(t)
    assert "## Head" in c and "- one" in c and "- two" in c and "code  x" in c and "a < b é" in c and "bad" not in c and "<p" not in c
    tex = markup.clean("\\section{Head}\n\\begin{itemize}\n\\item one\n\\end{itemize}\nwhere $n^{2}$ \\footnote{why}~\\cite{k1}.\n\\begin{equation}\nr = \\frac{a}{n}\n\\end{equation}")
    assert tex.startswith("# Head") and "- one" in tex and "$n^{2}$" in tex and "r = \\frac{a}{n}" in tex and "(why)" in tex and "cite" not in tex and "begin" not in tex
    wiki = markup.clean("== Head ==\n'''b''' [[A page|a]] [[Category:X]] {{Infobox\n| name = Y\n}}\n{| class=w\n|-\n! h\n|-\n| cell\n|}")
    assert "## Head" in wiki and "b a" in wiki and "name: Y" in wiki and "cell" in wiki and "[[" not in wiki and "{" not in wiki
    page = "<html><body><nav><a href='/a'>Home</a> <a href='/b'>News</a> <a href='/c'>Shop</a></nav><article><p>" + "Long content here. " * 30 + "</p><p>" + "More of it. " * 20 + "</p></article></body></html>"
    c = markup.clean(page)
    assert "Long content" in c and "More of it" in c and "Shop" not in c


@settings(max_examples=200, deadline=None)
@given(st.text("ab<>/&;$\\{}[]'=*`#|~_ \n", max_size=120))
def test_cleaning_never_fails(t):
    for m in (False, True):
        assert isinstance(markup.clean(t, m), str) and isinstance(markup.scan(t, m), list)


def test_markup_table(spark):
    df = spark.createDataFrame([("a", "<b>x</b>", None, 1), ("a", "<b>x</b>", None, 1), ("n", None, "", 1)], "doc_key STRING, text STRING, markdown STRING, kinds INT")
    got = {(r["doc_key"], r["field_name"]): (r["kinds"], r["cleaned"]) for r in markup.markup_residue(df).collect()}
    assert got["a", "text"] == (["html"], "x") and got["n", "text"] == ([], None) and got["n", "markdown"] == ([], "") and got["a", "markdown"] == ([], None)


def texts(spark, rows):
    return spark.createDataFrame(rows, "id STRING, src INT, text STRING, rep STRING").selectExpr("id", "src", "cast(null as timestamp_ntz) as u", "text", "rep")


def test_near_duplicates_edge_cases(spark):
    base = " ".join(f"w{i}" for i in range(60))
    edited = base.replace("w30", "new")
    rows = [("a", 1, base), ("b", 1, base.upper()), ("c", 0, edited), ("c", 0, edited), ("d", 1, "too short"), ("e", 1, None), ("f", 1, ""), ("g", 0, base), ("g", 1, " ".join(f"v{i}" for i in range(40))), (None, 1, base), ("long", 1, " ".join(f"z{i}" for i in range(20_000)))]
    v = texts(spark, [(*r, "x") for r in rows])
    nd = neardup.NearDuplicates(v, neardup.FOUND)
    assert {tuple(r) for r in neardup.id_pairs(nd).collect()} == {("a", "b"), ("a", "c"), ("b", "c")}
    g = {r["id"]: (r["group_id"], r["links"]) for r in neardup.groups(nd).collect()}
    assert g == {"a": ("a", 2), "b": ("a", 2), "c": ("a", 2)}
    assert neardup.id_pairs(neardup.NearDuplicates(v.filter("false"))).count() == 0


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 10**6))
def test_prefix_never_loses_a_pair(seed):
    import random

    r = random.Random(seed)
    m = neardup.FOUND
    a = {r.randrange(60) for _ in range(r.randrange(5, 50))}
    b = set(r.sample(sorted(a), int(len(a) * 0.8))) | {r.randrange(60) for _ in range(8)}
    if len(a & b) * m.den < m.num * len(a | b):
        return
    order = sorted(range(60), key=lambda x: hash((seed, x)))
    pre = [[x for x in order if x in s][: len(s) - -(-len(s) * m.num // m.den) + 1] for s in (a, b)]
    assert set(pre[0]) & set(pre[1])


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a BIGINT, b BIGINT"), "a", "b").collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100, 102: 100}
    assert graph.components(spark.createDataFrame([], "a BIGINT, b BIGINT"), "a", "b").count() == 0


def test_leak_measures():
    from tessera.llm.shingles import Hasher

    h = Hasher()
    a, b = h(words("a b c d e f")), h(words("x b c d y f"))
    assert leakage.longest_run(a, b) == 3 and leakage.longest_subsequence(a, b) == 4 and leakage.longest_run(a, b[:0]) == 0


def test_leaks_edge_cases(spark):
    item = "According to Quoryorine the optional cache at Dunvinek measures 803 sleeve entries for Ostgaren after the second retry"
    w = item.split()
    filler = "nothing to see here at all in this one " * 3
    rows = [(1, item), (2, filler + " ".join(w[3:13]) + " " + filler), (3, filler + " ".join(w[3:12]) + " " + filler), (4, None), (5, ""), (6, item.upper()), (6, item.upper()), (7, " ".join([*w[:6], "quietly", *w[6:12], "now", *w[12:]]))]
    rows += [(100 + i, filler + f"more {i} words about the cache and the second of the entries at all after measures") for i in range(80)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id BIGINT, text STRING, item_id STRING")
    items = spark.createDataFrame([(9, item), (8, None), (7, "short item")], "item_id BIGINT, text STRING")
    got = {(r["doc_id"], r["item_id"], r["kind"]) for r in leakage.leaks(docs, items).collect()}
    assert {(d, k) for d, i, k in got if i == 9} == {(1, "exact"), (2, "exact"), (6, "exact"), (7, "paraphrase")}
    assert leakage.leaks(docs, items.filter("false")).count() == 0 and leakage.leaks(docs.filter("false"), items).count() == 0
