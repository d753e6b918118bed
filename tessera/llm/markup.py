"""Finding and removing markup residue.

``scan`` names the kinds of markup in a text, ``clean`` removes it and keeps headings, lists, code blocks and formulas.
Both start by setting code, links in angle brackets and escapes of the Markdown field aside.

Where a text is a web page, its tree is weighed by composite text density: characters per tag adjusted by links, summed
over the children of each node; the subtree with the greatest sum is the content, and link-dominated branches whose
density lies under the least density on its path to the body are left out.
"""

from __future__ import annotations

import bisect
import html
import math
import re
from html.entities import html5

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.html import Node, parse
from tessera.session import table

#: HTML element names that count as tags.
ELEMENTS = (
    "a abbr address article aside b blockquote body br button caption center cite code col colgroup dd del details div dl dt em embed "
    "fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link "
    "main map mark meta nav object ol option p pre q s samp script section select small source span strike strong style sub summary sup "
    "svg table tbody td template textarea tfoot th thead title tr tt u ul var video audio"
).split()
_NAME = "|".join(sorted(ELEMENTS, key=len, reverse=True))
_ATTR = r"""\s+[a-zA-Z_:@][-\w:.@]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>`]+))?"""
TAG = re.compile(rf"</?(?:{_NAME})(?:{_ATTR})*\s*/?>", re.I)
BROKEN_TAG = re.compile(
    rf"<(?:{_NAME})(?:\s+[a-zA-Z_:][-\w:.]*\s*=\s*(?:\"[^\"\n]*\"?|'[^'\n]*'?|[^\s\"'<>`]+))+(?=\s|$)"  # an open tag that never closes
    rf"|</(?:{_NAME})(?=\s|$)"  # an end tag that never closes
    rf"|(?<![<\w:/])/(?:{_NAME})>",  # an end tag without its first sign
    re.I | re.M,
)
COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!doctype[^<>]*>|<\?xml(?:(?!<\?xml).)*?\?>|<!\[CDATA\[|(?<!-)-->", re.S | re.I)
ENTITY = re.compile(r"&(#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});")

#: Each pattern beside a sign without which it cannot match. None scans beyond the next sign that could begin it anew, so that
#: the time stays in proportion to the text.
WIKI = [
    ("''", re.compile(r"'''(?!')[^'\n][^\n]*?'''|(?<!')''(?!')[^'\n]+?''(?!')")),
    ("[[", re.compile(r"\[\[[^\[\]\n|]+(?:\|[^\[\]\n]*)*\]\]")),
    ("{{", re.compile(r"\{\{\s*[A-Za-z#À-ž:][^{}]*\}\}")),
    ("|", re.compile(r"^[ \t]*\{\|.*$|^[ \t]*\|\}[ \t]*$", re.M)),
    ("==", re.compile(r"^={2,6}[^=\n][^\n]*={2}[ \t]*$", re.M)),
    ("__", re.compile(r"__[A-Z]{3,}__")),
    ("://", re.compile(r"\[(?:https?|ftp)://[^\s\[\]]+ [^\[\]\n]+\]")),
    ("<", re.compile(r"</?(?:ref|nowiki|gallery|noinclude|includeonly)\b[^<>]*>", re.I)),
    ("#REDIRECT", re.compile(r"^#REDIRECT\b", re.M)),
]

MATH_BLOCK = re.compile(r"\$\$(?=\S)[^$]+?\$\$|\\\[(?!\s*\])(?:(?!\\[\[\]]).)+\\\]", re.S)
MATH_INLINE = re.compile(r"(?<![\\$\w])\$(?=[^\s$])([^$\n]*(?<=[^\s$\\]))\$(?![\d$])|\\\(((?:(?!\\[()]).)+)\\\)")
TEX_HEAD = re.compile(r"\\([a-zA-Z]+)\*?(?:\[[^\[\]\n]*\])?\{")
TEX_ENVIRONMENT = re.compile(r"\\(?:begin|end)\s*\{")
_BRACE = re.compile(r"(?<!\\)[{}]")
TEX_SIGN = re.compile(r"\\[a-zA-Z]+|[\^_=<>+]|^[a-zA-Z]$|\w\(|\d\s*[*/]\s*[a-zA-Z]")

_LINK = r"\((?:[^()\s]|\([^()\s]*\))+(?:\s+\"[^\"\n]*\")?\)"
_LABEL = r"\[(?:[^\[\]\n]|\[[^\[\]\n]*\])+\]"
MARKDOWN = [
    ("#", re.compile(r"^ {0,3}#{1,6}[ \t]+\S", re.M)),
    ("**", re.compile(r"(?<![*\w])\*\*(?=\S)[^*\n]+?\S?\*\*(?![*\w])")),
    ("*", re.compile(r"(?<![*\w\\])\*(?=[^\s*])[^*\n]*[^\s*]\*(?![*\w])")),
    ("__", re.compile(r"(?<![_\w])__(?=[^\s_])(?![A-Z]+__)(?:[^_\n]|_(?!_))+?(?<=[^\s_])__(?![_\w])")),
    ("_", re.compile(r"(?<![_\w\\])_(?=[^\s_])[^_\n]*[^\s_]_(?![_\w])")),
    ("~~", re.compile(r"~~(?=\S)[^~\n]+~~")),
    ("", re.compile(r"^ {0,3}(?:```|~~~)", re.M)),
    ("`", re.compile(r"(?<!`)`[^`\n]+`(?!`)")),
    ("](", re.compile(rf"!\[[^\[\]\n]*\]\((?:[^()\n]|\([^()\n]*\))*\)|(?<!!){_LABEL}{_LINK}")),
    ("[", re.compile(r"\[[^\[\]\n]+\]\[[^\[\]\n]*\]|^ {0,3}\[[^\[\]\n]+\]:\s*\S|\[\^[^\[\]\s]+\]", re.M)),
    ("] ", re.compile(r"^[ \t]*[-*+] \[[ xX]\]\s", re.M)),
    ("---", re.compile(r"^[ \t]*(?=[|:-])(?=[^\n]*\|)(?=[^\n]*---)[|:\- \t]+$", re.M)),
    ("", re.compile(r"(?<=\S\n) {0,3}(?:={3,}|-{3,})[ \t]*$", re.M)),
    (">", re.compile(r"^ {0,3}>+ \S", re.M)),
    ("<", re.compile(r"<(?:https?|mailto|ftp):[^\s<>]+>")),
]

FENCE = re.compile(r"^( {0,3})(`{3,}|~{3,})[^\n`]*\n(?:.*?\n)?? {0,3}\2[`~]*[ \t]*$|^( {0,3})(`{3,}|~{3,})[^\n`]*\n.*\Z", re.M | re.S)
CODE = re.compile(r"(?<![`\\])(`+)(?!`)([^`\n]|[^`\n].*?[^`\n])\1(?!`)")
AUTOLINK = re.compile(r"<(?:[a-zA-Z][a-zA-Z0-9+.-]{1,31}:[^\s<>]*|[\w.+-]+@[\w.-]+)>")
ESCAPE = re.compile(r"\\([!-/:-@\[-`{-~])")


def _unified(text: str) -> str:
    return text.replace("\r\n", "\n").replace("\r", "\n")


def _is_math(body: str) -> bool:
    return bool(TEX_SIGN.search(body.strip()))


def _has_math(t: str) -> bool:
    return any(_is_math(m[0][2:-2]) for m in MATH_BLOCK.finditer(t)) or any(_is_math(m[1] if m[1] is not None else m[2]) for m in MATH_INLINE.finditer(t))


def _has_entity(t: str) -> bool:
    return any(m[1][0] == "#" or m[1] + ";" in html5 for m in ENTITY.finditer(t))


def _groups(t: str) -> dict[int, int]:
    """Position of each opening brace that is closed, and of its closing one."""
    out, open_ = {}, []
    for m in _BRACE.finditer(t):
        if m[0] == "{":
            open_.append(m.start())
        elif open_:
            out[open_.pop()] = m.start()
    return out


def _has_command(t: str) -> bool:
    if TEX_ENVIRONMENT.search(t):
        return True
    if not TEX_HEAD.search(t):
        return False
    closed = _groups(t)
    return any(m.end() - 1 in closed for m in TEX_HEAD.finditer(t))


def _outside_code(t: str) -> str:
    if "```" in t or "~~~" in t:
        t = FENCE.sub(" ", t)
    if "`" in t:
        t = CODE.sub(" ", t)
    return AUTOLINK.sub(" ", t) if "<" in t else t


def scan(text: str | None, markdown_field: bool = False) -> list[str]:
    """Kinds of markup in a text, in fixed order: html, latex, markdown (not for the Markdown field), wiki."""
    if not text:
        return []
    t = _unified(text)
    if markdown_field:
        t = _outside_code(t)
    found = []
    angle = "<" in t or ">" in t
    if (angle and (TAG.search(t) or BROKEN_TAG.search(t) or COMMENT.search(t))) or ("&" in t and _has_entity(t)):
        found.append("html")
    slash = "\\" in t
    if (slash and _has_command(t)) or ((slash or "$" in t) and _has_math(t)):
        found.append("latex")
    if not markdown_field and any(sign in t and p.search(t) for sign, p in MARKDOWN):
        found.append("markdown")
    if any(sign in t and p.search(t) for sign, p in WIKI):
        found.append("wiki")
    return found


# ---- content of pages by composite text density


class _Density:
    """Characters, tags and their parts in links of a node, and what follows from them."""

    def __init__(self, node: Node, in_link: bool = False) -> None:
        self.node, self.children = node, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        link = in_link or node.tag == "a"
        for c in node.children:
            if isinstance(c, str):
                n = len("".join(c.split()))
                self.chars += n
                self.link_chars += n if link else 0
            else:
                d = _Density(c, link)
                self.children.append(d)
                self.chars += d.chars
                self.tags += d.tags + 1
                self.link_chars += d.link_chars
                self.link_tags += d.link_tags + (c.tag == "a")
        self.density = 0.0

    def weigh(self, body: _Density) -> None:
        c, t, lc, lt = self.chars, max(1, self.tags), self.link_chars, self.link_tags
        if c:
            base = math.log(c / max(1, c - lc) * lc + body.link_chars / max(1, body.chars) * c + math.e)
            arg = c / max(1, lc) * t / max(1, lt)
            self.density = c / t * (math.log(max(arg, 1.0)) / math.log(max(base, 1.0 + 1e-9)) if base > 1 else math.log(max(arg, 1.0) * math.e))
        for x in self.children:
            x.weigh(body)

    def total(self) -> float:
        return sum(x.density for x in self.children)


_PAGE = re.compile(r"<(?:html|body|nav|header|footer|main|article)\b", re.I)


def content_nodes(root: Node) -> set[int]:
    """Ids of the nodes that are left out: link-dominated branches under the density of the body path."""
    body = _Density(root)
    body.weigh(body)
    best, path, stack = body, [body], [(body, [body])]
    while stack:
        n, way = stack.pop()
        if n.total() > best.total():
            best, path = n, way
        stack.extend((x, [*way, x]) for x in n.children)
    threshold = min((x.density for x in path if x.chars), default=0.0)
    on_path, out = {id(x.node) for x in path}, set()
    stack2 = [body]
    while stack2:
        n = stack2.pop()
        if id(n.node) not in on_path and n.density < threshold and n.link_tags + (n.node.tag == "a") and n.link_chars * 2 > n.chars and n.node.tag != "a":
            out.add(id(n.node))
        else:
            stack2.extend(n.children)
    return out


_BLOCKS = frozenset("p div table tr section article header footer main ul ol blockquote pre figure figcaption form dl dt dd nav aside center".split())


def _html_text(node: Node | str, dropped: set[int]) -> str:
    if isinstance(node, str):
        return node
    if node.tag in ("script", "style", "template") or id(node) in dropped:
        return ""
    inner = "".join(_html_text(c, dropped) for c in node.children)
    if re.fullmatch("h[1-6]", node.tag):
        return f"\n\n{'#' * int(node.tag[1])} {' '.join(inner.split())}\n\n"
    if node.tag == "br":
        return "\n"
    if node.tag == "hr":
        return "\n\n"
    if node.tag == "li":
        return f"\n- {inner.strip()}\n" if inner.strip() else ""
    if node.tag == "img":
        return node.attrs.get("alt", "")
    if node.tag in ("td", "th"):
        return inner.strip() + " "
    if node.tag == "pre":
        return f"\n```\n{inner.strip(chr(10))}\n```\n"
    if node.tag == "code" and node.parent is not None and node.parent.tag != "pre":
        return inner
    return f"\n{inner.strip()}\n" if node.tag in _BLOCKS else inner


_HIDDEN = re.compile(r"<(script|style)\b[^<>]*>", re.I)


def _without(t: str) -> str:
    """The text without scripts and styles that are closed; each end is looked for once."""
    out, at, ends = [], 0, {k: [m.span() for m in re.finditer(rf"</{k}\s*>", t, re.I)] for k in ("script", "style")} if "<" in t else {}
    starts = {k: [x for x, _ in v] for k, v in ends.items()}
    for m in _HIDDEN.finditer(t) if ends else ():
        k = m[1].lower()
        n = bisect.bisect_left(starts[k], m.end())
        if m.start() >= at and n < len(starts[k]):
            out.append(t[at : m.start()])
            at = ends[k][n][1]
    return "".join([*out, t[at:]])


def _strip_html(t: str) -> str:
    t = _without(t)
    t = COMMENT.sub("", t)
    if TAG.search(t):
        # signs that are no tag stay text for the parser
        kept = TAG.sub(lambda m: m[0].replace("<", "\ue010").replace(">", "\ue011"), t)
        kept = kept.replace("&", "\ue012").replace("<", "\ue013").replace(">", "\ue014").replace("\ue010", "<").replace("\ue011", ">")
        root = parse(kept)
        t = _html_text(root, content_nodes(root) if _PAGE.search(t) else set())
        t = t.replace("\ue012", "&").replace("\ue013", "<").replace("\ue014", ">")
    t = BROKEN_TAG.sub("", t)
    t = ENTITY.sub(lambda m: html.unescape(m[0]) if m[1][0] == "#" or m[1] + ";" in html5 else m[0], t)
    return re.sub(rf"<({_NAME})>([^<>\n]*)</\1>", r"\2", t, flags=re.I)  # tags that were written as entities


def _template(m: re.Match) -> str:
    parts = [p.strip() for p in m[0][2:-2].split("|")]
    if parts[0].lower().startswith("infobox"):
        fields = [p.split("=", 1) for p in parts[1:] if "=" in p]
        return "\n".join(f"{k.strip()}: {v.strip()}" for k, v in fields)
    return " ".join(p.split("=", 1)[1].strip() if re.match(r"\w+\s*=", p) else p for p in parts[1:])


def _heading(m: re.Match) -> str:
    line = m[0].rstrip()
    n = min(len(line) - len(line.lstrip("=")), len(line) - len(line.rstrip("=")), 6)
    return "#" * n + " " + line[n:-n].strip()


def _strip_wiki(t: str) -> str:
    t = re.sub(r"^[ \t]*\{\|.*$|^[ \t]*\|\}[ \t]*$|^\|-+.*$", "", t, flags=re.M)
    t = re.sub(r"^! *(?=\S)", "", t, flags=re.M)
    t = WIKI[2][1].sub(_template, t)
    t = re.sub(r"^\| (?![^\n]*\|\s*$)", "", t, flags=re.M)
    t = re.sub(r"\[\[(?:Category|Kategorie|Categoria|Categoría|File|Image):[^\[\]\n]*\]\]", "", t, flags=re.I)
    t = re.sub(r"\[\[([^\[\]\n|]+)(?:\|([^\[\]\n]*))?\]\]", lambda m: m[2] or m[1], t)
    t = WIKI[6][1].sub(lambda m: m[0][1:-1].split(" ", 1)[1], t)
    t = WIKI[4][1].sub(_heading, t)
    t = re.sub(r"'''(?!')([^\n]+?)'''", r"\1", t)
    t = re.sub(r"(?<!')''(?!')([^'\n]+?)''(?!')", r"\1", t)
    t = WIKI[7][1].sub("", t)
    return WIKI[5][1].sub("", t)


_DEPTH = {"section": 1, "subsection": 2, "subsubsection": 3, "chapter": 1, "paragraph": 4}


#: Commands that leave nothing but what stands before them.
_SILENT = frozenset("cite citep citet label index ref eqref pageref autoref".split())


def _plain_commands(t: str) -> str:
    """Commands with arguments in braces give way to their arguments, whatever lies nested in them, in one pass."""
    heads = {m.end() - 1: m for m in TEX_HEAD.finditer(t)}
    if not heads:
        return t
    closed = _groups(t)
    events = sorted([(m.start(), m.end(), at, m[1]) for at, m in heads.items() if at in closed])
    ends = {closed[at]: True for _, _, at, _ in events}
    out: list[list[str]] = [[]]
    names: list[str] = []
    at, e = 0, 0
    for end in sorted([x[0] for x in events] + list(ends)):
        out[-1].append(t[at:end])
        if e < len(events) and events[e][0] == end:
            names.append(events[e][3])
            at, e = events[e][1], e + 1
            out.append([])
            continue
        body, name = "".join(out.pop()), names.pop()
        at = end + 1
        if name in _SILENT:
            if out[-1]:
                out[-1][-1] = out[-1][-1].removesuffix("~").removesuffix(" ") if name not in ("ref", "eqref", "pageref", "autoref") else out[-1][-1].removesuffix("~")
        elif name in _DEPTH:
            out[-1].append("#" * _DEPTH[name] + " " + body)
        else:
            out[-1].append(f" ({body})" if name == "footnote" else body)
    return "".join([*out[0], t[at:]])


def _strip_latex(t: str, put) -> str:
    if "\\" not in t and "$" not in t:
        return t

    def formula(body: str, block: bool) -> str:
        return put(f"\n$$\n{body.strip()}\n$$\n" if block else f"${body.strip()}$")

    t = re.sub(r"\\begin\{(equation|align|gather|displaymath|math)(\*?)\}((?:(?!\\begin\{\1\2\}).)*?)\\end\{\1\2\}", lambda m: formula(m[3], True), t, flags=re.S)
    t = MATH_BLOCK.sub(lambda m: formula(m[0][2:-2], True) if _is_math(m[0][2:-2]) else m[0], t)
    t = MATH_INLINE.sub(lambda m: formula(m[1] if m[1] is not None else m[2], False) if _is_math(m[1] if m[1] is not None else m[2]) else m[0], t)
    t = re.sub(r"\\begin\{(verbatim|lstlisting)\}((?:(?!\\begin\{\1\}).)*?)\\end\{\1\}", lambda m: put(f"\n```\n{m[2].strip(chr(10))}\n```\n"), t, flags=re.S)
    t = re.sub(r"^[ \t]*\\item\b[ \t]*", "- ", t, flags=re.M)
    t = re.sub(r"(?<![ \t])[ \t]*\\(?:begin|end)\s*\{[^{}\n]*\}(?:\[[^\[\]\n]*\])?[ \t]*\n?", "", t)
    return _plain_commands(t)


def _strip_markdown(t: str) -> str:
    t = re.sub(r"!\[([^\[\]\n]*)\]\((?:[^()\n]|\([^()\n]*\))*\)", r"\1", t)
    t = re.sub(rf"({_LABEL}){_LINK}", lambda m: m[1][1:-1], t)
    t = re.sub(r"\[([^\[\]\n]+)\]\[[^\[\]\n]*\]", r"\1", t)
    t = re.sub(r"^ {0,3}\[\^([^\[\]\s]+)\]:\s*", r"\1: ", t, flags=re.M)
    t = re.sub(r"^ {0,3}\[[^\[\]\n^]+\]:\s*\S+[^\n]*\n?", "", t, flags=re.M)
    t = re.sub(r"\[\^[^\[\]\s]+\]", "", t)
    t = re.sub(r"(?<![*\w])\*\*(?=\S)([^*\n]+?)\*\*(?![*\w])", r"\1", t)
    t = re.sub(r"(?<![*\w\\])\*(?=[^\s*])([^*\n]*[^\s*])\*(?![*\w])", r"\1", t)
    t = re.sub(r"~~(?=\S)([^~\n]+)~~", r"\1", t)
    t = re.sub(r"^([ \t]*)[-*+] \[[ xX]\][ \t]+", r"\1- ", t, flags=re.M)
    t = re.sub(MARKDOWN[11][1].pattern + r"\n?", "", t, flags=re.M)
    t = re.sub(r"^([^\n]*)(?<=\S)\n {0,3}={3,}[ \t]*$", r"# \1", t, flags=re.M)
    t = re.sub(r"^([^\n]*)(?<=\S)\n {0,3}-{3,}[ \t]*$", r"## \1", t, flags=re.M)
    return t


def clean(text: str | None, markdown_field: bool = False) -> str | None:
    """The text without foreign markup. Headings come out as ``#`` lines, lists as ``-``, code in fences, formulas in ``$``.

    Text without markup comes out as it went in; in the Markdown field Markdown stays.
    """
    if text is None:
        return None
    if not scan(text, markdown_field):
        return text
    kept: list[str] = []

    def put(s: str) -> str:
        kept.append(s)
        return f"\ue000{len(kept) - 1}\ue001"

    t = _unified(text)
    t = FENCE.sub(lambda m: put(m[0]), t)
    t = CODE.sub(lambda m: put(m[0] if markdown_field else m[2]), t)
    t = AUTOLINK.sub(lambda m: put(m[0] if markdown_field else m[0][1:-1]), t)
    t = _strip_latex(t, put)
    if markdown_field:
        t = ESCAPE.sub(lambda m: put(m[0]), t)
    t = _strip_html(t)
    t = _strip_wiki(t)
    if not markdown_field:
        t = _strip_markdown(t)
    for _ in range(len(kept) + 1):
        new = re.sub("\ue000(\\d+)\ue001", lambda m: kept[int(m[1])], t)
        if new == t:
            break
        t = new
    return re.sub(r"\n{3,}", "\n\n", t).strip("\n")


def markup_residue(results: DataFrame) -> DataFrame:
    """``doc_key, field_name, kinds, cleaned`` for both fields of every row of ``doc_key, text, markdown``.

    Null stays null and has no kinds; empty and blank texts come out unchanged. Extra columns are ignored and repeated
    rows are treated each for itself.
    """

    r = _fields(results)
    return r.select("doc_key", "field_name", _scanned("t", F.col("field_name") == "markdown").alias("kinds"), _cleaned("t", F.col("field_name") == "markdown").alias("cleaned"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _scanned(text: pd.Series, markdown: pd.Series) -> pd.Series:
    return pd.Series([scan(t, m) for t, m in zip(text, markdown, strict=True)], dtype=object)


@F.pandas_udf(T.StringType())
def _cleaned(text: pd.Series, markdown: pd.Series) -> pd.Series:
    return pd.Series([clean(t, m) for t, m in zip(text, markdown, strict=True)], dtype=object)


def _fields(results: DataFrame) -> DataFrame:
    both = F.array(F.struct(F.lit("text").alias("f"), F.col("text").alias("t")), F.struct(F.lit("markdown").alias("f"), F.col("markdown").alias("t")))
    return results.select("doc_key", F.explode(both).alias("x")).select("doc_key", F.col("x.f").alias("field_name"), F.col("x.t").alias("t"))


def residue_kinds(results: DataFrame) -> DataFrame:
    """``doc_key, field_name, markup``: a row for each kind of markup in a field, without cleaning it.

    Texts without any of the signs that markup is made of never reach Python. Null, empty and blank texts give no row.
    """
    r = _fields(results).filter(F.col("t").rlike(r"[<>&\\$'\[{}|_#*~`]|---|=="))
    return r.select("doc_key", "field_name", F.explode(_scanned("t", F.col("field_name") == "markdown")).alias("markup"))


def p6_clean(spark, sf_dir: str) -> DataFrame:
    return markup_residue(table(spark, sf_dir, "preprocess_results")).select("doc_key", "field_name", "cleaned").distinct()


def p6_found(spark, sf_dir: str) -> DataFrame:
    return residue_kinds(table(spark, sf_dir, "preprocess_results")).distinct()
