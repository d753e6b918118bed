"""HTML into Markdown, plain text and images.

A small tree is built with the standard library's parser. One pass writes Markdown from the allowed tags, an
independent pass gathers plain text in which an image is only its description.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import mimetypes
import os
import re
import uuid
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import unquote_to_bytes

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.interfaces import BasePreprocessor

#: The tags, attributes and protocols that survive cleaning.
TAGS = frozenset("p br strong em b i ul ol li blockquote code pre hr a h1 h2 h3 h4 h5 h6 img figure figcaption".split())
ATTRIBUTES = {"a": ("href", "title"), "img": ("src", "alt", "title")}
PROTOCOLS = ("http", "https", "mailto", "tel", "data")
#: Extensions of common image types.
EXTENSIONS = {
    "image/png": ".png", "image/jpeg": ".jpg", "image/jpg": ".jpg", "image/gif": ".gif",
    "image/webp": ".webp", "image/svg+xml": ".svg", "image/bmp": ".bmp", "image/tiff": ".tiff",
}
VOID = frozenset("br hr img input meta link source wbr col area base embed track".split())
BLOCK = frozenset("p div ul ol li blockquote pre hr h1 h2 h3 h4 h5 h6 figure figcaption table tr section article header footer".split())
IMAGE_TYPE = "struct<path: string, mime: string, sha256: string, alt: string, title: string, caption: string, content: binary>"


#: Deeper elements lie beside each other, as browsers too bound the depth of a page; no text is lost by it.
DEPTH = 120


@dataclass
class Node:
    tag: str
    attrs: dict = field(default_factory=dict)
    children: list = field(default_factory=list)
    parent: Node | None = None


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.at, self.depth = self.root, 0
        self.flat: Counter = Counter()  # open elements below the greatest depth

    def handle_starttag(self, tag, attrs):
        if tag in ("li", "p") and self.at.tag == tag:
            self.at, self.depth = self.at.parent, self.depth - 1
        n = Node(tag, {k: v or "" for k, v in attrs}, [], self.at)
        self.at.children.append(n)
        if tag not in VOID:
            if self.depth < DEPTH:
                self.at, self.depth = n, self.depth + 1
            else:
                self.flat[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, [], self.at))

    def handle_endtag(self, tag):
        if self.flat[tag]:
            self.flat[tag] -= 1
            return
        n, up = self.at, 1
        while n is not None and n.tag != tag:
            n, up = n.parent, up + 1
        if n is not None and n.parent is not None:
            self.at, self.depth = n.parent, self.depth - up

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def flat_text(node: Node | str) -> str:
    return node if isinstance(node, str) else "".join(flat_text(c) for c in node.children)


def decode_data_uri(uri: str) -> tuple[bytes, str]:
    """Bytes and type of a data URI; ValueError where it is none or its base64 is broken."""
    head, comma, data = uri.partition(",")
    if not head.lower().startswith("data:") or not comma:
        raise ValueError("not a data URI")
    params = head[5:].split(";")
    mime = params[0].strip().lower() or "text/plain"
    if params[-1].strip().lower() == "base64" and len(params) > 1:
        try:
            return base64.b64decode(re.sub(r"\s+", "", data), validate=True), mime
        except binascii.Error as e:
            raise ValueError("broken base64") from e
    return unquote_to_bytes(data), mime


def extension(mime: str) -> str:
    return EXTENSIONS.get(mime) or mimetypes.guess_extension(mime) or ""


def caption_of(img: Node) -> str:
    p = img.parent
    if p is not None and p.tag == "figure":
        for c in p.children:
            if isinstance(c, Node) and c.tag == "figcaption":
                return " ".join(flat_text(c).split())
    after = p.children[[x is img for x in p.children].index(True) + 1 :] if p is not None else []
    nxt = next((c for c in after if isinstance(c, Node)), None)
    return " ".join(flat_text(nxt).split()) if nxt is not None and nxt.tag in ("em", "i", "small") else ""


def allowed_url(url: str) -> bool:
    m = re.match(r"\s*([a-zA-Z][a-zA-Z0-9+.-]*):", url)
    return m is None or m[1].lower() in PROTOCOLS


class _Markdown:
    def __init__(self, stem: str, subdir: str, keep_remote: bool, drop_script: bool) -> None:
        self.stem, self.subdir, self.keep_remote, self.drop_script = stem, subdir, keep_remote, drop_script
        self.images: list[dict] = []

    def image(self, n: Node) -> str:
        a = {k: (n.attrs.get(k) or "").strip() for k in ("src", "alt", "title")}
        caption = caption_of(n)
        if a["src"].lower().startswith("data:"):
            try:
                raw, mime = decode_data_uri(a["src"])
            except ValueError:
                return "[image: invalid-data-uri]"
            sha = hashlib.sha256(raw).hexdigest()
            path = f"{self.subdir}/{self.stem}-{sha[:12]}{extension(mime)}"
            self.images.append({"path": path, "mime": mime, "sha256": sha, "alt": a["alt"] or None, "title": a["title"] or None, "caption": caption or None, "content": raw})
            alt = a["alt"] or a["title"] or caption or "image"
        elif a["src"] and self.keep_remote and allowed_url(a["src"]):
            path, alt = a["src"], a["alt"] or a["title"] or "image"
        else:
            return "[image]"
        return f"![{alt}]({path})" + (f" _{caption}_" if caption and caption != alt else "")

    def inline(self, n: Node | str) -> str:
        if isinstance(n, str):
            return re.sub(r"\s+", " ", n)
        if self.drop_script and n.tag in ("script", "style"):
            return ""
        if n.tag == "img":
            return self.image(n)
        if n.tag == "br":
            return "  \n"
        inner = "".join(self.inline(c) for c in n.children)
        if n.tag in ("strong", "b") and inner.strip():
            return f"**{inner.strip()}**"
        if n.tag in ("em", "i") and inner.strip():
            return f"*{inner.strip()}*"
        if n.tag == "code" and inner:
            return f"`{inner}`"
        if n.tag == "a":
            href = n.attrs.get("href", "")
            title = f' "{n.attrs["title"]}"' if n.attrs.get("title") else ""
            return f"[{inner.strip()}]({href}{title})" if href and allowed_url(href) and inner.strip() else inner
        return inner

    def blocks(self, node: Node, depth: int = 0) -> list[str]:
        out: list[str] = []
        run: list[str] = []

        def flush() -> None:
            t = "".join(run).strip()
            if t:
                out.append(t)
            run.clear()

        for c in node.children:
            if isinstance(c, str) or (c.tag not in BLOCK and not any(isinstance(x, Node) and x.tag in BLOCK for x in c.children)):
                run.append(self.inline(c))
                continue
            flush()
            if re.fullmatch("h[1-6]", c.tag):
                out.append("#" * int(c.tag[1]) + " " + "".join(self.inline(x) for x in c.children).strip())
            elif c.tag == "hr":
                out.append("---")
            elif c.tag == "pre":
                out.append("```\n" + flat_text(c).strip("\n") + "\n```")
            elif c.tag in ("ul", "ol"):
                items, number = [], 0
                for li in c.children:
                    if isinstance(li, Node) and li.tag == "li":
                        number += 1
                        mark = f"{number}. " if c.tag == "ol" else "* "
                        body = "\n".join(self.blocks(li, depth + 1)).replace("\n", "\n" + " " * len(mark))
                        items.append(mark + body)
                if items:
                    out.append("\n".join(items))
            elif c.tag == "blockquote":
                out.append("\n\n".join(self.blocks(c, depth)).replace("\n", "\n> ").join(["> ", ""]))
            else:
                out.extend(self.blocks(c, depth))
        flush()
        return out


def plain_text(root: Node, drop_script: bool = False) -> str:
    parts: list[str] = []

    def walk(n: Node | str) -> None:
        if isinstance(n, str):
            if n.strip():
                parts.append(n.strip())
            return
        if drop_script and n.tag in ("script", "style"):
            return
        if n.tag == "img":
            d = caption_of(n) or (n.attrs.get("alt") or "").strip() or (n.attrs.get("title") or "").strip()
            if d:
                parts.append(d)
        for c in n.children:
            walk(c)

    walk(root)
    return " ".join(parts)


def convert(html: str, stem: str = "doc", subdir: str = "images", keep_remote: bool = True, drop_script: bool = False) -> dict:
    root = parse(html)
    m = _Markdown(stem, subdir, keep_remote, drop_script)
    return {"markdown": "\n\n".join(m.blocks(root)), "text": plain_text(root, drop_script), "images": m.images}


def html_to_result(docs: DataFrame, *, id_col: str = "doc_key", html_col: str = "html", image_subdir: str = "images", keep_remote_img: bool = True, drop_script: bool = False) -> DataFrame:
    """``(doc_key, markdown, text, images)``; null HTML gives nulls and no images, empty HTML empty texts.

    Image bytes stay in the column ``images.content`` until ``write_images`` stores them.
    """

    @F.pandas_udf(f"struct<markdown: string, text: string, images: array<{IMAGE_TYPE}>>")
    def run(stem: pd.Series, html: pd.Series) -> pd.DataFrame:
        rows = [{"markdown": None, "text": None, "images": []} if h is None else convert(h, s or "doc", image_subdir, keep_remote_img, drop_script) for s, h in zip(stem, html, strict=True)]
        return pd.DataFrame(rows, columns=["markdown", "text", "images"])

    r = docs.select(F.col(id_col).alias("doc_key"), run(F.col(id_col).cast("string"), F.col(html_col)).alias("r"))
    return r.select("doc_key", "r.markdown", "r.text", "r.images")


def write_images(results: DataFrame, out_dir: str) -> None:
    """Store each distinct image once, under its content-addressed path, by a temporary file and a rename.

    ``out_dir`` is an address that all executors share (``hdfs://``, ``s3://``, ...); a plain path is one only where there is
    a single machine, and refused elsewhere. The executors write in parallel.
    """
    if "://" not in out_dir and not results.sparkSession.sparkContext.master.startswith("local"):
        raise ValueError(f"{out_dir!r} lies on each machine's own disk; name a shared file system")

    def store(rows) -> None:
        fs, root = pafs.FileSystem.from_uri(out_dir if "://" in out_dir else os.path.abspath(out_dir))
        for r in rows:
            path = f"{root}/{r['path']}"
            if fs.get_file_info(path).type == pafs.FileType.NotFound:
                fs.create_dir(os.path.dirname(path))
                tmp = f"{path}.{uuid.uuid4().hex}.tmp"
                with fs.open_output_stream(tmp) as f:
                    f.write(r["content"])
                fs.move(tmp, path)

    results.select(F.explode("images").alias("i")).select("i.path", "i.content").filter("path is not null").dropDuplicates(["path"]).foreachPartition(store)


def image_description(caption: Column, alt: Column, title: Column) -> Column:
    e = F.lit("")
    return F.coalesce(F.nullif(caption, e), F.nullif(alt, e), F.nullif(title, e))


class HtmlPreprocessor(BasePreprocessor):
    """``process`` of ``id_col`` and ``html_col`` with the options of ``html_to_result``."""

    def __init__(self, **options) -> None:
        self.options = options

    def process(self, docs: DataFrame) -> DataFrame:
        return html_to_result(docs, **self.options)


def strip_tags(col: Column | str) -> Column:
    """Text without tags and comments, blanks collapsed: the plain SQL form for simple pages."""
    c = F.col(col) if isinstance(col, str) else col
    c = F.regexp_replace(c, "(?s)<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^<>]+>", " "), "[ \\n\\t\\r]+", " "))
