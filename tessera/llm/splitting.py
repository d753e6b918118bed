"""Cutting oversized texts at natural boundaries.

A text is a tree: sections under headings by depth, paragraphs, lines and list items, sentences, words, signs. A node
that fits is one unit; an oversized node is opened and its children are treated alike; neighbouring units of the same
parent are merged up to the limit. So a cut lies at the coarsest boundary that the limit allows.

Size is measured in code points after every run of blanks became one and both ends were trimmed.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import table

#: Production parameters: limits of parent texts and of chunks, and the code points that a piece repeats.
RESULT_LIMIT, CHUNK_LIMIT, OVERLAP = 3000, 900, 120
#: The signs that count as blank.
BLANKS = " \t\r\n\u00a0"
#: Sections, paragraphs, items and lines are nodes of the tree, sentences and words are not.
_STRUCTURE = 4
_HEADING = re.compile(r"^(?:(#{1,6})[ \t]|(={2,6})[^=\n]+={2,6}[ \t]*$|\\(section|subsection|subsubsection)\*?\{|<h([1-6])\b)", re.M | re.I)
_PARAGRAPH = re.compile(r"(?:\r\n|\r|\n)[ \t\u00a0]*(?:\r\n|\r|\n)[\s\u00a0]*")
_ITEM = re.compile(r"(?:\r\n|\r|\n)(?=[ \t]*(?:[-*+•]|\d+[.)]|\\item|\|)[ \t\\])")
_LINE = re.compile(r"\r\n|\r|\n")
_SENTENCE = re.compile(r"[.!?…。！？।؟]+[\"'»”’)\]]*(?:[ \t\u00a0]+|(?<=[。！？]))")
_WORD = re.compile(r"[ \t\u00a0]+")
_TEX_DEPTH = {"section": 1, "subsection": 2, "subsubsection": 3}


def _joined(text: str, i: int) -> bool:
    """Whether a cut before position i would part a sign: combining marks, joiners, surrogates of flags and skin tones."""
    import unicodedata

    c, p = text[i], text[i - 1]
    o = ord(c)
    if unicodedata.combining(c) or c in "\u200d\ufe0e\ufe0f" or p == "\u200d" or 0x1F3FB <= o <= 0x1F3FF or 0xE0020 <= o <= 0xE007F or p == "\r" and c == "\n":
        return True
    if 0x1F1E6 <= o <= 0x1F1FF:  # flags are pairs
        n = 0
        while i - n > 0 and 0x1F1E6 <= ord(text[i - n - 1]) <= 0x1F1FF:
            n += 1
        return n % 2 == 1
    return unicodedata.category(c) in ("Mn", "Me", "Mc")


class _Text:
    def __init__(self, text: str, limit: int) -> None:
        self.text, self.limit = text, limit
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        blank = np.isin(codes, [ord(c) for c in BLANKS])
        kept = ~blank
        if len(codes):
            kept[1:] |= ~blank[:-1]
        self.kept = np.concatenate([[0], np.cumsum(kept)])
        self.headings = [(m.start(), len(m[1]) if m[1] else len(m[2]) if m[2] else _TEX_DEPTH[m[3].lower()] if m[3] else int(m[4])) for m in _HEADING.finditer(text)]
        self.cuts: list[list[int] | None] = [None] * 5

    def size(self, a: int, b: int) -> int:
        """At least the measured size of ``text[a:b]``, and at most one more than it for an end in blanks; blanks at the start of the text count nothing."""
        return int(self.kept[b] - self.kept[a])

    def level(self, k: int) -> list[int]:
        if self.cuts[k] is None:
            self.cuts[k] = [m.end() for m in (_PARAGRAPH, _ITEM, _LINE, _SENTENCE, _WORD)[k].finditer(self.text)]
        return self.cuts[k]

    def children(self, a: int, b: int, level: int) -> tuple[list[int], int]:
        """Boundaries inside ``[a, b)`` at the first level from ``level`` on that has any, and the next level."""
        if level == 0:
            inside = [(p, d) for p, d in self.headings if a < p < b]
            if inside:
                top = min(d for _, d in inside)
                return [p for p, d in inside if d == top], 0
            level = 1
        for k in range(level - 1, 5):
            c = self.level(k)
            got = c[bisect_right(c, a) : bisect_left(c, b)]
            if got:
                return got, k + 2
        step, out, at = max(1, self.limit), [], a
        while b - at > step:
            cut = at + step
            while cut > at + 1 and _joined(self.text, cut):
                cut -= 1
            if cut == at + 1 and _joined(self.text, cut):  # one sign longer than the limit
                cut = at + step
            out.append(cut)
            at = cut
        return out, 7

    def units(self, a: int, b: int, level: int, budget: int) -> list[tuple[int, int]]:
        if self.size(a, b) <= budget or b - a <= 1:
            return [(a, b)]
        cuts, below = self.children(a, b, level)
        if not cuts:
            return [(a, b)]
        edges = [a, *cuts, b]
        out: list[tuple[int, int]] = []
        closed = False  # the last unit is the end of an opened node, which takes in no part of the next one
        for x, y in zip(edges, edges[1:], strict=False):
            parts = self.units(x, y, below, budget)
            whole = len(parts) == 1
            joins = bool(out) and (below > _STRUCTURE or whole and not closed or self.text[x:y].isspace() or len(out) == 1 and self.text[a : out[0][1]].isspace())
            if joins and self.size(out[-1][0], parts[0][1]) <= budget:
                out[-1] = (out[-1][0], parts[0][1])
                parts = parts[1:]
            out.extend(parts)
            closed = not whole
        return out


def split_text(text: str, limit: int, overlap: int = 0) -> list[tuple[int, int, int]]:
    """``(overlap_start, start, end)`` of the pieces in order; ``text[start:end]`` joined give the text again.

    A piece is ``text[overlap_start:end]`` and is within the limit; it repeats at most ``overlap`` measured code points of
    the text before it, from a word start where there is one. A text within the limit is one piece; an empty one too.
    """
    if limit < 1 or not 0 <= overlap < limit:
        raise ValueError("limit >= 1 and 0 <= overlap < limit must hold")
    t = _Text(text, max(1, limit - overlap))
    if int(t.kept[-1]) - (1 if text[-1:] and text[-1] in BLANKS else 0) <= limit:
        return [(0, 0, len(text))]
    out: list[tuple[int, int, int]] = []
    for a, b in t.units(0, len(text), 0, limit - overlap):
        back = a
        if out and overlap:
            lowest = int(np.searchsorted(t.kept, t.kept[a] - overlap))
            words = t.level(4)
            lines = t.level(2)
            near = [c[i] for c in (words, lines) if (i := bisect_left(c, lowest)) < len(c) and c[i] < a]
            back = min(near) if near else lowest
            while 0 < back < a and _joined(text, back):
                back += 1
            back = max(back, out[-1][1])
        out.append((back, a, b))
    return out


def measured(col: str) -> Column:
    """Code points of a text after blanks were collapsed and trimmed; null for null."""
    return F.length(F.trim(F.regexp_replace(F.col(col), "[ \\t\\r\\n\\u00a0]+", " ")))


_PIECES = "array<struct<piece: int, start: int, end: int, overlap_start: int, text: string>>"


def split_oversized(records: DataFrame) -> DataFrame:
    """Pieces of every record: ``record_kind, record_id, pieces, piece, start, end, overlap_start, text``.

    records: ``record_kind, record_id, text, max_size, overlap``. The root of each tree is measured in the JVM; only
    oversized roots are opened, in an Arrow UDF. A record within its limit is one piece, its text unchanged; null text
    gives no row. Equal records are cut alike, each for itself.
    """

    @F.pandas_udf(_PIECES)
    def cut(text: pd.Series, limit: pd.Series, overlap: pd.Series) -> pd.Series:
        return pd.Series([
            [{"piece": i, "start": a, "end": b, "overlap_start": o, "text": t[o:b]} for i, (o, a, b) in enumerate(split_text(t, int(n), int(v)))]
            for t, n, v in zip(text, limit, overlap, strict=True)
        ])

    r = records.filter("text is not null").withColumn("size", measured("text"))
    whole = F.array(F.struct(F.lit(0).alias("piece"), F.lit(0).alias("start"), F.length("text").alias("end"), F.lit(0).alias("overlap_start"), F.col("text").alias("text")))
    small = r.filter("size <= max_size").withColumn("p", whole)
    big = r.filter("size > max_size").withColumn("p", cut("text", "max_size", "overlap"))
    out = small.unionByName(big).select("record_kind", "record_id", F.size("p").alias("pieces"), F.explode("p").alias("x"))
    return out.select("record_kind", "record_id", "pieces", "x.piece", "x.start", "x.end", "x.overlap_start", "x.text")


def source_records(spark, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "preprocess_results").select(F.lit("result").alias("record_kind"), F.col("doc_key").alias("record_id"), "text", F.lit(RESULT_LIMIT).alias("max_size"))
    c = table(spark, sf_dir, "chunks").select(F.lit("chunk").alias("record_kind"), F.col("id").alias("record_id"), "text", F.lit(CHUNK_LIMIT).alias("max_size"))
    return r.unionByName(c).withColumn("overlap", F.lit(OVERLAP))


def p3_pieces(spark, sf_dir: str) -> DataFrame:
    """All pieces of all texts, identical rows once."""
    return split_oversized(source_records(spark, sf_dir)).distinct()


def p3_found(spark, sf_dir: str) -> DataFrame:
    """Records that had to be cut."""
    p = split_oversized(source_records(spark, sf_dir))
    return p.filter("pieces > 1 and piece = 0").select("record_kind", "record_id").distinct()


P3_SQL = r"""
SELECT DISTINCT record_kind, record_id FROM (
  SELECT 'result' AS record_kind, doc_key AS record_id, text, 3000 AS m FROM preprocess_results UNION ALL SELECT 'chunk', id, text, 900 FROM chunks)
WHERE length(trim(regexp_replace(text, '[ \t\r\n\x{a0}]+', ' ', 'g'))) > m
"""
