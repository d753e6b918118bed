"""Words and sets of word runs of texts, in Arrow batches."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import xxhash

_WORD = re.compile("[0-9a-z]+")
_OTHER = re.compile("[^\x00-\x7f]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _parted(m: re.Match) -> str:
    """Of signs beyond ASCII the marks go, all others part words."""
    return "".join("" if unicodedata.combining(c) else " " for c in m[0])


def words(text: str | None) -> list[str]:
    """Accents removed (canonical decomposition, combining marks dropped), lower case, maximal runs of ``[0-9a-z]``."""
    if not text:
        return []
    if not text.isascii():
        text = _OTHER.sub(_parted, unicodedata.normalize("NFD", text))
    return _WORD.findall(text.lower())


class Hasher:
    """64-bit hashes of words, kept for words seen before (up to a bound)."""

    def __init__(self, most: int = 1 << 18) -> None:
        self._seen: dict[str, int] = {}
        self._most = most

    def __call__(self, ws: list[str]) -> np.ndarray:
        seen = self._seen
        if len(seen) > self._most:
            seen.clear()
        for w in set(ws).difference(seen):
            seen[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(seen.__getitem__, ws), np.uint64, len(ws))


def runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(h) - n + 1, np.uint64)
        for i in range(n):
            out = (out ^ (out >> np.uint64(29))) * _ODD + h[i : len(h) - n + 1 + i]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(29))


def batch_sets(texts: list[str | None], n: int, least: int, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sets of word runs of all texts with at least so many words.

    Returns the places of these texts, and for each member the number of its text among them and its hash, sorted by both.
    """
    at, lens, flat = [], [], []
    for i, t in enumerate(texts):
        w = words(t)
        if len(w) >= max(least, n):
            at.append(i)
            lens.append(len(w))
            flat.extend(w)
    r = runs(hasher(flat), n)
    rec = np.repeat(np.arange(len(at)), lens)
    inside = rec[: len(r)] == rec[n - 1 : n - 1 + len(r)]
    r, rec = r[inside], rec[: len(r)][inside]
    o = np.lexsort((r, rec))
    r, rec = r[o], rec[o]
    first = np.ones(len(r), bool)
    first[1:] = (r[1:] != r[:-1]) | (rec[1:] != rec[:-1])
    return np.array(at, np.int64), rec[first], r[first]
