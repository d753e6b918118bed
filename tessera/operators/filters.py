"""Metadata filters as column expressions.

Two dialects: plain ``{field: value or list}`` (all must hold) and the operator dialect
``{"field": {"$gte": 3}}`` with ``$and`` / ``$or``. An empty or null filter keeps all rows.
A field resolves to a column of that name, else to a key of the ``metadata`` map.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COMPARE = {
    "$eq": lambda c, v: c == v,
    "$ne": lambda c, v: c != v,
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v,
    "$in": lambda c, v: c.isin(list(v)),
    "$nin": lambda c, v: ~c.isin(list(v)),
}


def _field(df: DataFrame, name: str, value: Any) -> Column:
    if name in df.columns:
        return F.col(f"`{name}`")
    if "metadata" in df.columns:
        c = F.try_element_at("metadata", F.lit(name))
        sample = next(iter(value), None) if isinstance(value, (list, tuple, set)) else value
        if isinstance(sample, bool):
            return c.try_cast("boolean")
        return c.try_cast("double") if isinstance(sample, (int, float)) else c
    raise ValueError(f"Unknown filter field: {name!r}")


def plain_filter(df: DataFrame, where: Mapping[str, Any] | None) -> Column:
    """Equality, or membership where the value is a list, tuple or set; joined by AND. Unknown truth is false."""
    out = F.lit(True)
    for name, value in (where or {}).items():
        c = _field(df, name, value)
        out = out & (c.isin(list(value)) if isinstance(value, (list, tuple, set)) else c == F.lit(value))
    return F.coalesce(out, F.lit(False))


def operator_filter(df: DataFrame, where: Mapping[str, Any] | None) -> Column:
    """The dialect with ``$`` operators. Unknown truth is false."""
    return F.coalesce(_compile(df, where), F.lit(False))


def _compile(df: DataFrame, where: Mapping[str, Any] | None) -> Column:
    out = F.lit(True)
    for name, value in (where or {}).items():
        if name in ("$and", "$or"):
            parts = [_compile(df, w) for w in value]
            if not parts:
                raise ValueError(f"{name} needs at least one clause")
            joined = parts[0]
            for p in parts[1:]:
                joined = joined & p if name == "$and" else joined | p
            out = out & joined
        elif isinstance(value, Mapping):
            for op, v in value.items():
                if op not in _COMPARE:
                    raise ValueError(f"Unknown filter operator: {op!r}")
                out = out & _COMPARE[op](_field(df, name, v), v if op in ("$in", "$nin") else F.lit(v))
        else:
            out = out & (_field(df, name, value) == F.lit(value))
    return out


def document_filter(where_document: Mapping[str, Any] | None, column: str = "document") -> Column:
    """``$contains``, ``$not_contains``, ``$and`` and ``$or`` over the document text."""
    out = F.lit(True)
    for op, v in (where_document or {}).items():
        if op == "$contains":
            out = out & F.contains(F.col(column), F.lit(v))
        elif op == "$not_contains":
            out = out & ~F.contains(F.col(column), F.lit(v))
        elif op in ("$and", "$or"):
            parts = [document_filter(w, column) for w in v]
            joined = parts[0]
            for p in parts[1:]:
                joined = joined & p if op == "$and" else joined | p
            out = out & joined
        else:
            raise ValueError(f"Unknown document operator: {op!r}")
    return F.coalesce(out, F.lit(False))
