"""High-water marks per key, and the filter that reads past them."""

from __future__ import annotations

import json
import time
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.files import Files


class Mark(NamedTuple):
    """How far a key was read: the last ``updated_at`` as text, the last id at that time, and when this was noted."""

    updated_at: str = ""
    last_id: int = 0
    ts: int = 0


class Marks:
    """The marks of all keys as one JSON object of objects; a change reads it, changes one key and replaces the whole at once."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._files, self._path = Files(spark), path

    def all(self) -> dict[str, Mark]:
        """Fields that an entry lacks have their defaults; further fields are ignored."""
        entries = json.loads(self._files.read(self._path) or "{}")
        return {key: Mark(str(e.get("updated_at") or ""), int(e.get("last_id") or 0), int(e.get("ts") or 0)) for key, e in entries.items()}

    def of(self, key: str) -> Mark | None:
        return self.all().get(key)

    def advance(self, key: str, updated_at: str, last_id: int) -> Mark:
        mark = Mark(updated_at, last_id, int(time.time()))
        self._files.replace(self._path, json.dumps({k: m._asdict() for k, m in {**self.all(), key: mark}.items()}, ensure_ascii=False, indent=2))
        return mark


def after(ts: str, id_col: str, mark: tuple[Column, Column]) -> Column:
    """Rows beyond the mark by ``(ts, id)``; written so that the scan can use the bound on ``ts``."""
    return (F.col(ts) >= mark[0]) & ((F.col(ts) > mark[0]) | (F.col(id_col) > mark[1]))


def read_after(df: DataFrame, ts: str, id_col: str, mark: tuple[Column, Column] | None) -> DataFrame:
    return df if mark is None else df.filter(after(ts, id_col, mark))


def new_mark(df: DataFrame, ts: str, id_col: str) -> tuple | None:
    """The greatest ``(ts, id)``; null for no rows. One partial aggregate per partition."""
    r = df.agg(F.max(F.struct(ts, id_col)).alias("m")).first()["m"]
    return None if r is None else (r[0], r[1])
