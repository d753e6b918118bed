"""Schemaless documents: required fields and field access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_fields(doc: Column, required: list[str]) -> Column:
    """The required keys that a ``MAP<STRING, STRING>`` document lacks; a null value counts as present."""
    keys = F.coalesce(F.map_keys(doc), F.array().cast("array<string>"))
    return F.filter(F.array(*[F.lit(r) for r in required]).cast("array<string>"), lambda r: ~F.array_contains(keys, r))


def require_fields(docs: DataFrame, doc_col: str, required: list[str], strict: bool = True) -> DataFrame:
    """Strict: an error naming all missing fields. Lenient: a column ``missing`` beside each row. A null document lacks all."""
    m = missing_fields(F.col(doc_col), required)
    if not strict:
        return docs.withColumn("missing", m)
    text = F.concat(F.lit("Missing required fields: "), F.array_join(m, ", "))
    return docs.filter(F.when(F.size(m) > 0, F.raise_error(text).cast("boolean")).otherwise(True))


def parse_documents(col: str) -> Column:
    """JSON text as a document map; broken JSON gives null."""
    return F.from_json(F.col(col), "map<string,string>")


def field_or(doc: Column, name: str, default: str | None = None) -> Column:
    return F.coalesce(F.try_element_at(doc, F.lit(name)), F.lit(default))
