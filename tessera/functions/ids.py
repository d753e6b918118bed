"""Identifiers derived from application ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the namespace of point ids.
POINT_NAMESPACE = "b3c9d7e8-4f2a-5b6c-8d9e-0a1b2c3d4e5f"


def point_uuid(col: Column | str, namespace: str = POINT_NAMESPACE) -> Column:
    """UUID version 5 of an id in a namespace, as text. Null gives null."""
    c = F.col(col) if isinstance(col, str) else col
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(c, "UTF-8")))
    nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.hex((nibble % 4 + 8).cast("bigint")))
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"),
        variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
    )


def chunk_id(doc_id: Column, order: Column) -> Column:
    return F.format_string("%s:%06d", doc_id, order)


def parent_of(metadata: Column, id_col: Column) -> Column:
    """``metadata.doc_id`` where it is there and not empty, else the id."""
    return F.coalesce(F.nullif(F.try_element_at(metadata, F.lit("doc_id")), F.lit("")), id_col)
