"""Vector measures as column expressions, and masked mean pooling.

Expressions give null where a vector is null or lengths differ. A zero vector has cosine 0 to everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: measure -> True where a higher score is better
HIGHER_IS_BETTER = {"cosine": True, "dot": True, "euclid": False, "manhattan": False, "l2sq": False}


def _sum(a: Column, b: Column, f) -> Column:
    z = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), f)
    return F.when(F.size(a) == F.size(b), F.aggregate(z, F.lit(0.0), lambda s, x: s + x))


def dot(a: Column, b: Column) -> Column:
    return _sum(a, b, lambda x, y: x * y)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    n = norm(a) * norm(b)
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / F.nullif(n, F.lit(0.0)))


def l2sq(a: Column, b: Column) -> Column:
    return _sum(a, b, lambda x, y: (x - y) * (x - y))


def euclid(a: Column, b: Column) -> Column:
    return F.sqrt(l2sq(a, b))


def manhattan(a: Column, b: Column) -> Column:
    return _sum(a, b, lambda x, y: F.abs(x - y))


MEASURES = {"cosine": cosine, "dot": dot, "euclid": euclid, "manhattan": manhattan, "l2sq": l2sq}


def measure(name: str, a: Column, b: Column) -> Column:
    if name not in MEASURES:
        raise ValueError(f"Unknown distance: {name!r}; use one of {sorted(MEASURES)}")
    return MEASURES[name](a, b)


def masked_mean(df: DataFrame, key: str, vector: str, mask: str, digits: int | None = None) -> DataFrame:
    """Mean of the vectors of each key whose mask is not 0, per dimension; the divisor is at least 1e-9.

    Null vectors and null masks add nothing. Sums per dimension are combined before the shuffle.
    """
    e = df.select(F.col(key), F.coalesce(F.col(mask).cast("double"), F.lit(0.0)).alias("m"), F.posexplode(vector).alias("i", "x"))
    s = e.groupBy(key, "i").agg((F.sum(F.col("x").cast("double") * F.col("m")) / F.greatest(F.sum("m"), F.lit(1e-9))).alias("v"))
    v = F.col("v") if digits is None else F.round("v", digits)
    return s.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", v.alias("v")))), lambda x: x["v"]).alias("vector"))
