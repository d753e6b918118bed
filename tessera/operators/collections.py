"""Collections of records kept as parquet, with atomic changes.

A collection is hash-bucketed by id. A change rewrites only the buckets it touches, into a new version folder, and then
replaces the manifest, which names the folder of every bucket; readers see the old or the new state, never a mixture.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.ids import point_uuid
from tessera.functions.vectors import HIGHER_IS_BETTER
from tessera.operators.embedding import resolve_vectors
from tessera.operators.filters import document_filter, operator_filter, plain_filter
from tessera.operators.keyword import sparse_idf, with_sparse
from tessera.operators.search import knn
from tessera.session import stored
from tessera.sources.files import Files

SCHEMA = "id STRING, vector ARRAY<DOUBLE>, document STRING, metadata MAP<STRING,STRING>"
#: Sparse vectors of the documents, stored beside them where a store is opened for keyword search.
SPARSE = "idx ARRAY<BIGINT>, tf ARRAY<DOUBLE>"
#: Records of a bucket as planned; with twice as many the number of buckets doubles.
BUCKET_ROWS = 250_000
#: Ids of a list that may be broadcast; a longer one is joined.
MOST_BROADCAST = 100_000
#: Rows of a filtered read without a limit, and of a search without a k.
DEFAULT_LIMIT, DEFAULT_K = 100, 5
_ENGINES = ("memory", "persistent")


def open_store(spark: SparkSession, engine: str = "memory", path: str | None = None, **options: Any) -> CollectionStore:
    """``memory`` keeps the collections in a temporary folder of the session, ``persistent`` under ``path``."""
    if engine not in _ENGINES:
        raise ValueError(f"Unknown engine: {engine!r}; use one of {_ENGINES}")
    if engine == "persistent" and not path:
        raise ValueError("the persistent engine needs a path")
    if engine == "memory":
        from tessera.session import checkpoint_dir

        path = f"{checkpoint_dir(spark)}/collections"
    return CollectionStore(spark, path, **options)


def latest_per_id(df: DataFrame, order: Column | None = None) -> DataFrame:
    """One row per id: the last by ``order`` (any one where equal or without order). Partial aggregation precedes the shuffle."""
    cols = [c for c in df.columns if c != "id"]
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    agg = F.max_by(row, order) if order is not None else F.any_value(row)
    return df.groupBy("id").agg(agg.alias("__r")).select("id", *[F.col(f"__r.`{c}`") for c in cols])


class CollectionStore:
    """Create, change, read and search collections.

    dialect: ``plain`` (equality and lists) or ``operators`` (``$gte`` and the like, document filters). ``merge=True``
    keeps the old value of a field that an upsert leaves null; otherwise the record is replaced whole.
    """

    def __init__(self, spark: SparkSession, path: str, *, distance: str = "cosine", dialect: str = "plain", embedder=None, keyword: bool = False, merge: bool = False, buckets: int = 16) -> None:
        if distance not in HIGHER_IS_BETTER:
            raise ValueError(f"Unknown distance: {distance!r}")
        self.spark, self.path, self.distance, self.dialect = spark, path.rstrip("/"), distance, dialect
        self.embedder, self.keyword, self.merge, self.buckets = embedder, keyword, merge, buckets
        self.files = Files(spark)

    # -- collections
    def _manifest(self, name: str) -> dict | None:
        text = self.files.read(f"{self.path}/{name}/manifest.json")
        return None if text is None else json.loads(text)

    def create_collection(self, name: str) -> None:
        if self._manifest(name) is None:
            self._commit(name, {"version": 0, "buckets": self.buckets, "distance": self.distance, "folders": {}})

    def _read(self, name: str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], f"{SCHEMA}, {SPARSE}")
        return self.spark.read.schema(f"{SCHEMA}, {SPARSE}").parquet(*[f"{self.path}/{name}/{f}" for f in folders])

    def _records(self, name: str) -> DataFrame:
        m = self._manifest(name)
        if m is None:
            self.create_collection(name)
            m = self._manifest(name)
        return self._read(name, sorted(set(m["folders"].values())))

    def get_collection(self, name: str) -> DataFrame:
        """All records, with their bucket hidden. An unknown collection is created."""
        return self._records(name).drop("idx", "tf")

    def delete_collection(self, name: str) -> None:
        self.files.delete(f"{self.path}/{name}")

    def _commit(self, name: str, manifest: dict) -> None:
        self.files.replace(f"{self.path}/{name}/manifest.json", json.dumps(manifest))

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def _rewrite(self, name: str, touched: list[int], rows) -> None:
        """Replace the touched buckets by ``rows(old records of these buckets)``."""
        if not touched:
            return
        m = self._manifest(name)
        old = [f for b, f in m["folders"].items() if int(b) in touched]
        version = self._write(name, m, rows(self._read(name, old)), len(touched), m["buckets"])
        there = set(self.files.names(f"{self.path}/{name}/v{version}"))
        folders = {b: f for b, f in m["folders"].items() if int(b) not in touched}
        folders |= {str(b): f"v{version}/b={b}" for b in touched if f"b={b}" in there}
        self._commit(name, m | {"version": version, "folders": folders})

    def _write(self, name: str, m: dict, rows: DataFrame, tasks: int, buckets: int) -> int:
        version = m["version"] + 1
        out = rows.select("id", "vector", "document", "metadata", "idx", "tf").withColumn("b", self._bucket(buckets))
        out.repartition(tasks, "b").write.mode("overwrite").partitionBy("b").parquet(f"{self.path}/{name}/v{version}")
        return version

    def _grow(self, name: str, coming: int) -> None:
        """More buckets before an upsert that would fill them twice over, so that a bucket stays a bounded piece of work."""
        m = self._manifest(name)
        need = -(-(coming + (self.count(name) if m["folders"] else 0)) // (2 * BUCKET_ROWS))
        if need <= m["buckets"]:
            return
        n = 1 << (need - 1).bit_length()
        if not m["folders"]:
            self._commit(name, m | {"buckets": n})
            return
        version = self._write(name, m, self._records(name), n, n)
        self._commit(name, m | {"version": version, "buckets": n, "folders": {x[2:]: f"v{version}/{x}" for x in self.files.names(f"{self.path}/{name}/v{version}") if x.startswith("b=")}})

    def _touched(self, name: str, ids: DataFrame) -> list[int]:
        n = self._manifest(name)["buckets"]
        return sorted(r[0] for r in ids.select(self._bucket(n).alias("b")).distinct().collect())

    # -- changes
    def upsert(self, name: str, records: DataFrame) -> None:
        """Insert or replace by id. Of ids repeated in one batch any one row wins; rows without id are refused.

        Missing columns are null; without ``vector`` the store's embedder is applied to ``document``.
        """
        self.create_collection(name)
        r = resolve_vectors(records, self.embedder)
        for c, t in (("document", "string"), ("metadata", "map<string,string>")):
            if c not in r.columns:
                r = r.withColumn(c, F.lit(None).cast(t))
        r = r.select(F.when(F.col("id").isNull(), F.raise_error(F.lit("a record needs an id"))).otherwise(F.col("id").cast("string")).alias("id"), F.col("vector").cast("array<double>").alias("vector"), "document", "metadata")
        # written once: it is counted, tells the buckets, and is what replaces the old rows
        new = stored(self._sparse(latest_per_id(r)))
        self._grow(name, new.count())

        def rows(old: DataFrame) -> DataFrame:
            if not self.merge:
                return old.join(new.select("id"), "id", "left_anti").unionByName(new)
            o = old.select("id", *[F.col(c).alias(f"o_{c}") for c in ("vector", "document", "metadata", "idx", "tf")])
            j = o.join(new, "id", "full")
            kept = F.col("document").isNull()  # then the old document stays, and its sparse vector with it
            return j.select("id", *[F.coalesce(c, f"o_{c}").alias(c) for c in ("vector", "document", "metadata")], *[F.when(kept, F.col(f"o_{c}")).otherwise(F.col(c)).alias(c) for c in ("idx", "tf")])

        self._rewrite(name, self._touched(name, new), rows)

    def _sparse(self, df: DataFrame) -> DataFrame:
        """With the sparse vectors of the documents, or nulls where the store is not for keyword search."""
        if self.keyword:
            d = with_sparse(df, "document")
            return d.withColumns({c: F.when(F.col("document").isNotNull(), F.col(c)) for c in ("idx", "tf")})
        return df.withColumn("idx", F.lit(None).cast("array<bigint>")).withColumn("tf", F.lit(None).cast("array<double>"))

    def _where(self, df: DataFrame, where: Mapping[str, Any] | None, where_document: Mapping[str, Any] | None) -> Column:
        if where_document and self.dialect == "plain":
            raise ValueError("where_document is not supported by this dialect")
        f = (plain_filter if self.dialect == "plain" else operator_filter)(df, where)
        return f & document_filter(where_document) if where_document else f

    def delete(self, name: str, ids: list[str] | None = None, where: Mapping[str, Any] | None = None, where_document: Mapping[str, Any] | None = None) -> None:
        """Delete by ids, which win over a filter in the plain dialect and narrow it in the other; neither deletes nothing."""
        if ids is None and not where and not where_document:
            return
        every = list(range(self._manifest(name)["buckets"]))
        if ids is not None and (self.dialect == "plain" or not (where or where_document)):
            keys = self.spark.createDataFrame([(i,) for i in ids], "id STRING")
            self._rewrite(name, self._touched(name, keys), lambda old: old.join(keys, "id", "left_anti"))
            return
        self._rewrite(name, every, lambda old: old.filter(~(self._where(old, where, where_document) & (F.col("id").isin(list(ids)) if ids is not None else F.lit(True)))))

    # -- reads
    def get(self, name: str, ids: list[str] | None = None, where: Mapping[str, Any] | None = None, limit: int | None = None, include_vectors: bool = True) -> DataFrame:
        """Records by ids, or by filter in the order of their point ids up to a limit (100). Scores are null."""
        c = self.get_collection(name)
        if ids is not None:
            keys = self.spark.createDataFrame([(i,) for i in ids], "id STRING").distinct()
            c = c.join(F.broadcast(keys) if len(ids) <= MOST_BROADCAST else keys, "id", "left_semi")
        else:
            c = c.filter(self._where(c, where, None)).orderBy(point_uuid("id")).limit(limit or DEFAULT_LIMIT)
        c = c.withColumn("metadata", F.when(F.size("metadata") > 0, F.col("metadata"))).withColumn("score", F.lit(None).cast("double"))
        return c if include_vectors else c.drop("vector")

    def count(self, name: str) -> int:
        return self.get_collection(name).count()

    def query(self, name: str, queries: DataFrame, n_results: int = DEFAULT_K, where: Mapping[str, Any] | None = None, where_document: Mapping[str, Any] | None = None, include_vectors: bool = False) -> DataFrame:
        """The nearest records of each query, filtered before the search, with their fields and ``metric``."""
        c = self.get_collection(name)
        c = c.filter(self._where(c, where, where_document))
        q = queries if "vector" in queries.columns else resolve_vectors(queries, self.embedder, "text")
        hits = knn(c, q, n_results, self.distance)
        cols = ["id", "document", "metadata", *(["vector"] if include_vectors else [])]
        return hits.join(c.select(*cols), "id").withColumn("metric", F.lit(self.distance))

    def keyword_search(self, name: str, queries: DataFrame, k: int = 50, where: Mapping[str, Any] | None = None) -> DataFrame:
        if not self.keyword:
            raise ValueError("the store was opened without keyword=True")
        c = self._records(name)
        # written by a store that was not opened for keyword search
        late = c.filter("document is not null and idx is null").drop("idx", "tf")
        if not late.isEmpty():
            c = c.filter("document is null or idx is not null").unionByName(self._sparse(late))
        return sparse_idf(c, queries, k, text_col="document", where=self._where(c, where, None) if where else None)

    def persist(self) -> None:
        """Every change is on storage once it returns; nothing is left to do."""

    def close(self) -> None:
        """May be called more than once."""


def payload(metadata: Column, document: Column, id_col: Column) -> Column:
    """Metadata, then ``document``, then ``_kb_id``; later keys win. Null document is left out."""
    kept = F.map_filter(F.coalesce(metadata, F.create_map().cast("map<string,string>")), lambda k, _: (k != "_kb_id") & ((k != "document") | document.isNull()))
    doc = F.when(document.isNull(), F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit("document"), document))
    return F.map_concat(kept, doc, F.create_map(F.lit("_kb_id"), id_col))


def record_metadata(p: Column) -> Column:
    """The metadata of a payload; null where nothing is left."""
    m = F.map_filter(p, lambda k, _: k != "_kb_id")
    return F.when(F.size(m) > 0, m)


def upsert_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The union in which rows of ``new`` replace those of the same id."""
    return existing.join(new.select("id"), "id", "left_anti").unionByName(new)


def delete_rows(existing: DataFrame, ids: DataFrame) -> DataFrame:
    return existing.join(ids.select("id"), "id", "left_anti")


def first_by_point(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("point_id", point_uuid(F.col("id"))).orderBy("point_id").limit(n)
