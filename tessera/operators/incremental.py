"""Processing only what is new or changed.

A partition (source and a hash bucket of the row id, so that a large source is many partitions) has a fingerprint: the
number of its rows and the sum of their hashes, both added up before the shuffle. A run recomputes the partitions whose
fingerprint differs from the one kept by the last run and replaces each by dynamic partition overwrite. The new
fingerprints are kept last, by one atomic rename: a run that fails before that is repeated with the same result. As the
overwrite itself moves one partition after the other, the keys of the partitions that it touches are noted before: after a
failure they are computed again even where the input is again what it was, and until then the table cannot be read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, table
from tessera.sources.files import Files

#: Rows of a partition as planned: a source has as many buckets (a power of two) as its rows need.
ROWS = 250_000


def fingerprints(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``keys, n, h``: count and additive hash. The sum is a decimal, so it neither overflows nor depends on order."""
    h = F.xxhash64(*[F.col(c) for c in columns]).cast("decimal(38,0)")
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(h).cast("string").alias("h"))


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out


class ChangedPartitions:
    """A result table kept in step with its input, partition by partition.

    rows(keys + columns) -> compute(rows of some partitions) -> result with the same keys. Partitions that lost all
    their rows are emptied. A marker row in each partition written lets an empty result replace an old one.
    """

    def __init__(self, spark, path: str, keys: list[str]) -> None:
        self.spark, self.path, self.keys, self.files = spark, path.rstrip("/"), keys, Files(spark)

    def _noted(self, name: str) -> str | None:
        text = self.files.read(f"{self.path}/{name}")
        return None if text is None else json.loads(text)["folder"]

    def _folder(self, kind: str, df: DataFrame) -> tuple[str, DataFrame]:
        folder = f"{kind}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        return folder, self.spark.read.parquet(f"{self.path}/{folder}")

    def refresh(self, rows: DataFrame, columns: list[str], compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Bring the table up to date and return the keys of the partitions that were recomputed."""
        state, broken = self._noted("state.json"), self._noted("pending.json")
        new, now = self._folder("fingerprints", fingerprints(rows, self.keys, columns))
        if state is None:
            changed = now.select(*self.keys)
        else:
            o = self.spark.read.parquet(f"{self.path}/{state}").select(*self.keys, F.col("n").alias("on"), F.col("h").alias("oh"))
            j = now.alias("a").join(o.alias("b"), _same(now, o, self.keys), "full")
            differs = ~(F.col("n").eqNullSafe(F.col("on")) & F.col("h").eqNullSafe(F.col("oh")))
            changed = j.filter(differs).select(*[F.when(F.col("n").isNull(), F.col(f"b.{k}")).otherwise(F.col(f"a.{k}")).alias(k) for k in self.keys])
        if broken is not None:
            changed = changed.union(self.spark.read.parquet(f"{self.path}/{broken}").select(*self.keys)).distinct()
        noted, changed = self._folder("changed", changed)
        count = changed.count()
        if count or state is None:
            self.files.replace(f"{self.path}/pending.json", json.dumps({"folder": noted}))
            part = rows.join(changed, _same(rows, changed, self.keys), "left_semi")
            out = compute(part).withColumn("__marker", F.lit(False))
            every = out.unionByName(changed.withColumn("__marker", F.lit(True)), allowMissingColumns=True)
            # a partition value lies in one task; the buckets in the keys bound what a task holds
            tasks = max(1, min(count, 4 * int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
            every.repartition(tasks, *self.keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.keys).parquet(f"{self.path}/rows")
        self.files.replace(f"{self.path}/state.json", json.dumps({"folder": new}))
        self.files.delete(f"{self.path}/pending.json")
        for old in (state, broken):
            if old is not None:
                self.files.delete(f"{self.path}/{old}")
        return changed

    def read(self) -> DataFrame:
        if self._noted("pending.json") is not None:
            raise RuntimeError(f"an update of {self.path} is under way or was broken off; refresh it first")
        return self.spark.read.option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows").filter("not __marker").drop("__marker")


_ZONE = r"(Z|[+-]\d{2}:?\d{2})$"


def iso_utc(text: str) -> Column:
    """ISO-8601 text as TIMESTAMP_NTZ in UTC; without an offset it is UTC already. Empty or unreadable text is null."""
    zone = F.regexp_extract(text, _ZONE, 1)
    digits = F.regexp_replace(zone, ":", "")
    minutes = F.coalesce(F.substring(digits, 2, 2).try_cast("int") * 60 + F.substring(digits, 4, 2).try_cast("int"), F.lit(0))
    signed = F.when(zone.startswith("-"), -minutes).otherwise(minutes)
    base = F.replace(F.regexp_replace(F.trim(F.col(text)), _ZONE, ""), F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")
    return base - F.make_dt_interval(F.lit(0), F.lit(0), signed)


def last_runs(checkpoints: DataFrame) -> DataFrame:
    """``source_key, ts, mark, last_id`` of each source's successful run with the greatest ``ts`` (then ``run_id``)."""
    ok = checkpoints.filter("status = 'ok' and ts is not null").select("source_key", F.struct("ts", "run_id").alias("o"), F.struct("ts", iso_utc("updated_at").alias("mark"), "last_id").alias("r"))
    m = ok.groupBy("source_key").agg(F.max_by("r", "o").alias("r"))
    end = F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, r.ts)")
    return m.select("source_key", end.alias("run_end"), "r.mark", "r.last_id")


def deliveries(rows: DataFrame, runs: DataFrame, size: int = ROWS) -> DataFrame:
    """``source_key, bucket, id, updated_at, loaded_at, processed`` of every delivery, repeated ones included.

    Processed: loaded by the end of the source's last successful run and, where dated, not beyond its mark
    ``(updated_at, last_id)``; a run without a mark processed no dated delivery. A null ``loaded_at`` is not processed.
    """
    r = rows.select("source_key", "id", "updated_at", "loaded_at")
    m = runs.withColumnRenamed("source_key", "__s")
    j = r.join(m, r["source_key"].eqNullSafe(m["__s"]), "left")
    dated = (F.col("updated_at") < F.col("mark")) | ((F.col("updated_at") == F.col("mark")) & (F.col("id") <= F.col("last_id")))
    done = (F.col("loaded_at") <= F.col("run_end")) & (F.col("updated_at").isNull() | dated)
    n = rows.groupBy(F.col("source_key").alias("__k")).agg(F.count("*").alias("__n"))
    buckets = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("__n") / F.lit(size))))).cast("bigint")
    j = j.join(n.select("__k", buckets.alias("__b")), F.col("source_key").eqNullSafe(F.col("__k")))
    bucket = F.pmod(F.xxhash64("id"), F.col("__b")).cast("int")
    return j.select("source_key", bucket.alias("bucket"), "id", "updated_at", "loaded_at", F.coalesce(done, F.lit(False)).alias("processed"))


def open_rows(d: DataFrame) -> DataFrame:
    """``source_key, bucket, row_id`` of rows with a version (distinct ``updated_at``, null being one) of which no delivery was processed."""
    v = d.groupBy("source_key", "bucket", "id", "updated_at").agg(F.bool_or("processed").alias("p"))
    return v.filter("not p").select("source_key", "bucket", F.col("id").alias("row_id")).distinct()


def pending_rows(rows: DataFrame, checkpoints: DataFrame, path: str, size: int = ROWS) -> DataFrame:
    """``source_key, row_id``: exactly the rows that are new or changed since the last successful run of their source.

    The table under ``path`` is brought up to date; only (source, bucket) partitions whose deliveries or marks changed
    since the last call are recomputed. Empty inputs give no rows; extra columns are ignored; a null source is a source.
    """
    d = deliveries(rows, last_runs(checkpoints), size)
    t = ChangedPartitions(rows.sparkSession, path, ["source_key", "bucket"])
    t.refresh(d, ["source_key", "id", "updated_at", "loaded_at", "processed"], open_rows)
    return t.read().select(F.col("source_key").cast("string").alias("source_key"), "row_id")


def p4_found(spark, sf_dir: str) -> DataFrame:
    """All deliveries, in two calls: what was there at the end of the last successful run of any source, then everything.
    The second call recomputes the partitions that changed since."""
    path = f"{checkpoint_dir(spark)}/pending-{uuid.uuid4().hex}"
    rows, runs = table(spark, sf_dir, "ingest_rows"), table(spark, sf_dir, "checkpoints")
    end = last_runs(runs).agg(F.max("run_end").alias("e")).first()["e"]
    if end is not None:
        pending_rows(rows.filter(F.col("loaded_at") <= F.lit(end)), runs, path)
    return pending_rows(rows, runs, path)


P4_SQL = r"""
WITH r AS (
  SELECT source_key, ts, last_id, TIMESTAMP '1970-01-01' + to_seconds(ts) AS run_end, trim(updated_at) AS u,
    regexp_extract(updated_at, '(Z|[+-]\d{2}:?\d{2})$', 1) AS z
  FROM (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY ts DESC, run_id DESC) AS n FROM checkpoints WHERE status = 'ok') WHERE n = 1),
m AS (
  SELECT source_key, run_end, last_id,
    TRY_CAST(replace(substr(u, 1, length(u) - length(z)), 'T', ' ') AS TIMESTAMP)
      - CASE WHEN z IN ('', 'Z') OR z IS NULL THEN INTERVAL 0 MINUTE
          ELSE to_minutes((CASE WHEN z LIKE '-%' THEN -1 ELSE 1 END) * (substr(z, 2, 2)::INT * 60 + right(z, 2)::INT)) END AS mark
  FROM r),
d AS (
  SELECT i.source_key, i.id, i.updated_at,
    coalesce(loaded_at <= run_end AND (i.updated_at IS NULL OR i.updated_at < mark OR (i.updated_at = mark AND i.id <= last_id)), false) AS p
  FROM ingest_rows i LEFT JOIN m ON m.source_key IS NOT DISTINCT FROM i.source_key)
SELECT DISTINCT source_key, id AS row_id FROM (SELECT source_key, id, updated_at, bool_or(p) AS p FROM d GROUP BY ALL) WHERE NOT p
"""
