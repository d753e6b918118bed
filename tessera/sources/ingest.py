"""Reading rows by SQL with bound parameters, and writing them as JSON."""

from __future__ import annotations

import contextlib
import datetime as dt
import itertools
import json
import math
import re
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.interfaces import BaseIngestor
from tessera.session import stored, stored_parts
from tessera.sources.files import Files
from tessera.sources.retry import retryable

#: Fixed value: rows per fetch of a streamed read.
FETCH_SIZE = 1000


_MARKER = re.compile(r"""'(?:[^']|'')*'|"[^"]*"|(?<![:\w]):([A-Za-z_]\w*)""")
_READS = re.compile(r"\s*(?:\(|select\b|with\b|values\b|show\b|describe\b)", re.I)

#: URLs of databases inside the process that opens them: another process does not see them or finds them locked.
_EMBEDDED = re.compile(r"jdbc:(?:derby:(?!//)|h2:(?!(?:tcp|ssl):)|hsqldb:(?!(?:hsql|http)s?:)|sqlite:|duckdb:)", re.I)


def with_markers(query: str, params: Mapping[str, Any], put: Callable[[Any], str]) -> str:
    """The query with ``put(value)`` for each ``:name`` outside quotes. A name without a value is an error."""

    def one(m: re.Match) -> str:
        if m[1] is None:
            return m[0]
        if m[1] not in params:
            raise ValueError(f"no value for :{m[1]}")
        return put(params[m[1]])

    return _MARKER.sub(one, query)


def literal(value: Any) -> str:
    """A value as a typed SQL literal. Text with signs that some databases read as escapes is refused, not rewritten."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("a bound number must be finite")
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"{{ts '{value.strftime('%Y-%m-%d %H:%M:%S.%f')}'}}"
    if isinstance(value, dt.date):
        return f"{{d '{value.isoformat()}'}}"
    if isinstance(value, str):
        if "\\" in value or any(ord(c) < 32 for c in value):
            raise ValueError("a bound text must not hold backslashes or control signs; filter on the DataFrame instead")
        return "'" + value.replace("'", "''") + "'"
    raise ValueError(f"no literal for {type(value).__name__}")


class SqlIngestor(BaseIngestor):
    """Rows of a query as a DataFrame (batch) or an iterator of rows (stream).

    Without a ``url`` the query runs on the views and tables of the session; with one it is pushed to that database by
    JDBC, and a partition column with bounds splits the read. There statements that return no rows run as well, and give
    ``{"rowcount": N}``. Values are bound under ``:name``: by the engine itself, or by a prepared statement; only a read by JDBC
    takes them as typed literals. A database inside the driver's process is read by the driver where executors are other
    processes, ``fetch_size`` rows at a time.
    """

    def __init__(self, spark: SparkSession, url: str | None = None, stream: bool = False, properties: Mapping[str, str] | None = None) -> None:
        self.spark, self.url, self.stream, self.properties = spark, url, stream, dict(properties or {})
        self._pool: ThreadPoolExecutor | None = None

    def frame(self, query: str, params: Mapping[str, Any] | None = None, *, fetch_size: int = FETCH_SIZE, split: tuple[str, int, int, int] | None = None) -> DataFrame:
        """The lazy result. split: column, lower bound, upper bound, number of partitions (JDBC only).

        What only the driver can read is read at once, in one piece whatever the split, and kept in the shared folder.
        """
        if self.url is None:
            return self.spark.sql(query, args=dict(params or {}))
        if self._driver_only():
            return stored_parts(self._blocks(query, params, fetch_size))
        return self._pushed(query, params, fetch_size, split)

    def _pushed(self, query: str, params: Mapping[str, Any] | None, fetch_size: int, split: tuple[str, int, int, int] | None = None) -> DataFrame:
        query = with_markers(query, params or {}, literal)
        r = self.spark.read.format("jdbc").options(url=self.url, fetchsize=fetch_size, **self.properties)
        if split:
            c, lo, hi, n = split
            return r.options(dbtable=f"({query}) q", partitionColumn=c, lowerBound=lo, upperBound=hi, numPartitions=n).load()
        return r.option("query", query).load()

    def _driver_only(self) -> bool:
        return self.url is not None and _EMBEDDED.match(self.url) is not None and not self.spark.sparkContext._jsc.sc().isLocal()

    def _blocks(self, query: str, params: Mapping[str, Any] | None, fetch_size: int) -> Iterator[DataFrame]:
        """The rows in their order, in blocks that the driver reads, converted as Spark's own JDBC source does; at least one block."""
        jvm = self.spark._jvm
        sql, java = jvm.org.apache.spark.sql, jvm.scala.jdk.javaapi.CollectionConverters
        schema = self._pushed(query, params, fetch_size)._jdf.schema()
        with self._connected() as c:
            s = c.createStatement()
            s.setFetchSize(fetch_size)
            rows = s.executeQuery(with_markers(query, params or {}, literal))
            blocks = sql.execution.datasources.jdbc.JdbcUtils.resultSetToRows(rows, schema, sql.jdbc.JdbcDialects.get(self.url)).grouped(fetch_size or FETCH_SIZE)
            block = java.asJava(blocks.next()) if blocks.hasNext() else jvm.java.util.ArrayList()
            while block is not None:
                yield DataFrame(self.spark._jsparkSession.createDataFrame(block, schema), self.spark)
                block = java.asJava(blocks.next()) if blocks.hasNext() else None

    @contextlib.contextmanager
    def _connected(self) -> Iterator[Any]:
        """A connection of the driver for one transaction, rolled back after an error or when a stream is given up."""
        jvm = self.spark._jvm
        p = jvm.java.util.Properties()
        for k, v in self.properties.items():
            p.setProperty(k, str(v))
        c = jvm.java.sql.DriverManager.getConnection(self.url, p)
        try:
            c.setAutoCommit(False)
            yield c
            c.commit()
        except BaseException:
            with contextlib.suppress(Exception):
                c.rollback()
            raise
        finally:
            with contextlib.suppress(Exception):
                c.close()

    @retryable
    def fetched(self, query: str, params: Mapping[str, Any] | None = None, **options: Any) -> DataFrame:
        """The result read to its end and kept as a table in the shared folder; the read is what is repeated after an error."""
        df = self.frame(query, params, **options)
        return df if self._driver_only() else stored(df)

    @retryable
    def _opened(self, query: str, params: Mapping[str, Any] | None, chunk_size: int) -> Iterator[Row]:
        """An iterator whose first row is there: errors before it are repeated, later ones are the caller's."""
        if self._driver_only():
            rows = (r for b in self._blocks(query, params, chunk_size) for r in b.collect())
        else:
            rows = self.frame(query, params, fetch_size=chunk_size).toLocalIterator()
        first = list(itertools.islice(rows, 1))
        return itertools.chain(first, rows)

    @retryable
    def execute(self, statement: str, params: Mapping[str, Any] | None = None) -> dict[str, int]:
        """Run a statement that returns no rows, in one transaction, and report ``{"rowcount": N}``."""
        if self.url is None:
            raise ValueError("statements that change rows need a url; tables of the engine change by upsert and delete")
        values: list[Any] = []
        text = with_markers(statement, params or {}, lambda v: values.append(v) or "?")
        jvm = self.spark._jvm
        with self._connected() as c:
            s = c.prepareStatement(text)
            for i, v in enumerate(values, 1):
                if isinstance(v, dt.datetime):
                    v = jvm.java.sql.Timestamp.valueOf(v.strftime("%Y-%m-%d %H:%M:%S.%f"))
                elif isinstance(v, dt.date):
                    v = jvm.java.sql.Date.valueOf(v.isoformat())
                s.setObject(i, v)
            return {"rowcount": s.executeUpdate()}

    def ingest(self, query: str, params: Mapping[str, Any] | None = None, chunk_size: int = FETCH_SIZE) -> DataFrame | Iterator[Row] | dict[str, int]:
        if self.url is not None and not _READS.match(query):
            return self.execute(query, params)
        if self.stream:
            return self._opened(query, params, chunk_size)
        return self.frame(query, params) if self.url is None else self.fetched(query, params, fetch_size=chunk_size)

    def a_ingest(self, query: str, params: Mapping[str, Any] | None = None, chunk_size: int = FETCH_SIZE) -> Future:
        """The same in a thread of its own."""
        self._pool = self._pool or ThreadPoolExecutor(4)
        return self._pool.submit(self.ingest, query, params, chunk_size)

    def close(self) -> None:
        if self._pool:
            self._pool.shutdown()
            self._pool = None


def json_ready(df: DataFrame) -> DataFrame:
    """Columns in the types of JSON: times as ISO text, decimals and unknown kinds as text."""

    def one(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            frac = F.date_format(c, ".SSSSSS")
            return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.when(frac == ".000000", F.lit("")).otherwise(frac)).alias(f.name)
        if isinstance(f.dataType, (T.DecimalType, T.BinaryType)):
            return c.cast("string").alias(f.name)
        return c

    return df.select(*[one(f) for f in df.schema.fields])


def write_ndjson(df: DataFrame, path: str) -> None:
    """One object per line, in as many files as there are partitions; nulls are written."""
    json_ready(df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def json_lines(df: DataFrame) -> DataFrame:
    return json_ready(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def write_json_array(df: DataFrame, path: str) -> None:
    """One indented array in one UTF-8 file on any of Spark's file systems, streamed row by row through the driver."""

    def parts() -> Iterator[str]:
        first = True
        for r in json_lines(df).toLocalIterator():
            yield ("[\n  " if first else ",\n  ") + json.dumps(json.loads(r[0]), ensure_ascii=False, indent=2).replace("\n", "\n  ")
            first = False
        yield "[]" if first else "\n]"

    Files(df.sparkSession).write_lines(path, parts())


def write_json_object(spark: SparkSession, record: Mapping[str, Any], path: str) -> None:
    Files(spark).write_lines(path, iter([json.dumps(record, ensure_ascii=False, indent=2, default=str)]))


def write_result(spark: SparkSession, result: DataFrame | Mapping[str, Any] | Iterator[Row], path: str) -> None:
    """A row count as one object, a DataFrame as one array, anything else row by row as lines."""
    if isinstance(result, DataFrame):
        write_json_array(result, path)
    elif isinstance(result, Mapping):
        write_json_object(spark, result, path)
    else:
        lines = (json.dumps(r.asDict(True) if isinstance(r, Row) else dict(r), ensure_ascii=False, default=_plain) + "\n" for r in result)
        Files(spark).write_lines(path, lines)


def _plain(v: Any) -> str:
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else str(v)
