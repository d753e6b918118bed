"""Small files on whatever file system Spark uses."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Files:
    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def read(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        s = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(s)).decode()
        finally:
            s.close()

    def replace(self, path: str, text: str) -> None:
        """Write beside the target and rename over it."""
        fs, p = self._at(path)
        tmp = f"{path}.{uuid.uuid4().hex}.tmp"
        s = fs.create(self._jvm.org.apache.hadoop.fs.Path(tmp), True)
        try:
            s.write(bytearray(text.encode()))
        finally:
            s.close()
        self._rename(tmp, path)

    def _rename(self, tmp: str, path: str) -> None:
        fs, p = self._at(path)
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        ctx = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), self._conf)
        array = self._jvm.java.lang.reflect.Array.newInstance(options.OVERWRITE.getClass(), 1)
        array[0] = options.OVERWRITE
        ctx.rename(fs.makeQualified(self._jvm.org.apache.hadoop.fs.Path(tmp)), fs.makeQualified(p), array)

    def write_lines(self, path: str, parts: Iterator[str]) -> None:
        """Texts one after the other into one file, beside the target and then renamed over it."""
        fs, p = self._at(path)
        tmp = f"{path}.{uuid.uuid4().hex}.tmp"
        s = fs.create(self._jvm.org.apache.hadoop.fs.Path(tmp), True)
        try:
            for x in parts:
                s.write(bytearray(x.encode()))
        finally:
            s.close()
        self._rename(tmp, path)

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)


def whole_texts(spark: SparkSession, path: str, root: str = "") -> DataFrame:
    """``(source_path, text)``: one row per file below a path, the path made relative to ``root``."""
    t = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    p = F.regexp_replace(F.col("_metadata.file_path"), "^file:/*", "/")
    return t.select((F.replace(p, F.lit(root.rstrip("/") + "/"), F.lit("")) if root else p).alias("source_path"), F.col("value").alias("text"))
