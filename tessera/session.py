"""Session helpers shared by operators, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    b = SparkSession.builder.master(f"local[{cores}]").config("spark.driver.memory", memory)
    b = b.config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the one the cluster names; on a single machine a local one where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if named is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
            named = tempfile.mkdtemp(prefix="tessera-checkpoint-", dir=os.environ.get("TMPDIR"))
        spark.sparkContext.setCheckpointDir(named)
        current = spark.sparkContext.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder, so that lost executors cost no rerun of it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a compressed table in the shared folder; later reads take only the columns they need."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def stored_parts(parts: Iterable[DataFrame]) -> DataFrame:
    """One table in the shared folder of at least one part, each a file that is written before the next part is asked for."""
    path = None
    for df in parts:
        path = path or f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
        df.coalesce(1).write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
