"""Files that keep arriving, upserted into a collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.collections import CollectionStore


def read_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def upsert_stream(stream: DataFrame, store: CollectionStore, collection: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, in batches, and stop. A repeated batch after a failure upserts the same rows again."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, _: store.upsert(collection, df)).start()
