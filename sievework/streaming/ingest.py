"""Incremental ingest: new files of records are added once, by key. An extension; the batch flow has no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.paths import exists


def ingest(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, key: str = "image_id") -> StreamingQuery:
    """Reads what is new below ``source`` and appends rows whose key is new; the first of equal keys wins. A batch that is replayed adds nothing."""

    def add(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates([key])
        if exists(spark, target):
            fresh = fresh.join(spark.read.schema(schema).parquet(target).select(key), key, "left_anti")
        fresh.write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


