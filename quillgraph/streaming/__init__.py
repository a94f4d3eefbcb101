"""Incremental ingest: a folder as a stream, each file handled once by the checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("source", T.StringType()), T.StructField("text", T.StringType())])


def documents(spark: SparkSession, path: str, schema: T.StructType = DOCUMENTS) -> DataFrame:
    """Documents as they arrive as JSON lines."""
    return spark.readStream.schema(schema).json(path)


def run(stream: DataFrame, handle: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Handles all that has arrived since the last run and appends it to a parquet table. What is done is not redone: a batch
    writes to a folder of its own number, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        handle(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
