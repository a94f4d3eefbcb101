"""Row numbers without a global window, and cutting the lineage of iterations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage: a reliable checkpoint where the session names a shared folder, else a cached table."""
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None) or df.sparkSession.sparkContext.getCheckpointDir()
    return df.checkpoint() if folder else df.cache()


def numbered(df: DataFrame, *order, name: str = "place") -> DataFrame:
    """Adds contiguous numbers from 1 in the given total order. Rows are range-partitioned and numbered within partitions; a
    partition starts after the rows of those before it. The partitioned rows are materialised, as both the numbers and the
    starts must see the same borders."""
    placed = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    placed = cut(placed.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*order))))
    before = placed.groupBy("_part").agg(F.count("*").alias("n"))  # a row per partition
    starts = before.select("_part", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")
