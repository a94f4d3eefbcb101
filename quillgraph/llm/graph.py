"""Connected components of an edge table, by hooking to the smallest neighbour and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges: u, v (longs). Returns id, label for every end of an edge; label is the smallest id reachable.

    In each round a vertex points to its smallest neighbour if that is smaller, pointers are followed twice, and the
    edges are rewritten between what is pointed to. Pointers go to smaller ids only, so roots are minima. Rounds
    needed grow with the logarithm of the longest chain. All tables go through the shared folder.
    """
    e = scratch.table(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u < v").distinct())
    spark = edges.sparkSession
    total = None
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = scratch.table(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("m")))
        jump = m
        for _ in range(2):
            jump = jump.join(m.select(F.col("id").alias("m"), F.col("m").alias("m2")), "m").select("id", F.col("m2").alias("m"))
        jump = scratch.table(jump)
        e2 = e.join(jump.select(F.col("id").alias("u"), F.col("m").alias("mu")), "u").join(jump.select(F.col("id").alias("v"), F.col("m").alias("mv")), "v")
        e2 = scratch.table(e2.select(F.least("mu", "mv").alias("u"), F.greatest("mu", "mv").alias("v")).where("u < v").distinct())
        if total is None:
            total2 = jump.select("id", F.col("m").alias("label"))
        else:
            total2 = total.join(jump.select(F.col("id").alias("label"), "m"), "label", "left").select("id", F.coalesce("m", "label").alias("label"))
        total2 = scratch.table(total2)
        scratch.drop(e, m, *([total] if total is not None else []))
        e, total = e2, total2
    return total if total is not None else spark.createDataFrame([], "id long, label long")
