"""Similarity of vectors, search of all rows for stated queries, and reranking."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Query vectors that are sent to all tasks; more are searched in rounds of this many.
MAX_QUERIES = 4_096
#: Scores of a block that are in memory at a time: a block is scored against so many of the queries as come to that.
MAX_CELLS = 1 << 20


def dot(a: str, b: str) -> Column:
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> double(x) * double(y)), 0D, (s, x) -> s + x)")


def cosine(a: str, b: str) -> Column:
    """0 if either vector has no length."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, F.lit(0.0)).otherwise(dot(a, b) / norms)


STRATEGIES: dict[str, Callable[[str, str], Column]] = {"cosine": cosine, "dot_product": dot}


def strategy(name: str) -> Callable[[str, str], Column]:
    if name not in STRATEGIES:
        raise ValueError(f"unknown similarity: {name}")
    return STRATEGIES[name]


def pairwise(pairs: DataFrame, a: str, b: str, name: str = "cosine") -> DataFrame:
    return pairs.withColumn("score", strategy(name)(a, b))


def mean_vectors(vectors: DataFrame, group: str, vector: str) -> DataFrame:
    """The mean vector of each group, by components, so that no group is gathered in one row before it is summed."""
    parts = vectors.select(group, F.posexplode(vector).alias("i", "x")).groupBy(group, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return parts.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias(vector))


def _blocks(batches, ids: np.ndarray, q: np.ndarray, cos: bool, k: int | None):
    qn = np.sqrt((q * q).sum(axis=1))
    for batch in batches:
        column = batch.column(1)
        if not len(column):
            continue
        x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
        keys, xn = batch.column(0).to_numpy(), np.sqrt((x * x).sum(axis=1))[:, None]
        step = max(1, MAX_CELLS // len(keys))
        for first in range(0, len(ids), step):
            s = x @ q[first : first + step].T
            if cos:
                n = xn * qn[first : first + step]
                s = np.divide(s, n, out=np.zeros_like(s), where=n != 0)
            for j in range(s.shape[1]):
                at = np.arange(len(keys))
                if k is not None and len(keys) > k:
                    kth = np.partition(s[:, j], -k)[-k]
                    at = np.flatnonzero(s[:, j] >= kth - 1e-9)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), ids[first + j])), pa.array(keys[at]), pa.array(s[at, j])], ["query_id", "id", "score"])


def scores(queries: DataFrame, chunks: DataFrame, query_id: str, chunk_id: str, vector: str, name: str = "cosine", k: int | None = None) -> DataFrame:
    """Scores of the stated queries against all chunks, block by block; with k only rows that can be among a query's k best
    leave a block. Queries go to the tasks in rounds of at most MAX_QUERIES; chunks without a vector are skipped."""
    strategy(name)
    spark = chunks.sparkSession
    rows = chunks.where(F.col(vector).isNotNull()).select(F.col(chunk_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    asked = queries.select(F.col(query_id).cast("long").alias("q"), F.col(vector).cast("array<double>").alias("v")).orderBy("q")
    out, last = None, None
    while True:
        part = (asked if last is None else asked.where(F.col("q") > last)).limit(MAX_QUERIES).collect()
        if not part:
            break
        if len(part) == MAX_QUERIES:  # queries that share the last id stay in one round
            end = part[-1].q
            part = [r for r in part if r.q != end] + asked.where(F.col("q") == end).collect()
        ids, q = np.array([r.q for r in part]), np.array([r.v for r in part])
        found = rows.mapInArrow(lambda b, ids=ids, q=q: _blocks(b, ids, q, name == "cosine", k), "query_id long, id long, score double")
        out = found if out is None else out.unionByName(found)
        if len(part) < MAX_QUERIES:
            break
        last = int(ids[-1])
    return out if out is not None else spark.createDataFrame([], "query_id long, id long, score double")


def best(scored: DataFrame, k: int, score: str = "score", by: str = "query_id", tie: str = "id", digits: int | None = 6) -> DataFrame:
    """The k best of each query, ties to the smaller id. Scores are compared to so many digits."""
    s = F.round(score, digits) if digits is not None else F.col(score)
    order = Window.partitionBy(by).orderBy(s.desc(), F.col(tie))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def adjacent(chunks: DataFrame, key: str, order: str, vector: str) -> DataFrame:
    """Similarity of each element with the next one of its document."""
    w = Window.partitionBy(key).orderBy(order)
    return chunks.withColumn("_next", F.lead(vector).over(w)).withColumn("next_id", F.lead(order).over(w)).where("_next IS NOT NULL").withColumn("similarity", cosine(vector, "_next")).drop("_next")


def split_groups(chunks: DataFrame, key: str, order: str, vector: str, threshold: float) -> DataFrame:
    """Numbers the runs of elements between places where similarity to the one before falls under the threshold."""
    w = Window.partitionBy(key).orderBy(order)
    before = chunks.withColumn("_before", F.lag(vector).over(w)).withColumn("_s", cosine(vector, "_before"))
    cut = F.when(F.col("_s") < threshold, 1).otherwise(0)
    return before.withColumn("group_id", F.sum(cut).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_before", "_s")


def pick_k(top_k: int | None, rerank: bool, retrieve_k: int = 20, rerank_top_k: int = 5, default: int = 5) -> tuple[int, int]:
    """How many to retrieve and to return."""
    if top_k is not None:
        return top_k, top_k
    return (retrieve_k, rerank_top_k) if rerank else (default, default)


def rerank(found: DataFrame, rescored: Column, top_k: int) -> DataFrame:
    """Second stage: at most top_k of each query by the new score; a single result is left as it is."""
    alone = F.count("*").over(Window.partitionBy("query_id")) == 1
    scored = found.withColumn("rerank_score", F.when(alone, F.col("score")).otherwise(rescored))
    return best(scored.drop("rank"), top_k, "rerank_score")
