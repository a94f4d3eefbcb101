"""Approximate nearest neighbours by learned partitions.

On a sample the neighbour graph is cut into balanced parts, and a small network learns to tell from a vector
in which parts its neighbours lie. It places every vector of the table in one part (with an offset for each part that balances
the parts) and routes a query to its most probable parts, as many as a calibration against brute force shows to be needed. There
all vectors are compared. The number of parts grows with the square root of the number of vectors, and the sample with the parts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, merged, read, ship
from .near_dup import whole_groups

#: Rows of the index and queries that meet in one task at most (on average; chunks are made by hash).
CHUNK_ROWS, CHUNK_QUERIES = 20_000, 2_000


def cut_graph(neighbours: np.ndarray, x: np.ndarray, parts: int) -> np.ndarray:
    """Balanced parts of a neighbour graph by repeated halving. A half starts as one side of the median along the
    main direction; pairs of vertices are then exchanged while that lowers the number of edges cut."""
    n = len(x)
    label = np.zeros(n, np.int64)
    u = np.repeat(np.arange(n), neighbours.shape[1])
    v = neighbours.ravel()
    u, v = np.concatenate([u, v]), np.concatenate([v, u])
    made = 1
    while made < parts:
        for part in range(made):
            own = np.flatnonzero(label == part)
            if len(own) < 2:
                continue
            c = x[own] - x[own].mean(0)
            direction = np.linalg.eigh(c.T @ c)[1][:, -1]
            side = np.full(n, -1)
            side[own] = 0
            side[own[np.argsort(c @ direction, kind="stable")[len(own) // 2 :]]] = 1
            inside = (side[u] >= 0) & (side[v] >= 0)
            a, b = u[inside], v[inside]
            for _ in range(20):
                gain = np.bincount(a, weights=np.where(side[a] != side[b], 1.0, -1.0), minlength=n)
                left, right = own[side[own] == 0], own[side[own] == 1]
                left = left[np.argsort(-gain[left], kind="stable")]
                right = right[np.argsort(-gain[right], kind="stable")]
                k = min(len(left), len(right))
                good = int((gain[left[:k]] + gain[right[:k]] > 2).sum()) // 2  # half of them, as they change each other's gain
                if not good:
                    break
                side[left[:good]], side[right[:good]] = 1, 0
            label[own[side[own] == 1]] = part + made
        made *= 2
    return label


class Router:
    """One hidden layer and a softmax over parts; offset balances the parts that vectors are placed in."""

    def __init__(self, w1, b1, w2, b2):
        self.w1, self.b1, self.w2, self.b2 = w1, b1, w2, b2
        self.offset = np.zeros(len(b2))

    def part(self, x: np.ndarray) -> np.ndarray:
        return (self.logits(x) + self.offset).argmax(axis=1)

    def balance(self, x: np.ndarray, rounds: int = 200) -> None:
        """Offsets with which x falls in parts of about equal sizes: those of large parts are lowered, of small ones raised."""
        z, parts = self.logits(x), len(self.offset)
        best, worst = self.offset, np.inf
        for r in range(rounds):
            load = np.bincount((z + self.offset).argmax(axis=1), minlength=parts) * parts / max(1, len(x))
            if load.max() < worst:
                best, worst = self.offset, load.max()
            self.offset = self.offset - 0.5 * (1 - r / rounds) * np.log(np.maximum(load, 0.1))
        self.offset = best

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    @staticmethod
    def fit(x: np.ndarray, share: np.ndarray, hidden: int = 128, steps: int = 2_000) -> Router:
        rs = np.random.RandomState(3)
        epochs = max(5, steps * 256 // max(1, len(x)))
        d, p = x.shape[1], share.shape[1]
        params = [rs.randn(d, hidden) * np.sqrt(2 / d) * 3, np.zeros(hidden), rs.randn(hidden, p) * np.sqrt(1 / hidden), np.zeros(p)]
        m, s, t = [np.zeros_like(w) for w in params], [np.zeros_like(w) for w in params], 0
        for epoch in range(epochs):
            order = rs.permutation(len(x))
            for at in range(0, len(x), 256):
                i = order[at : at + 256]
                h = np.maximum(x[i] @ params[0] + params[1], 0)
                z = h @ params[2] + params[3]
                z -= z.max(1, keepdims=True)
                e = np.exp(z)
                g = (e / e.sum(1, keepdims=True) - share[i]) / len(i)
                gh = (g @ params[2].T) * (h > 0)
                grads = [x[i].T @ gh, gh.sum(0), h.T @ g, g.sum(0)]
                t += 1
                for k, gr in enumerate(grads):
                    gr = gr + 1e-4 * params[k]
                    m[k] = 0.9 * m[k] + 0.1 * gr
                    s[k] = 0.999 * s[k] + 0.001 * gr * gr
                    params[k] = params[k] - 0.003 * (1 - epoch / epochs) * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
        return Router(*params)


def learn(x: np.ndarray, parts: int, k: int = 10) -> Router:
    """x: unit vectors of the sample, two at least."""
    k = min(k, len(x) - 1)
    near = np.empty((len(x), k), np.int64)
    block = max(1, 4_000_000 // len(x))
    for at in range(0, len(x), block):
        s = x[at : at + block] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -9
        near[at : at + block] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    label = cut_graph(near, x, parts)
    share = np.zeros((len(x), parts))
    np.add.at(share, (np.repeat(np.arange(len(x)), k), label[near].ravel()), 1.0)
    share[np.arange(len(x)), label] += k / 2
    router = Router.fit(x, share / share.sum(1, keepdims=True))
    router.balance(x)
    return router


def parts_for(rows: int, max_parts: int) -> int:
    """The power of 2 below the square root of the number of vectors."""
    return int(min(max_parts, 2 ** max(0, int(np.log2(max(1.0, np.sqrt(rows)))))))


def matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return np.asarray(column.flatten(), np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def best(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int):
    """The k largest cosines of each query among x, its own id left out, ties to the smaller id. A matrix product
    finds who can be among them, their scores are then computed the same way for all."""
    norm = np.sqrt((x * x).sum(axis=1))
    qn = np.sqrt((q * q).sum(axis=1))
    out_q, out_i, out_s = [], [], []
    for at in range(0, len(q), 256):
        rough = (q[at : at + 256] @ x.T) / (qn[at : at + 256, None] * norm)
        rough[qids[at : at + 256, None] == ids] = -np.inf
        kth = np.partition(rough, -k, axis=1)[:, -k] if len(x) > k else np.full(len(rough), -9.0)
        rows, cols = np.nonzero((rough >= (kth - 1e-9)[:, None]) & np.isfinite(rough))
        score = np.empty(len(rows))
        for c in range(0, len(rows), 50_000):
            r, o = rows[c : c + 50_000] + at, cols[c : c + 50_000]
            score[c : c + 50_000] = (q[r] * x[o]).sum(axis=1) / (qn[r] * norm[o])
        order = np.lexsort((ids[cols], -score, rows))
        rows, cols, score = rows[order], cols[order], score[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = rank < k
        out_q.append(qids[rows[keep] + at])
        out_i.append(ids[cols[keep]])
        out_s.append(score[keep])
    return np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)


def top(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), F.first("part").alias("part"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    every: int = 50,
    max_parts: int = 1_024,
    sample_per_part: int = 64,
    calibration: int = 256,
    recall: float = 0.94,
    explain: dict | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by `every`.

    Every usable row is indexed. The number of parts is the power of 2 below sqrt(n), at most max_parts; the partition is
    learned on a hash sample of about sample_per_part rows a part (at most 65,536), by the same steps at every size. The number of
    parts to search is the smallest with which about `calibration` queries find `recall` of their true neighbours in the whole
    table. explain, if given, receives parts, routes and the sizes of the largest and mean part. Defined results:
    vectors that are null, zero, or hold null or non-finite components, or are not of the commonest length (the
    smallest such), take no part, as candidates or queries; neither do rows without id; rows that repeat an id count
    once, with the row whose values come first as query and the nearest as candidate; equal scores go by the smaller id; very
    long vectors are vectors like others; other columns are ignored; without usable rows the result is empty.
    """
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    ok = F.expr("v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull() & F.coalesce(ok, F.lit(False)))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    total = lengths[0]["count"]
    rows = rows.where(F.size("v") == lengths[0]["n"])
    parts = parts_for(total, max_parts)
    share = min(1.0, sample_per_part * parts / total)
    sampled = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 20)) < int((1 << 20) * share) + 1)
    x = unit(np.array([r.v for r in sampled.orderBy("vec_id").collect()]).reshape(-1, lengths[0]["n"]))  # about sample_per_part * parts rows
    x = np.unique(x, axis=0)
    # Fewer distinct vectors than two a part (copies) make fewer parts; a single part has nothing to route
    while parts > 1 and len(x) < 2 * parts:
        parts //= 2
    router = learn(x, parts) if parts > 1 else None

    def place(batches):
        for batch in batches:
            x = matrix(batch.column(1))
            part = router.part(unit(x)) if router and len(x) else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(part.astype(np.int32))], ["vec_id", "v", "part"])

    index = scratch.table(rows.mapInArrow(place, "vec_id long, v array<double>, part int"))
    queries = index.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    routes = 1
    if router:
        n_queries = max(1, total // every)
        chosen = queries.where(F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(1 << 20)) < int((1 << 20) * min(1, calibration / n_queries)) + 1).orderBy("vec_id").collect()
        cq, cv = np.array([r.vec_id for r in chosen], np.int64), np.array([r.v for r in chosen]).reshape(len(chosen), -1)

        def true_neighbours(batches):
            for batch in merged(batches):
                ids = batch.column(0).to_numpy()
                q, i, s = best(ids, matrix(batch.column(1)), cq, cv, k)
                order = np.argsort(ids, kind="stable")
                part = batch.column(2).to_numpy()[order[np.searchsorted(ids[order], i)]]
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(s), pa.array(part)], ["query_id", "vec_id", "score", "part"])

        if len(cq):
            truth = top(index.mapInArrow(true_neighbours, "query_id long, vec_id long, score double, part int"), k).select("query_id", "part").collect()
            ranked = np.argsort(np.argsort(-router.logits(unit(cv)), axis=1, kind="stable"), axis=1)
            at = {q: r for q, r in zip(cq.tolist(), ranked, strict=True)}
            needed = np.sort([at[r.query_id][r.part] for r in truth])
            routes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1 if len(needed) else 1

    size = np.zeros(parts, np.int64)
    for r in index.groupBy("part").count().collect():
        size[r.part] = r["count"]
    if explain is not None:
        explain.update(parts=parts, routes=routes, largest=int(size.max()), mean=total / parts)

    def route(batches):
        for batch in batches:
            x = matrix(batch.column(1))
            to = [[0]] * len(x)
            if router and len(x):
                order = np.argsort(-router.logits(unit(x)), axis=1, kind="stable")
                # As many parts as hold k other rows at least, where small ones come first
                enough = (np.cumsum(size[order], axis=1) <= k).sum(axis=1) + 1
                to = [o[: max(routes, n)].tolist() for o, n in zip(order, enough, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(to, pa.list_(pa.int32()))], ["vec_id", "v", "parts"])

    routed = scratch.table(queries.mapInArrow(route, "vec_id long, v array<double>, parts array<int>").select("vec_id", "v", F.explode("parts").alias("part")))
    n_rows = index.groupBy("part").agg(F.expr(f"ceil(count(*) / {CHUNK_ROWS})").alias("cr"))
    chunks = n_rows.join(routed.groupBy("part").agg(F.expr(f"ceil(count(*) / {CHUNK_QUERIES})").alias("cq")), "part")
    chunks = F.broadcast(scratch.table(chunks))  # a row per part
    seq = "transform(sequence(0L, {0} - 1), i -> xxhash64(part, {1}, {2}))"
    a = index.join(chunks, "part").withColumn("c", F.expr("pmod(xxhash64(vec_id, 3), cr)"))
    a = a.select(F.explode(F.expr(seq.format("cq", "c", "i"))).alias("task"), F.lit(False).alias("asks"), "vec_id", "v", "part")
    b = routed.join(chunks, "part").withColumn("c", F.expr("pmod(xxhash64(vec_id, 3), cq)"))
    b = b.select(F.explode(F.expr(seq.format("cr", "i", "c"))).alias("task"), F.lit(True).alias("asks"), "vec_id", "v", "part")

    def search(batches):
        for t in whole_groups(batches, "task"):
            task = t.column("task").to_numpy()
            asks, ids, part, v = t.column("asks").to_numpy(), t.column("vec_id").to_numpy(), t.column("part").to_numpy(), matrix(t.column("v"))
            edges = np.append(np.flatnonzero(np.append(True, task[1:] != task[:-1])), len(task))
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                own = asks[s:e]
                if own.all() or not own.any():
                    continue
                q, i, score = best(ids[s:e][~own], v[s:e][~own], ids[s:e][own], v[s:e][own], k)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(score), pa.array(np.full(len(q), part[s], np.int32))], ["query_id", "vec_id", "score", "part"])

    found = a.unionByName(b).repartition("task").sortWithinPartitions("task").mapInArrow(search, "query_id long, vec_id long, score double, part int")
    return top(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"))
