"""MinHash near-duplicates with b-bit signatures.

1. A text's set is that of its distinct 5-word shingles (64-bit hashes). Texts of equal sets form a class; its
   smallest doc_id stands for it from here on, so copies are never expanded into pairs.
2. Bands of MinHash minima give candidate buckets. The lowest bits of each minimum are kept and packed as bit planes.
3. In each bucket pairs are estimated by counting equal positions over the planes, corrected for the collisions of
   b bits. Only what connects is passed on (a forest, not the pairs), which gives clusters of likely texts.
4. In each cluster full sets are compared until nothing can be connected any more; again a forest is passed on.

Both connecting steps split groups of over BLOCK rows: blocks first connect their own rows; then the largest part
found and the rest are crossed block by block, as rows of one part needn't be compared again. So nothing is capped,
no task holds a whole group, and every pair that could connect different parts is compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import Bloom
from .bloom import _mask as in_filter
from .common import Scratch, Words, flat, mix, pieces, read, shingles, ship
from .graph import components

BANDS, ROWS, BITS = 28, 5, 4
HASHES = BANDS * ROWS
_LANES = (HASHES + 63) // 64
BLOCK = 512
_rs = np.random.RandomState(7)
_A = _rs.randint(1, 1 << 62, HASHES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_C = _rs.randint(1, 1 << 62, BANDS * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = mix(np.arange(1, BANDS + 1).astype(np.uint64))
#: Estimates this far below the wanted similarity are still compared: over 6 standard deviations of the estimate.
SLACK = 0.22


def distinct_shingles(texts: pa.Array, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and the bounds of each text's."""
    words = Words(*flat(texts))
    h, d = shingles(words, words.hashes(), k)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[new], d[new]
    return h, np.searchsorted(d, np.arange(len(texts) + 1))


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def signatures(h: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """For texts with shingles (others zeros): two keys of the whole set, the band keys and the packed low bits."""
    n = len(bounds) - 1
    full = np.flatnonzero(np.diff(bounds) > 0)
    out = {"k1": np.zeros(n, np.uint64), "k2": np.zeros(n, np.uint64), "bands": np.zeros((n, BANDS), np.uint64), "sig": np.zeros((n, BITS * _LANES), np.uint64)}
    if not len(full):
        return out
    at = bounds[:-1][full]
    out["k1"], out["k2"] = set_keys(h, bounds)
    minima = np.empty((len(full), HASHES), np.uint64)
    for j in range(HASHES):
        minima[:, j] = np.minimum.reduceat(h * _A[j], at)
    keyed = (minima * _C).reshape(len(full), BANDS, ROWS).sum(axis=2, dtype=np.uint64)
    out["bands"][full] = mix(keyed + _BAND)
    low = mix(minima)
    planes = np.zeros((len(full), BITS, _LANES * 64), np.uint8)
    for b in range(BITS):
        planes[:, b, :HASHES] = (low >> np.uint64(b)) & np.uint64(1)
    out["sig"][full] = np.packbits(planes, axis=2).view(np.uint64).reshape(len(full), BITS * _LANES)
    return out


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarity from packed bits: equal positions, less what b bits make equal by chance."""
    differ = (x ^ y).reshape(x.shape[:-1] + (BITS, _LANES))
    equal = 1 - np.bitwise_count(np.bitwise_or.reduce(differ, axis=-2)).sum(axis=-1) / HASHES
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


class Union:
    """Parts of the ids seen so far in a task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, a: int) -> int:
        up = self.up
        root = a
        while (nxt := up.get(root, root)) != root:
            root = nxt
        while (nxt := up.get(a, a)) != root:
            up[a], a = root, nxt
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def whole_groups(batches, key: str):
    """Arrow tables that hold whole groups, from a stream sorted by group."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(k != k[-1])[-1]) + 1 if (k != k[-1]).any() else 0
        t = pa.Table.from_batches([batch])
        if held and (cut or held[-1].column(key)[-1].as_py() != k[0]):
            yield pa.concat_tables([*held, t.slice(0, cut)]) if cut else pa.concat_tables(held)
            held = []
        elif cut:
            yield t.slice(0, cut)
        held.append(t.slice(cut))
    if held:
        yield pa.concat_tables(held)


def pairs_of(group: np.ndarray, side: np.ndarray):
    """Pairs of places (i, j) to compare in each group, in vectors of bounded length. A side of 0 compares with
    all of its group, sides 1 and 2 only with each other."""
    n = len(group)
    edges = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), n)
    sizes = np.diff(edges)
    small = np.repeat(sizes <= 24, sizes)
    at = np.arange(n)
    for d in range(1, int(sizes[sizes <= 24].max(initial=0))):
        i = at[: n - d][small[: n - d] & (group[: n - d] == group[d:])]
        j = i + d
        ok = (side[i] == 0) | (side[i] != side[j])
        if ok.any():
            yield i[ok], j[ok]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a > 24:
            for x in range(a, b, 64):
                i, j = np.meshgrid(np.arange(x, min(x + 64, b)), np.arange(a, b), indexing="ij")
                i, j = i.ravel(), j.ravel()
                ok = (i < j) & ((side[i] == 0) | (side[i] != side[j]))
                if ok.any():
                    yield i[ok], j[ok]


def connect(rows: DataFrame, scratch: Scratch, exact: int | None, cut: float) -> DataFrame:
    """rows: grp, id, sig (and items, the full set, where exact is the wanted similarity in percent).
    Returns id, label: parts connected by pairs of a group that are likely (or confirmed) similar."""
    with_items = exact is not None
    schema = "u long, v long"
    payload = ["sig", "items"] if with_items else ["sig"]

    def run(batches):
        parts = Union()
        for t in whole_groups(batches, "task"):
            ids = t.column("id").to_numpy()
            first = t.column("label").to_numpy()
            sig = t.column("sig").combine_chunks()
            sig = np.asarray(sig.flatten() if hasattr(sig, "flatten") else sig).view(np.uint64).reshape(len(ids), -1)
            items = t.column("items").combine_chunks() if with_items else None
            if with_items:
                flat_items = np.asarray(items.flatten()).view(np.uint64)
                bounds = np.append(0, np.cumsum(np.asarray(items.value_lengths())))
            us, vs = [], []
            for i, j in pairs_of(t.column("task").to_numpy(), t.column("side").to_numpy()):
                est = estimate(sig[i], sig[j])
                ok = (est >= cut) & (first[i] != first[j])
                i, j = i[ok], j[ok]
                if with_items:
                    order = np.argsort(-est[ok], kind="stable")
                    i, j = i[order], j[order]
                for x, y in zip(i.tolist(), j.tolist(), strict=True):
                    a, b = int(first[x]), int(first[y])
                    if parts.find(a) == parts.find(b):
                        continue
                    if with_items:
                        p, q = flat_items[bounds[x] : bounds[x + 1]], flat_items[bounds[y] : bounds[y + 1]]
                        if 100 * min(len(p), len(q)) < exact * max(len(p), len(q)):
                            continue
                        z = np.concatenate([p, q])
                        z.sort()
                        both = int((z[1:] == z[:-1]).sum())
                        if 100 * both < exact * (len(z) - both):
                            continue
                    parts.join(a, b)
                    us.append(a)
                    vs.append(b)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    def tasks(df: DataFrame) -> DataFrame:
        keyed = df.select("task", "id", "label", "side", *payload)
        return keyed.repartition("task").sortWithinPartitions("task").mapInArrow(run, schema)

    sizes = rows.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1")
    sizes = scratch.table(sizes)
    sized = rows.join(sizes, "grp").withColumn("block", F.expr(f"pmod(xxhash64(id, 11), ceil(n / {BLOCK}))"))
    one = sized.select(F.xxhash64("grp", "block").alias("task"), "id", F.col("id").alias("label"), F.lit(0).alias("side"), *payload)
    edges = scratch.table(tasks(one))
    labels = components(edges, scratch)
    large = scratch.table(sizes.where(f"n > {BLOCK}"))
    if large.isEmpty():
        return labels
    # Groups of several blocks: the largest part against the rest, and the rest against itself
    inside = rows.join(large, "grp").join(labels.withColumnRenamed("label", "l"), "id", "left").withColumn("label", F.coalesce("l", "id")).drop("l")
    inside = scratch.table(inside)
    counts = inside.groupBy("grp", "label").agg(F.count("*").alias("c"))
    bulk = counts.groupBy("grp").agg(F.max(F.struct("c", F.col("label").alias("bulk"))).alias("m"), F.sum("c").alias("n_all"))
    bulk = bulk.select("grp", F.col("m.bulk").alias("bulk"), F.expr(f"ceil(m.c / {BLOCK})").alias("nb"), F.expr(f"ceil((n_all - m.c) / {BLOCK})").alias("nm")).where("nm > 0")
    inside = inside.join(bulk, "grp").withColumn("minor", F.col("label") != F.col("bulk"))
    inside = inside.withColumn("own", F.expr("pmod(xxhash64(id, 13), if(minor, nm, nb))"))
    key = "xxhash64(grp, '{0}', {1}, {2})"
    with_bulk = F.expr(
        f"if(minor, transform(sequence(0L, nb - 1), i -> struct({key.format('b', 'i', 'own')} AS task, 1 AS side)), transform(sequence(0L, nm - 1), i -> struct({key.format('b', 'own', 'i')} AS task, 2 AS side)))"
    )
    among = F.expr(
        f"if(minor, transform(sequence(0L, nm - 1), i -> struct({key.format('m', 'least(own, i)', 'greatest(own, i)')} AS task, if(i = own, 0, if(own < i, 1, 2)) AS side)), array())"
    )
    crossed = inside.withColumn("t", F.explode(F.concat(with_bulk, among))).select("t.task", "id", "label", "t.side", *payload)
    more = scratch.table(tasks(crossed))
    stars = labels.select(F.col("id").alias("u"), F.col("label").alias("v"))
    return components(stars.unionByName(more), scratch)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, keys: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; with keys=True also k1 and k2, which tell its set.

    Two texts are linked if their sets' intersection is at least `percent` hundredths of their union, confirmed on
    the full sets; component_id is the smallest doc_id reachable by links. A pair at exactly 0.85 shares a band with
    probability 1 - 8e-8. Defined results: a null or empty text, or one without words, has no shingles, is linked with
    nothing and kept; a text of 1 to 4 words has its whole sequence as one shingle; a very long text is one set, in a block of
    its own; rows that share a doc_id are each judged by their own text; a row without doc_id is never linked, has no
    component_id and is kept; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def describe(batches):
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                h, bounds = distinct_shingles(batch.column(1).slice(a, b - a))
                s = signatures(h, bounds)
                width = lambda m: np.arange(len(m) + 1) * m.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.array(s["k1"].view(np.int64)),
                        pa.array(s["k2"].view(np.int64)),
                        _lists(s["bands"].ravel(), width(s["bands"])),
                        _lists(s["sig"].ravel(), width(s["sig"])),
                    ],
                    ["doc_id", "n_shingles", "k1", "k2", "bands", "sig"],
                )

    described = scratch.table(base.mapInArrow(describe, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, sig array<long>"))
    usable = described.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # A class's node is its smallest doc_id, or a hash of its set where that doc_id has rows of several sets
    classes = scratch.table(usable.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")))
    several = scratch.table(classes.groupBy("rep").agg(F.count("*").alias("sets")).where("sets > 1"))
    ids_are_reps = several.isEmpty()
    if ids_are_reps:
        classes = classes.withColumn("id", F.col("rep"))
    else:
        classes = scratch.table(classes.join(several, "rep", "left").withColumn("id", F.when(F.col("sets").isNull(), F.col("rep")).otherwise(F.xxhash64("k1", "k2"))).drop("sets"))
    own_class = classes.select("id", "rep", F.col("k1").alias("c1"), F.col("k2").alias("c2"))
    reps = usable.join(own_class, (F.col("doc_id") == F.col("rep")) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")))
    reps = scratch.table(reps.select("id", "rep", "k1", "k2", "bands", "sig").dropDuplicates(["id"]))
    buckets = reps.select("id", F.explode("bands").alias("grp"))
    shared = buckets.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1").select("grp")
    shared = buckets.join(shared, "grp", "left_semi")
    rows = scratch.table(shared.join(reps.select("id", "sig"), "id"))
    cut = percent / 100 - SLACK
    likely = connect(rows, scratch, None, cut)
    likely = scratch.table(likely)
    scratch.drop(rows)

    # Full sets of what is in a cluster: a Bloom filter of their ids spares a shuffle of all texts; the join below is exact
    clustered = scratch.table(likely.join(reps.drop("bands"), "id"))
    maybe, bits = (bloom := Bloom(clustered, "rep")).table, bloom.bits

    def item_sets(batches):
        for batch in batches:
            ids = batch.column(0)
            wanted = np.zeros(len(ids), bool)
            known = np.asarray(ids.is_valid())
            wanted[known] = in_filter(maybe.value, bits, ids.drop_null().to_numpy())
            batch = batch.filter(pa.array(wanted))
            for a, b in pieces(batch.column(1)):
                h, bounds = distinct_shingles(batch.column(1).slice(a, b - a))
                k1, k2 = set_keys(h, bounds)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), _lists(h, bounds)], ["rep", "k1", "k2", "items"])

    sets = base.mapInArrow(item_sets, "rep long, k1 long, k2 long, items array<long>")
    full = sets.join(clustered, ["rep", "k1", "k2"]).select(F.col("label").alias("grp"), "id", "sig", "items")
    linked = connect(scratch.table(full), scratch, percent, cut)
    if not ids_are_reps:  # labels are nodes: a component's id is its smallest doc_id
        smallest = linked.join(classes.select("id", "rep"), "id").groupBy("label").agg(F.min("rep").alias("least"))
        linked = linked.join(smallest, "label").select("id", F.col("least").alias("label"))
    members = described.select("doc_id", "n_shingles", "k1", "k2").join(classes, ["k1", "k2"], "left")
    # A row without doc_id stands in no class
    members = members.withColumn("id", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("id"))).withColumn("rep", F.when(F.col("id").isNotNull(), F.col("rep")))
    out = members.join(linked, "id", "left")
    component = F.coalesce("label", "rep", "doc_id")
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), *["k1", "k2"] * keys)
    return scratch.last(out)


def set_keys(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two keys of the whole set of each text, zeros without shingles."""
    k1, k2 = np.zeros(len(bounds) - 1, np.uint64), np.zeros(len(bounds) - 1, np.uint64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        at = bounds[:-1][full]
        k1[full] = np.add.reduceat(mix(h), at)
        k2[full] = np.add.reduceat(mix(h ^ np.uint64(0x5851F42D4C957F2D)), at)
    return k1, k2


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """docs without the rows that near_duplicates does not keep; of rows with one doc_id and one set the first in order of a hash of all
    columns stays.

    Rows that surely stay are told by a Bloom filter of all others, so that only texts of groups are shuffled for the exact
    decision. Defined results: rows without doc_id stay, and so do all rows without words; rows that share a doc_id but not their
    words are judged one by one; columns of any other name are carried along; an empty table gives no rows.
    """
    docs, names = docs.toDF(*(c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns))), docs.columns
    scratch = Scratch(docs.sparkSession)
    found = near_duplicates(docs, percent=percent, keys=True).where("doc_id IS NOT NULL")
    found = scratch.table(found.groupBy("doc_id", "k1", "k2").agg(F.count("*").alias("n"), F.max("kept").alias("kept"), F.max(F.col("n_shingles") == 0).alias("empty")))
    per_id = found.groupBy("doc_id").agg(F.sum("n").alias("rows"), F.min("kept").alias("kept"))
    # Single rows that go, and ids of several rows, which are told apart by their sets
    odd = scratch.table(per_id.where("rows > 1 OR NOT kept").select(F.col("doc_id").alias("odd_id"), "rows"))
    marked = docs.withColumn("maybe", Bloom(odd, "odd_id").column("doc_id"))
    rest = marked.where("maybe").drop("maybe")
    out = marked.where("NOT maybe").drop("maybe").unionByName(rest.join(odd.hint("merge"), F.col("doc_id") == F.col("odd_id"), "left_anti"))
    several = odd.where("rows > 1")
    if not several.isEmpty():

        @F.pandas_udf("k1 long, k2 long")
        def keys_of(texts: pd.Series) -> pd.DataFrame:
            strings = pa.array(texts, pa.string())
            made = [np.stack(set_keys(*distinct_shingles(strings.slice(a, b - a)))) for a, b in pieces(strings)]
            k1, k2 = np.concatenate(made, axis=1).view(np.int64) if made else np.zeros((2, 0), np.int64)
            return pd.DataFrame({"k1": k1, "k2": k2})

        mine = rest.join(several.hint("merge"), F.col("doc_id") == F.col("odd_id"), "left_semi").withColumn("keys", keys_of("text"))
        stays = found.where("kept").select(F.col("doc_id").alias("odd_id"), "k1", "k2", "empty").hint("merge")
        same = (F.col("doc_id") == F.col("odd_id")) & (F.col("keys.k1") == F.col("k1")) & (F.col("keys.k2") == F.col("k2"))
        mine = mine.join(stays, same).select("odd_id", "k1", "k2", "empty", F.struct(*docs.columns).alias("row"))
        one = mine.where("NOT empty").groupBy("odd_id", "k1", "k2").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
        out = out.unionByName(mine.where("empty").select("row.*")).unionByName(one.select("row.*"))
    return out.toDF(*names)


def op8_near_dup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE
w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT r, doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT r, doc_id, count(*) AS n FROM sh GROUP BY r, doc_id),
common AS (SELECT a.r AS ra, b.r AS rb, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.r <> b.r GROUP BY ra, rb),
links AS MATERIALIZED (SELECT DISTINCT x.doc_id AS u, y.doc_id AS v FROM common JOIN n x ON x.r = ra JOIN n y ON y.r = rb WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
least_of AS (SELECT u, min(v) AS m FROM reach GROUP BY u)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id, w.doc_id = least(w.doc_id, coalesce(m, w.doc_id)) AS kept
FROM w LEFT JOIN n ON n.r = w.r LEFT JOIN least_of ON least_of.u = w.doc_id
"""
