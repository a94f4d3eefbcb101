"""Mixing sources to target weights by Pareto order sampling.

A source's wanted words (its target, rounded) are split in certain whole copies of every document, as many as
the source's size goes into them, and a rest, the share f of one more copy. For the rest, documents are ranked by U/(1-U) divided by their inclusion odds
f/(1-f) * (size / mean size) ** tilt, and taken in that order up to the words that are still wanted, so that
the sample has a fixed size in words. U comes from a digest of doc_id, so reruns agree.

Ranks are never computed by sorting a source: the n documents of a source fall into about sqrt(n) buckets by their
rank value, words are summed by bucket, and only the bucket in which a source's target is met is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import GAP, Scratch, read

#: Fixed value: a share is wanted in millionths of a hash of 13 hexadecimal digits.
HASH_RANGE = 16**13
#: Sources up to which their table of sums is broadcast (about 100 bytes a source); beyond it, it is joined by shuffle.
MAX_BROADCAST_SOURCES = 20_000


def n_words(text: str = "text"):
    return F.coalesce(F.expr(f"size(filter(split({text}, r'{GAP}'), w -> w <> ''))"), F.lit(0)).cast("long")


def ranked(sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds place: 1, 2, ... in order of source, null last. Sources are range-partitioned and numbered within partitions; a
    partition starts after the rows of those before it."""
    first = F.col("source").asc_nulls_last()
    placed = sizes.repartitionByRange(first).withColumn("part", F.spark_partition_id())
    placed = scratch.table(placed.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy(first))))
    starts = placed.groupBy("part").agg(F.count("*").alias("n"))  # a row per partition
    starts = starts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "part").withColumn("place", F.col("start") + F.col("at")).drop("part", "at", "start")


def targets(sizes: DataFrame, scratch: Scratch, weights=(1, 2, 3), max_copies: int = 3) -> DataFrame:
    """sizes: a row per source (source, source_size, ...). Adds target: all words shared by the repeating
    weights in order of source (null last); a target stops at max_copies times the source's size and the
    excess is shared again by weight, until none is above. A round is an aggregation of the sources; what is stopped
    stays so, and sums are of whole numbers, so rounds are few and their result is exact."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = scratch.table(ranked(sizes, scratch).withColumn("w", w).withColumn("top", F.col("source_size") * float(max_copies)).drop("place"))
    level, stopped = 0.0, -1
    while True:
        # Sources at or below the level are stopped: their key, the level at which they stop, is top / w
        off = F.col("top") / F.col("w") <= level if stopped >= 0 else F.lit(False)
        r = rows.agg(F.sum("source_size"), F.sum(F.when(off, F.col("top"))), F.sum(F.when(~off, F.col("w"))), F.coalesce(F.sum(off.cast("long")), F.lit(0))).first()
        if r[3] == stopped or not r[2]:
            break
        level, stopped = (r[0] - (r[1] or 0.0)) / r[2], r[3]
    return rows.withColumn("target", F.least("top", F.lit(level) * F.col("w")) if r[2] else F.col("top")).drop("top", "w")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=(1, 2, 3),
    max_copies: int = 3,
    tilt: float = 0.25,
    seed: int = 1,
    cut_last: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Returns doc_id, size, source_size, target, taken (words taken, repeats counted), whole_copies, share
    (words taken of one more copy) and the columns in `keep` (named other than these).

    The document at which a source meets its target gives only the words that are still wanted, so a source's
    taken words are its target to a word; with cut_last=False it is taken whole if more than half of it is
    wanted, else not. Defined results: a null or empty text has size 0 and is never taken; a null source is a
    source of its own, last in order; a very long text is one document like others; rows that repeat are separate documents, ties are broken by doc_id and
    then by the digest of the text; if no text has a word all targets are 0; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") + 0.5) / HASH_RANGE
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"), u.alias("u"), F.xxhash64(text_col).alias("h"), *[c for c in keep if c != "source"])
    base = scratch.table(base)
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    stats = targets(sizes, scratch, weights, max_copies)
    # Words wanted, rounded: so many whole copies, and the rest, which is less than one
    wanted = F.round(F.col("target")).cast("long")
    stats = stats.withColumn("whole_copies", F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0).cast("long")))
    stats = stats.withColumn("rest", wanted - F.col("whole_copies") * F.col("source_size"))
    stats = stats.withColumn("f", F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(F.lit(0.0)))
    stats = scratch.table(stats.withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.sqrt("n_docs")))))
    small = stats.count() <= MAX_BROADCAST_SOURCES

    def with_stats(df: DataFrame, columns: list[str], salts: int = 64) -> DataFrame:
        own = stats.select(F.col("source").alias("source_"), *columns)
        if small:
            return df.join(F.broadcast(own), F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
        own = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        df = df.withColumn("salt", F.pmod(F.col("h"), F.lit(salts)).cast("int"))
        return df.join(own, (df["salt"] == own["salt"]) & F.col("source").eqNullSafe(F.col("source_"))).drop("salt", "source_")

    rows = with_stats(base, ["source_size", "n_docs", "target", "whole_copies", "rest", "f", "buckets"])
    x = F.col("size") * F.col("n_docs") / F.col("source_size")
    odds = F.col("f") / (1 - F.col("f")) * F.pow(x, F.lit(float(tilt)))
    q = F.when((F.col("size") > 0) & (F.col("rest") > 0), F.col("u") / (1 - F.col("u")) / odds)
    rows = rows.withColumn("q", q).withColumn("bucket", F.when(F.col("q").isNotNull(), F.least((F.col("q") / (1 + F.col("q")) * F.col("buckets")).cast("long"), F.col("buckets") - 1)))
    # Words by bucket, and the bucket in which the target is met (sqrt(n) rows for n documents)
    sums = rows.where("q IS NOT NULL").groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    met = sums.withColumn("until", F.sum("words").over(run)).where("until - words < rest AND until >= rest")
    met = met.groupBy("source").agg(F.min("bucket").alias("met"), F.min(F.expr("until - words")).alias("before_met"))
    met = met.select(F.col("source").alias("source_m"), "met", "before_met")
    if small:
        met = F.broadcast(met)
    rows = rows.join(met, F.col("source").eqNullSafe(F.col("source_m")), "left").drop("source_m")
    edge = (F.col("bucket") == F.col("met")).eqNullSafe(True)
    # Within that bucket alone the order is laid out
    order = Window.partitionBy("source", "bucket").orderBy("q", F.col("doc_id").asc_nulls_first(), "h", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.where(edge).withColumn("ahead", F.col("before_met") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    inside = inside.withColumn("share", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("ahead"))))
    if not cut_last:
        inside = inside.withColumn("share", F.when(F.col("share") * 2 > F.col("size"), F.col("size")).otherwise(F.lit(0).cast("long")))
    outside = rows.where(~edge).withColumn("share", F.when(F.col("bucket") < F.coalesce("met", F.col("buckets")), F.col("size")).otherwise(F.lit(0).cast("long")))
    both = inside.drop("ahead").unionByName(outside)
    return both.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("whole_copies") + F.col("share")).alias("taken"),
        "whole_copies",
        "share",
        *keep,
    )


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))


#: Stated by itself: the level of words a weight is that of the first source which stays below its top when all of lower tops a
#: weight have stopped; words wanted are laid out copy after copy.
OP2_SQL = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
w AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w, sum(size) * 3.0::DOUBLE AS top
  FROM base GROUP BY source),
t AS (
  SELECT arg_min(level, key) AS level FROM (
    SELECT a.source, ((SELECT sum(source_size) FROM w) - coalesce(sum(b.top) FILTER (WHERE b.top / b.w < a.top / a.w), 0.0)) / sum(b.w) FILTER (WHERE b.top / b.w >= a.top / a.w) AS level, any_value(a.top / a.w) AS key
    FROM w a JOIN w b ON true GROUP BY a.source) WHERE level < key),
tg AS (SELECT w.*, least(top, coalesce(t.level, 1e300) * w.w) AS target, round(least(top, coalesce(t.level, 1e300) * w.w))::BIGINT AS wanted FROM w, t),
st AS (SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END::BIGINT AS whole_copies, CASE WHEN source_size > 0 THEN wanted % source_size ELSE 0 END::BIGINT AS rest FROM tg),
q AS (
  SELECT b.doc_id, b.size, b.source, s.source_size, s.target, s.whole_copies, s.rest,
    CASE WHEN size > 0 AND rest > 0 THEN u / (1 - u) / (rest / source_size::DOUBLE / (1 - rest / source_size::DOUBLE) * pow(size * n_docs / source_size::DOUBLE, 0.25)) END AS q
  FROM base b JOIN st s ON b.source IS NOT DISTINCT FROM s.source),
r AS (SELECT *, coalesce(sum(size) FILTER (WHERE q IS NOT NULL) OVER (PARTITION BY source ORDER BY q NULLS LAST, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM q)
SELECT doc_id, size, source_size, target, (size * whole_copies + share)::BIGINT AS taken, whole_copies, share
FROM (SELECT *, CASE WHEN q IS NULL THEN 0 ELSE greatest(0, least(size, rest - ahead)) END::BIGINT AS share FROM r)
"""
