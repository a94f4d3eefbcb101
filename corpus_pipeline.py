"""A corpus pipeline: toxicity, quality rules, near-duplicates, mixing to target weights, token ids.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of documents; the last
returns the encoded documents. run() writes each stage's result to the shared folder and rereads it.

All stages but the last carry columns of any other name along. Null and empty texts, rows without doc_id, very long texts, repeated
rows and empty tables have the results that each stage states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm import bpe, mixing, near_dup, quality_rules, toxicity
from quillgraph.llm.common import Scratch, read


def _unclashed(docs: DataFrame) -> DataFrame:
    """docs with names for all but doc_id, text and source that no operator uses."""
    return docs.toDF(*(c if c in ("doc_id", "text", "source") else f"c{i}_" for i, c in enumerate(docs.columns)))


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5. The model learns from labelled documents of this stage's input.

    A null or empty text scores as one without any learned feature; rows without doc_id are scored and never learned from; rows that
    repeat score alike; a score of 0.5 is rejected; without labels of both kinds all get one score, the share of toxic labels (0.05 without any).
    """
    labels, own = read(spark, sf_dir, "labels"), _unclashed(docs)
    model = toxicity.train(own.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels.select("doc_id", "toxic"))
    return toxicity.score(own, model, carry=True).where("score < 0.5").drop("score").toDF(*docs.columns)


def drop_low_quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base and the suffix-array rules keep.

    A null or empty text has no words and goes; rows without doc_id and rows that repeat are judged by their text alone; a text at a limit stays.
    """
    return quality_rules.apply_rules(_unclashed(docs), carry=True).where("kept").drop("kept").toDF(*docs.columns)


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 0.80 or more: that of the smallest doc_id, and one row of it.

    Rows without doc_id or without words stay; of rows with one doc_id those are dropped that are linked to a smaller one or repeat the words
    of another (the first in order of a hash of all columns stays).
    """
    return near_dup.keep_one(docs, percent=80)


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix takes them.

    A null source is one of its own, last in order; a null or empty text is never taken; rows without doc_id and rows that repeat are
    documents of their own, ties go by doc_id and then by the text's digest.
    """
    own = _unclashed(docs)
    rest = tuple(c for c in own.columns if c != "doc_id")
    mixed = mixing.mix(own, cut_last=False, keep=rest)
    copies = (F.col("whole_copies") + (F.col("share") > 0).cast("long")).cast("int")
    taken = mixed.where(F.col("size") > 0).where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    return taken.select(*own.columns).toDF(*docs.columns)


def encode(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A null or empty text has no tokens; rows that repeat are each encoded; other columns are left out.
    """
    return bpe.encode(docs, bpe.production_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("near_dup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Training and Pareto sampling of what training leaves cannot be stated in SQL; tests check run() against the plain stages.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """The stages in their order over all documents. What a stage has written for itself is removed when its result is written."""
    docs = read(spark, sf_dir, "documents")
    scratch = Scratch(spark)
    for _, stage in STAGES:
        opened, before = len(Scratch.live), docs
        docs = scratch.table(stage(spark, before, sf_dir))
        Scratch.release(opened)
        if hasattr(before, "quill_path"):
            scratch.drop(before)
    return docs
