"""The driver's tables as inputs of the operators, and small derived inputs that queries and oracles share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.functions.rows import numbered
from quillgraph.operators import graph_build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def star(spark: SparkSession, sf_dir: str, small: bool = False) -> tuple[DataFrame, DataFrame]:
    names = ("region", "nation", "supplier") if small else ("region", "nation", "supplier", "customer", "part", "lineitem")
    tables = {n: table(spark, sf_dir, n) for n in names}
    return graph_build.star_nodes(tables, small), graph_build.star_edges(tables, small)


def cleaned(docs: DataFrame) -> DataFrame:
    """A derived copy, as a cleaning step leaves it: runs of white space are one space, texts under 200 characters are skipped,
    and one text (id -1) is not among the originals."""
    kept = docs.where(F.length("text") >= 200).select("doc_id", F.regexp_replace("text", "[\\x09-\\x0d\\x20]+", " ").alias("text"))
    return kept.unionByName(docs.sparkSession.createDataFrame([(-1, "extra")], "doc_id long, text string"))


def marked_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with entity and relation marks made from nations, suppliers and regions."""
    n, r, s = (table(spark, sf_dir, t) for t in ("nation", "region", "supplier"))
    nations = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("n_nationkey").cast("long").alias("chunk_seq"),
        F.format_string("In (N_%d - nation - %s) and (R_%d - region - %s)\nwe see [N_%d -> R_%d: in_region].", "n_nationkey", "n_name", "r_regionkey", "r_name", "n_nationkey", "r_regionkey").alias("text"),
    )
    suppliers = s.select(
        (F.col("s_suppkey") + 1000).alias("chunk_seq"),
        F.format_string("(S_%d - supplier - %s) sits in [S_%d -> N_%d: located_in]", "s_suppkey", "s_name", "s_suppkey", "s_nationkey").alias("text"),
    )
    return nations.unionByName(suppliers).withColumn("chunk_id", F.format_string("c%d", "chunk_seq"))


def answered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dataset, answers) of conversations: user turns as questions with a contiguous row index, assistant turns as answers
    of the question before them."""
    asked = conversations.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    dataset = numbered(asked, "conv_id", "turn").select("conv_id", "turn", "question", (F.col("place") - 1).alias("row_idx"))
    replies = conversations.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    answers = asked.join(replies, ["conv_id", "turn"]).select("question", F.when(F.col("turn") >= 4, F.lit("找到 1 个相关实体和 0 个文本块。请配置 LLM")).otherwise(F.col("answer")).alias("answer"), (F.col("conv_id") * 1000 + F.col("turn")).alias("line"))
    return dataset, answers
