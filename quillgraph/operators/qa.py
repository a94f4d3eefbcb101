"""Questions and answers: terms, contexts, fallbacks, datasets and batch runs."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.text import SPACE, strip

# Words that are no query terms, and the reply that stands in where no model is set up.
STOP_WORDS = (
    "the", "a", "an", "is", "are", "was", "were", "what", "who", "where", "when", "why", "how", "does", "do", "did", "can", "could",
    "will", "would", "should", "has", "have", "had", "this", "that", "these", "those", "of", "in", "on", "at", "to", "for", "with",
    "by", "about", "as", "into", "through", "during", "before", "after", "above", "below", "between", "and", "or", "but", "not",
    "no", "be", "been", "being",
)
FOUND, ENTITIES, SETUP = "找到 {} 个相关实体和 {} 个文本块。", "实体: {}。", "请配置 LLM 提供者以生成完整答案。"
NOT_FOUND = "未找到相关上下文。请提供文档或配置 LLM 提供者。"
MAX_EDGES, MAX_MEMBERS, MAX_NAMED = 30, 10, 5


def query_terms(question: str = "text") -> Column:
    """Lower-case words of over two characters that are no stop words, in order, repeats kept."""
    words = F.split(strip(F.regexp_replace(F.lower(F.coalesce(F.col(question), F.lit(""))), r"(?U)[^\w\s]", " ")), f"[{SPACE}]+")
    return F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(*STOP_WORDS))


def _section(title: str, lines: Column) -> Column:
    return F.when(F.size(lines) > 0, F.concat(F.array(F.lit(title)), lines, F.array(F.lit(""))))


def context_string(chunks: Column, entities: Column, edges: Column, paths: Column, communities: Column) -> Column:
    """Chunks (struct chunk_id, text), entities, edges (struct source, target, relation), paths and communities (arrays of
    arrays) as one text; empty parts are left out, edges and members are cut to their limits."""
    none = F.array().cast("array<string>")
    parts = [
        _section("=== Text Chunks ===", F.transform(chunks, lambda c: F.concat(F.lit("["), c["chunk_id"], F.lit("]: "), c["text"]))),
        _section("=== Knowledge Graph Entities ===", F.transform(entities, lambda e: F.concat(F.lit("- "), e))),
        _section("=== Entity Relations ===", F.transform(F.slice(edges, 1, MAX_EDGES), lambda e: F.concat(F.lit("- "), e["source"], F.lit(" --["), e["relation"], F.lit("]--> "), e["target"]))),
        _section("=== Entity Paths ===", F.transform(paths, lambda p: F.array_join(p, " -> "))),
        _section("=== Communities ===", F.transform(communities, lambda c, i: F.concat(F.lit("Community "), i.cast("string"), F.lit(": "), F.array_join(F.slice(c, 1, MAX_MEMBERS), ", ")))),
    ]
    return F.array_join(F.concat(*[F.coalesce(p, none) for p in parts]), "\n")


def fallback_answer(entities: Column, n_chunks: Column) -> Column:
    """What is said where no model answers."""
    before, between, after = FOUND.split("{}")
    found = F.concat(F.lit(before), F.size(entities).cast("string"), F.lit(between), n_chunks.cast("string"), F.lit(after), F.lit(ENTITIES.split("{}")[0]), F.array_join(F.slice(entities, 1, MAX_NAMED), ", "), F.lit(ENTITIES.split("{}")[1] + SETUP))
    return F.when(F.size(entities) > 0, found).otherwise(F.lit(NOT_FOUND))


def is_fallback(answer: Column) -> Column:
    return answer.startswith(FOUND.split(" ")[0]) & F.contains(answer, F.lit("请配置 LLM"))


def parse_questions(reply: str | None) -> list[str]:
    """Questions of a model's reply: a JSON list, with or without fences or text around it; only texts count."""
    if not reply:
        return []
    body = re.sub(r"\n?```\s*$", "", re.sub(r"^```[a-zA-Z]*\s*\n?", "", reply.strip())).strip()
    for candidate in (body, (re.search(r"\[[\s\S]*\]", body) or [None])[0]):
        try:
            found = json.loads(candidate) if candidate else None
        except ValueError:
            continue
        if isinstance(found, list):
            return [q.strip() for q in found if isinstance(q, str) and q.strip()]
    return []


def dedupe_questions(questions: DataFrame, key: str, order: str, question: str) -> DataFrame:
    """The first of equal (stripped) questions of each file, in its place; blank ones go. A minimum per question, so
    a file with very many questions is not gathered."""
    q = questions.withColumn("question", strip(F.coalesce(F.col(question), F.lit("")))).where("question <> ''")
    return q.groupBy(key, "question").agg(F.min(order).alias(order))


def merge_dataset(parts: DataFrame, key: str, order: str) -> DataFrame:
    """All files' questions in order of file and place; equal questions of different files both stay."""
    return parts.orderBy(key, order)


def resume(dataset: DataFrame, answers: DataFrame) -> DataFrame:
    """Prior answers by question text (the later line wins, empty and fallback answers don't count) joined to the rows of
    the dataset; answer is empty where there is none."""
    good = answers.where(F.col("answer").isNotNull() & (F.col("answer") != "") & ~is_fallback(F.col("answer")))
    last = good.groupBy("question").agg(F.max_by("answer", "line").alias("prior"))
    return dataset.join(last, "question", "left").withColumn("answer", F.coalesce("prior", F.lit(""))).drop("prior")


def worklist(rows: DataFrame, offset: int = 0, limit: int | None = None, index: str = "row_idx") -> DataFrame:
    """Rows from the offset on, at most limit of them, and of those the ones without an answer. The index is contiguous."""
    chosen = rows.where(F.col(index) >= offset)
    if limit is not None:
        chosen = chosen.where(F.col(index) < offset + limit)
    return chosen.where(F.coalesce(F.col("answer"), F.lit("")) == "")


def failure_runs(results: DataFrame, key: str, order: str, failed: str) -> DataFrame:
    """Runs of consecutive failures: their key, number, first place and length."""
    w = Window.partitionBy(key).orderBy(order)
    marked = results.withColumn("_good", F.sum(F.when(F.col(failed), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.where(F.col(failed)).groupBy(key, F.col("_good").alias("run")).agg(F.min(order).alias("first"), F.count("*").alias("length"))


def run_summary(states: DataFrame) -> DataFrame:
    """Totals of a batch run from its state table (status, input_tokens, output_tokens)."""
    n = lambda s: F.sum(F.when(F.col("status") == s, 1).otherwise(0)).alias(s)
    return states.agg(F.count("*").alias("total_files"), n("completed"), n("resumed"), n("failed"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"))
