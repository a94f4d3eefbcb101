"""Command line: preprocess, dataset, compare, rag-build, rag-query, batch."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quillgraph import settings, sources
from quillgraph.engine import Engine
from quillgraph.operators import files, noise, preprocess, quality


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quillgraph")
    p.add_argument("--config")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("preprocess", "dataset"):
        c = sub.add_parser(name)
        c.add_argument("--input", required=True)
        c.add_argument("--output", required=True)
        c.add_argument("--files", help="ranges such as 1-5,8")
        c.add_argument("--dry-run", action="store_true")
        if name == "dataset":
            c.add_argument("--per-file", help="folder for the questions of each file")
    c = sub.add_parser("compare")
    c.add_argument("--original", required=True)
    c.add_argument("--compressed", required=True)
    c.add_argument("--output", required=True)
    c = sub.add_parser("rag-build")
    c.add_argument("--input", help="folder of documents; without it two demo texts")
    c.add_argument("--state", required=True)
    c.add_argument("--gexf")
    c = sub.add_parser("rag-query")
    c.add_argument("--state", required=True)
    c.add_argument("-q", "--question", required=True)
    c.add_argument("--top-k", type=int)
    c = sub.add_parser("batch")
    c.add_argument("--state", required=True)
    c.add_argument("--dataset", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--offset", type=int, default=0)
    c.add_argument("--limit", type=int)
    c.add_argument("--cot", action="store_true", default=None)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("quillgraph").getOrCreate()
    config = settings.load(args.config) if args.config else settings.Settings()
    if args.command in ("preprocess", "dataset"):
        docs = sources.read_markdown(spark, args.input).select(F.col("id").alias("file"), "text")
        if args.files:
            docs = files.select_range(docs, args.files).drop("place")
        k = config.preprocessing
        if args.dry_run:
            out = preprocess.questions_dry_run(docs, k.dataset_questions_per_chunk, k.compress_max_chunk_tokens) if args.command == "dataset" else noise.dry_run(docs)
            out.write.mode("overwrite").json(args.output)
        elif args.command == "dataset":
            questions, _, summary = preprocess.questions_batch(docs, max_tokens=k.compress_max_chunk_tokens)
            sources.write_questions(questions, args.output, args.per_file)
            print(summary.first().asDict())
        else:
            scored = quality.filter_reasons(quality.score(quality.metrics(docs)), min_chars=k.min_chars, min_quality_score=k.min_quality_score, min_chinese_ratio=k.min_chinese_ratio)
            passed = docs if k.quality_mode == "stats" else quality.split(scored)[0].select("file", "text")
            done = sources.read_progress(spark, f"{args.output}/state", preprocess.PROGRESS)
            states, summary = preprocess.compress_batch(passed, done, max_tokens=k.compress_max_chunk_tokens)
            sources.write_markdown(states.where("status = 'completed'"), f"{args.output}/texts", "file", "output")
            states.drop("output").write.mode("append").json(f"{args.output}/state")
            print(summary.first().asDict())
        return
    if args.command == "compare":
        sides = [sources.read_markdown(spark, p) for p in (args.original, args.compressed)]
        compared = noise.compare(*sides, key="id")
        sources.write_compare_report(compared, noise.compare_summary(compared), noise.missing(*sides, key="id"), args.output)
        return
    engine = Engine(spark, config)
    if args.command == "rag-build":
        engine.load_documents(sources.read_directory(spark, args.input) if args.input else sources.demo_documents(spark))
        engine.chunk_documents()
        engine.build_graph()
        engine.save(args.state)
        if args.gexf:
            engine.export_graph(args.gexf)
        print(engine.get_statistics())
        return
    engine.load(args.state)
    if args.command == "rag-query":
        print(engine.query(args.question, args.top_k))
        return
    from quillgraph.functions.rows import numbered

    # Rows as they stand in the file
    lines = sources.read_jsonl(spark, args.dataset).select("*", F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("line"))
    asked = numbered(lines, "file", "block", "line").withColumn("row_idx", F.col("place") - 1)
    prior = asked.select("question", "answer", F.col("row_idx").alias("line"))
    spark.createDataFrame([], "row_idx long, question string, answer string, failed boolean").write.mode("overwrite").json(args.output)
    print(engine.run_batch(asked.select("row_idx", "question"), lambda step: step.write.mode("append").json(args.output), prior, args.offset, args.limit, args.cot))


if __name__ == "__main__":
    main()
