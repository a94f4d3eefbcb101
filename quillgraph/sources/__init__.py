"""Sources and sinks: text, Markdown and JSONL files, documents in unknown encodings, state tables, graph exchange."""

from __future__ import annotations

import re
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Encodings tried in order; the last accepts any bytes.
ENCODINGS = ("utf-8", "gbk", "gb18030", "latin-1")
#: Formats of raw documents.
FORMATS = ("pdf", "docx", "pptx", "html", "htm")
QUESTION_SCHEMA = T.StructType([T.StructField("question", T.StringType()), T.StructField("source", T.StringType()), T.StructField("answer", T.StringType())])


def decode(content: bytes | None) -> str:
    for name in ENCODINGS:
        try:
            return (content or b"").decode(name)
        except UnicodeDecodeError:
            continue
    return ""


@F.pandas_udf(T.StringType())
def _decode(content: pd.Series) -> pd.Series:
    return content.map(decode)


def decoded(files: DataFrame) -> DataFrame:
    """Adds text. Valid UTF-8 is decoded in the engine; only other files go through Python."""
    valid = F.expr("is_valid_utf8(content)")
    good = files.where(valid).withColumn("text", F.decode("content", "UTF-8"))
    return good.unionByName(files.where(~valid).withColumn("text", _decode("content")))


def _binary(spark: SparkSession, path: str, pattern: str | None, recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "content").withColumn("file", F.element_at(F.split("path", "/"), -1))


def read_text(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """One text file as a document; its key is the source given or the path."""
    df = spark.read.text(path, wholetext=True).withColumnRenamed("value", "text")
    return df.withColumn("source", F.lit(source or path))


def read_directory(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """source (the file's stem) and text of all files of a folder, or of those of a pattern; of equal stems the last name counts."""
    df = decoded(_binary(spark, path, pattern, False)).withColumn("source", F.regexp_replace("file", r"\.[^.]*$", ""))
    return df.groupBy("source").agg(F.max_by("text", "file").alias("text"))


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """id (every .md is taken out of the name), text and size of the Markdown files of a folder."""
    df = decoded(_binary(spark, path, "*.md", False))
    return df.select(F.replace("file", F.lit(".md"), F.lit("")).alias("id"), "text", F.col("length").alias("size_bytes"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = QUESTION_SCHEMA) -> DataFrame:
    """JSON lines by a schema; blank lines are skipped, absent keys null."""
    return spark.read.schema(schema).json(path)


def find_documents(spark: SparkSession, path: str, formats: tuple[str, ...] = FORMATS) -> DataFrame:
    """Raw documents below a folder, by extension."""
    ending = F.lower(F.regexp_extract("file", r"\.([^.]*)$", 1))
    return _binary(spark, path, None, True).where(ending.isin(*formats)).withColumn("format", ending)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Chunks as JSON lines in a folder for each source; slashes in names become underscores."""
    chunks.withColumn("source_key", F.regexp_replace("source", r"[/\\]", "_")).write.mode("overwrite").partitionBy("source_key").json(path)


def write_report(df: DataFrame, path: str, key: str = "id", text: str = "text") -> None:
    """Documents as JSON lines of id, text and metadata (all other columns)."""
    rest = [c for c in df.columns if c not in (key, text)]
    df.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text"), F.struct(*rest).alias("metadata")).write.mode("overwrite").json(path)


def write_markdown(docs: DataFrame, path: str, key: str = "id", text: str = "text") -> None:
    """A Markdown file for each document, written by the tasks to a folder that all machines share."""

    def write(rows):
        import os

        os.makedirs(path, exist_ok=True)
        for r in rows:
            with open(os.path.join(path, re.sub(r"[/\\]", "_", str(r[0])) + ".md"), "w", encoding="utf-8") as f:
                f.write(r[1] or "")

    docs.select(key, text).foreachPartition(write)


def write_exclusions(judged: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Excluded documents, with their reason among the metadata."""
    write_report(judged.where("filter_reason IS NOT NULL"), path, key, text)


def write_filter_log(judged: DataFrame, path: str, key: str = "doc_id") -> None:
    """The filter log of any corpus as text files in order: totals, what passed by falling score, what was excluded by name."""
    ok = F.col("filter_reason").isNull()
    line = F.when(ok, F.format_string("PASSED %.4f  %s", "quality_score", F.col(key).cast("string"))).otherwise(F.concat_ws("  ", F.concat(F.lit("EXCLUDED "), F.col(key).cast("string")), F.col("filter_reason")))
    rows = judged.select(F.when(ok, 1).otherwise(2).alias("part"), F.when(ok, -F.col("quality_score")).alias("by"), F.col(key).cast("string").alias("name"), line.alias("value"))
    total = judged.agg(F.format_string("TOTAL %d passed %d excluded %d", F.count("*"), F.count_if(ok), F.count_if(~ok)).alias("value"))
    total = total.select(F.lit(0).alias("part"), F.lit(None).cast("double").alias("by"), F.lit("").alias("name"), "value")
    rows.unionByName(total).orderBy("part", "by", "name").select("value").write.mode("overwrite").text(path)


def write_questions(questions: DataFrame, path: str, per_file: str | None = None, key: str = "source", order: str = "pos") -> None:
    """Questions of all files as JSON lines, in order of file and place; with per_file also a folder for each file."""
    if per_file:
        named = questions.withColumn("file", F.regexp_replace(key, r"[/\\]", "_"))
        named.repartition("file").sortWithinPartitions("file", order).write.mode("overwrite").partitionBy("file").json(per_file)
    questions.orderBy(key, order).write.mode("overwrite").json(path)


def write_compare_report(compared: DataFrame, summary: DataFrame, missing: DataFrame, path: str) -> None:
    """The report of a comparison as JSON lines: summary, files, and keys that one side lacks."""
    for name, df in (("summary", summary), ("files", compared), ("missing", missing)):
        df.write.mode("overwrite").json(f"{path}/{name}")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_progress(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """States of earlier runs as JSON lines. Nothing is known where there is no file; lines that can't be read count as unknown."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    first = schema.split()[0]
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where(F.col(first).isNotNull())


def demo_documents(spark: SparkSession) -> DataFrame:
    """Two small texts with entity and relation marks, for trying the engine out."""
    texts = {
        "demo_vessel": "储罐是一种压力容器。(储罐 - 设备 - 存放液体的容器) 储罐由钢板焊接而成。(钢板 - 材料 - 制造储罐的板材) [储罐 -> 钢板: 使用]",
        "demo_pump": "水泵为储罐供水。(水泵 - 设备 - 输送液体的机器) 水泵由电机驱动。(电机 - 设备 - 提供动力) [水泵 -> 储罐: 供水] [电机 -> 水泵: 驱动]",
    }
    return spark.createDataFrame(list(texts.items()), "source string, text string")


def write_state(tables: dict[str, DataFrame], path: str) -> None:
    """The engine's state: a parquet table each. All are written beside the old state, which is replaced only when they are complete, so
    they may be read from it."""
    if not tables:
        return
    spark = next(iter(tables.values())).sparkSession
    to = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    new = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + ".new")
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(new, True)
    for name, df in tables.items():
        df.write.parquet(f"{new}/{name}")
    fs.delete(to, True)
    if not fs.rename(new, to):
        raise OSError(f"{new} could not be moved to {to}")


def read_state(spark: SparkSession, path: str, names: tuple[str, ...]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}


def to_gexf(nodes: DataFrame, edges: DataFrame, max_items: int = 1_000_000) -> bytes:
    """The graph as undirected GEXF (edges both ways become one); made on the driver, so its size is checked."""
    if nodes.count() + edges.count() > max_items:
        raise ValueError("the graph is too large for one file")
    root = ElementTree.Element("gexf", {"xmlns": "http://www.gexf.net/1.2draft", "version": "1.2"})
    graph = ElementTree.SubElement(root, "graph", {"defaultedgetype": "undirected", "mode": "static"})
    kinds = {"node": ("type", "description", "community_id"), "edge": ("relation", "description")}
    for kind, names in kinds.items():
        group = ElementTree.SubElement(graph, "attributes", {"class": kind})
        for i, n in enumerate(names):
            ElementTree.SubElement(group, "attribute", {"id": str(i), "title": n, "type": "integer" if n == "community_id" else "string"})

    def values(parent, row, names):
        box = ElementTree.SubElement(parent, "attvalues")
        for i, n in enumerate(names):
            v = row[n] if n in row.__fields__ else None
            if v is not None or n != "community_id":
                ElementTree.SubElement(box, "attvalue", {"for": str(i), "value": "" if v is None else str(v)})

    box = ElementTree.SubElement(graph, "nodes")
    for r in nodes.orderBy("name").toLocalIterator():
        values(ElementTree.SubElement(box, "node", {"id": r["name"], "label": r["name"]}), r, kinds["node"])
    box, seen = ElementTree.SubElement(graph, "edges"), set()
    for r in edges.orderBy("source", "target").toLocalIterator():
        pair = (min(r.source, r.target), max(r.source, r.target))
        if pair not in seen:
            seen.add(pair)
            values(ElementTree.SubElement(box, "edge", {"id": str(len(seen) - 1), "source": r.source, "target": r.target}), r, kinds["edge"])
    return ElementTree.tostring(root, encoding="utf-8", xml_declaration=True)


def filter_log(judged: DataFrame, key: str = "doc_id", max_rows: int = 10_000) -> str:
    """A readable log: what passed by falling score, what was excluded by name, and totals. For small corpora; the row limit is
    for readers, totals count all."""
    passed = judged.where("filter_reason IS NULL")
    lines = ["PASSED"] + [f"{r.quality_score:.4f}  {r[0]}" for r in passed.select(key, "quality_score").orderBy(F.desc("quality_score"), key).limit(max_rows).collect()]
    excluded = judged.where("filter_reason IS NOT NULL")
    lines += ["EXCLUDED"] + [f"{r[0]}  {r.filter_reason}" for r in excluded.select(key, "filter_reason").orderBy(key).limit(max_rows).collect()]
    return "\n".join([*lines, f"TOTAL {judged.count()} passed {passed.count()} excluded {excluded.count()}"])
