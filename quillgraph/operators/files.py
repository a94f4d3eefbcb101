"""Bookkeeping of document files: ranges, pages, validation, orphans, resuming."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.rows import numbered

# Source extensions in order of preference, the suffix of split or paged outputs, size limits in bytes; below,
# the wording of issues.
EXTENSIONS = ("pdf", "docx", "pptx", "html", "htm", "doc", "xlsx")
PAGE_SUFFIX = r"[_-]p\d{3}(-p?\d{3})?$"
MIN_BYTES, SMALL_BYTES = 1024, 5120
PAGE_BREAK = "\n\n--- pagebreak ---\n\n"


def merge_corpus(docs: DataFrame, key: str = "source", text: str = "text", order: str = "load_seq") -> DataFrame:
    """One text per key, the one loaded last."""
    return docs.groupBy(key).agg(F.max_by(text, order).alias(text))


def parse_ranges(spec: str) -> list[tuple[int, int]]:
    """"1-5,8,10-12" as inclusive ranges."""
    out = []
    for part in (p.strip() for p in spec.split(",")):
        if part:
            a, _, b = part.partition("-")
            out.append((int(a), int(b or a)))
    return out


def select_range(files: DataFrame, spec: str, name: str = "file") -> DataFrame:
    """Files whose 1-based place in the order of names is in the ranges; places beyond the end are ignored."""
    placed = numbered(files, F.col(name))
    wanted = F.lit(False)
    for a, b in parse_ranges(spec):
        wanted = wanted | F.col("place").between(a, b)
    return placed.where(wanted)


def page_ranges(docs: DataFrame, pages: str, max_pages: int, stem: str) -> DataFrame:
    """Pieces of a document of so many pages: [start, end) and a name like doc_p001-p020; none for 0 pages."""
    starts = docs.where(F.col(pages) > 0).withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col(pages) - 1, F.lit(max_pages).cast("long"))))
    end = F.least(F.col("start") + max_pages, F.col(pages))
    return starts.withColumn("end", end).withColumn("piece", F.format_string("%s_p%03d-p%03d", F.col(stem).cast("string"), F.col("start") + 1, F.col("end")))


def join_pages(pages: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """Pages of each document in order, joined by page breaks."""
    from quillgraph.functions.text import strip

    together = F.array_sort(F.collect_list(F.struct(F.col(order), F.coalesce(F.col(text), F.lit("")).alias("t"))))
    return pages.groupBy(key).agg(F.count("*").alias("n_pages"), strip(F.array_join(F.transform(together, lambda x: x["t"]), PAGE_BREAK)).alias("text"))


def global_pages(pieces: DataFrame, key: str, order: str, pages: str, stem: str) -> DataFrame:
    """A row for each page of the pieces (an array of page texts) that a document was split into: its number, counted on over all
    pieces, and a name like doc_p007. The numbers come from the pieces' sizes alone, so that texts don't meet in one task;
    (key, order) names a piece."""
    size = F.coalesce(F.size(F.coalesce(F.col(pages), F.array().cast("array<string>"))), F.lit(0))
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(key, order, size.alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    rows = pieces.join(starts, [key, order]).select(key, order, "_before", F.col(stem).cast("string").alias("_stem"), F.posexplode(pages).alias("_at", "text"))
    rows = rows.withColumn("page", F.col("_before") + F.col("_at") + 1)
    return rows.select(key, order, "page", F.format_string("%s_p%03d", "_stem", "page").alias("name"), "text")


def validate(outputs: DataFrame, text: str = "text") -> DataFrame:
    """A row per issue: empty and too small outputs are errors and nothing else is said of them."""
    n = F.octet_length(F.coalesce(F.col(text), F.lit("")))
    issue = lambda severity, reason: F.struct(F.lit(severity).alias("severity"), reason.alias("reason"))
    found = F.array(
        F.when(n == 0, issue("ERROR", F.lit("文件为空 (0 bytes)"))),
        F.when((n > 0) & (n < MIN_BYTES), issue("ERROR", F.format_string("文件过小 (%d bytes)，可能转换失败", n))),
        F.when((n >= MIN_BYTES) & (n < SMALL_BYTES), issue("WARNING", F.format_string("文件偏小 (%d bytes)，可能不完整", n))),
        F.when((n >= MIN_BYTES) & F.contains(F.col(text), F.lit("Image not available")), issue("WARNING", F.lit("包含 'Image not available'"))),
    )
    return outputs.withColumn("_i", F.explode(F.filter(found, lambda x: x.isNotNull()))).withColumns({"severity": F.col("_i.severity"), "reason": F.col("_i.reason")}).drop("_i")


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("severity").agg(F.count("*").alias("n"))


def base_stem(output: str = "output"):
    """An output's name without its extension and the suffix of a piece or page."""
    return F.regexp_replace(F.regexp_replace(F.col(output), r"\.[^.]*$", ""), PAGE_SUFFIX, "")


def orphans(outputs: DataFrame, sources: DataFrame, output: str = "output", source: str = "source_file") -> DataFrame:
    """Outputs without a source of an allowed extension."""
    stems = sources.where(F.lower(F.regexp_extract(source, r"\.([^.]*)$", 1)).isin(*EXTENSIONS)).select(F.regexp_replace(source, r"\.[^.]*$", "").alias("stem"))
    return outputs.withColumn("stem", base_stem(output)).join(stems, "stem", "left_anti")


def find_source(outputs: DataFrame, sources: DataFrame, output: str = "output", source: str = "source_file") -> DataFrame:
    """The source of each output: the preferred extension, then the first path."""
    rank = F.array_position(F.array(*[F.lit(e) for e in EXTENSIONS]), F.lower(F.regexp_extract(source, r"\.([^.]*)$", 1)))
    ranked = sources.select(F.regexp_replace(source, r"\.[^.]*$", "").alias("stem"), F.struct(rank.alias("rank"), F.col(source).alias("path")).alias("s")).where("s.rank > 0")
    first = ranked.groupBy("stem").agg(F.min("s").alias("s"))
    return outputs.withColumn("stem", base_stem(output)).join(first, "stem").select(output, F.col("s.path").alias(source))


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is still to do: resuming is an anti join."""
    return work.join(done.select(key), key, "left_anti")
