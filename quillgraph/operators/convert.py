"""Conversion of HTML to Markdown; other formats through a converter that is passed in."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgraph.functions import batches
from quillgraph.operators import files

SKIPPED = frozenset({"script", "style", "head", "noscript", "template"})
FURNITURE = frozenset({"nav", "footer", "header", "aside"})
HEADINGS = {f"h{i}": "#" * i + " " for i in range(1, 7)}
BLOCKS = frozenset({"p", "div", "article", "section", "ul", "ol", "table", "blockquote", "main", "body", *HEADINGS})


class _Markdown(HTMLParser):
    def __init__(self, furniture: bool):
        super().__init__(convert_charrefs=True)
        self.skip = SKIPPED if furniture else SKIPPED | FURNITURE
        self.lines: list[str] = []
        self.text: list[str] = []
        self.lead, self.depth, self.row = "", 0, None

    def flush(self):
        joined = " ".join("".join(self.text).split())
        if joined and self.row is None:
            self.lines.append(self.lead + joined)
        self.text, self.lead = [], ""

    def handle_starttag(self, tag, attrs):
        if tag in self.skip:
            self.flush()
            self.depth += 1
        elif tag in BLOCKS or tag in ("li", "br", "tr"):
            self.flush()
            self.lead = HEADINGS.get(tag, "- " if tag == "li" else "> " if tag == "blockquote" else "")
            if tag == "tr":
                self.row = []
        elif tag in ("b", "strong"):
            self.text.append("")
        elif tag == "img" and not self.depth:
            self.text.append("<!-- image -->")

    def handle_endtag(self, tag):
        if tag in self.skip:
            self.depth = max(0, self.depth - 1)
        elif tag in ("td", "th") and self.row is not None:
            self.row.append(" ".join("".join(self.text).split()))
            self.text = []
        elif tag == "tr" and self.row is not None:
            cells, self.row = self.row, None
            self.text = []
            if cells:
                self.lines.append("| " + " | ".join(cells) + " |")
        elif tag in BLOCKS or tag == "li":
            self.flush()

    def handle_data(self, data):
        if not self.depth:
            self.text.append(data)


def html_to_markdown(html: str | None, furniture: bool = False) -> str:
    """Headings, paragraphs, lists, quotes and table rows of a page; furniture (menus, headers, footers) on demand."""
    parser = _Markdown(furniture)
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return "\n\n".join(parser.lines)


def _converted(rows: DataFrame, content: str, name: str, kind: str, convert: Callable) -> DataFrame:
    """rows with name instead of content: what convert makes of it, on Arrow batches and there on so many texts at a time that memory is bounded."""
    kept = [c for c in rows.columns if c != content]
    typed = {"string": pa.string(), "array<string>": pa.list_(pa.string())}[kind]

    def run(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in batches.pieces(arrived, content):
            made = pa.array([convert(x) for x in piece[content].to_numpy(zero_copy_only=False)], typed)
            yield pa.RecordBatch.from_arrays([*(piece[c] for c in kept), made], [*kept, name])

    batches.bounded(rows.sparkSession)
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField(name, T.StringType() if kind == "string" else T.ArrayType(T.StringType()))])
    return rows.mapInArrow(run, schema)


def to_markdown(pages: DataFrame, key: str = "page_id", content: str = "html", converter: Callable[[str | None], str] = html_to_markdown) -> DataFrame:
    """key, markdown, n_headings of each page; the converter is called on Arrow batches."""
    out = _converted(pages.select(key, content), content, "markdown", "string", converter)
    return out.withColumn("n_headings", F.regexp_count("markdown", F.lit("(?m)^#{1,6} ")))


def in_turn(*converters: Callable[[str | None], str]) -> Callable[[str | None], str | None]:
    """A converter that tries each one given until one succeeds (such as a fast one that may run out of memory, then a
    thrifty one); null if all fail."""

    def convert(content: str | None) -> str | None:
        for c in converters:
            try:
                return c(content)
            except Exception:  # noqa: BLE001  the next one takes its place
                continue
        return None

    return convert


def to_pages(pieces: DataFrame, key: str, order: str, content: str, converter: Callable[[str | None], list[str]]) -> DataFrame:
    """key, order, page, name, text: pieces of documents converted page by page, pages numbered over all pieces of a document."""
    paged = _converted(pieces.select(key, order, content), content, "pages", "array<string>", lambda x: list(converter(x)))
    return files.global_pages(paged, key, order, "pages", key)


def reconvert(outputs: DataFrame, sources: DataFrame, key: str = "page_id", text: str = "markdown", content: str = "html", converter: Callable[[str | None], str] = html_to_markdown) -> DataFrame:
    """key, text, redone: outputs with an issue are converted again, once however many issues they have. Those without a source,
    and those that fail again, stay as they are."""
    bad = files.validate(outputs.select(key, text), text).select(key).distinct()
    again = to_markdown(sources.join(bad, key, "left_semi"), key, content, in_turn(converter)).groupBy(key).agg(F.max("markdown").alias("_new"))
    return outputs.join(again, key, "left").select(key, F.coalesce("_new", text).alias(text), F.col("_new").isNotNull().alias("redone"))
