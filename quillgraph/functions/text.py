"""Text expressions: lines, strips, token estimates and sections, as Catalyst columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's white space and its line breaks, as regular-expression classes (Java and RE2 alike).
SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
CJK = r"[\x{4e00}-\x{9fff}]"
BOX_DRAWING = r"[\x{2500}-\x{259f}]"
YI = r"[\x{a000}-\x{a48f}]"

#: Price model: yuan for a million input and output tokens.
PRICE_IN, PRICE_OUT = 1.0, 2.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_of(text, pattern: str) -> Column:
    return F.regexp_count(_col(text), F.lit(pattern))


def strip(text) -> Column:
    """Without white space at both ends, Unicode's included."""
    return F.regexp_replace(_col(text), f"^[{SPACE}]+|[{SPACE}]+$", "")


def py_lines(text) -> Column:
    """Lines at all Unicode line breaks, without an empty last one."""
    parts = F.split(_col(text), LINE_BREAK, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def nl_lines(text) -> Column:
    """Lines at newlines alone; an empty text is one line."""
    return F.split(_col(text), "\n", -1)


def not_blank(line: Column) -> Column:
    return line.rlike(f"[^{SPACE}]")


def estimate_tokens(text) -> Column:
    """1.5 a CJK character and 0.25 any other, cut to an integer."""
    t = _col(text)
    cjk = count_of(t, CJK)
    return F.floor(cjk * 1.5 + (F.length(t) - cjk) * 0.25).cast("int")


def cost_yuan(tokens_in, tokens_out) -> Column:
    return _col(tokens_in) / 1e6 * PRICE_IN + _col(tokens_out) / 1e6 * PRICE_OUT


def nearest(x, digits: int) -> Column:
    """To so many digits as SQL does it: the nearest multiple of a power of ten, halves upward. F.round goes by the shortest decimal form
    instead, in which 0.00015 is a half that its product with 10,000 is not."""
    return F.round(_col(x) * float(10**digits)) / float(10**digits)


def fixed(x, digits: int) -> Column:
    """With so many digits as Python and SQL write it: by the exact binary value, halves to the even digit (F.format_string rounds halves up)."""
    return F.call_function("format_number", _col(x), F.lit("0." + "0" * digits))


def strip_fences(text) -> Column:
    """A model's reply without the code fence around it."""
    return strip(F.regexp_replace(F.regexp_replace(strip(text), r"^```[a-zA-Z]*\s*\n?", ""), r"\n?```\s*$", ""))


def pack(pieces: Column, sizes: Column, limit: int, joiner: str) -> Column:
    """Greedy packing: pieces are joined while their sizes add up to at most limit. The token count of what is being
    filled is carried along, so the fold is linear. A piece over the limit stands alone."""
    items = F.arrays_zip(pieces.alias("piece"), sizes.alias("size"))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("held"), F.lit(0).cast("long").alias("n"))

    def step(acc, x):
        piece, size = x["piece"], x["size"].cast("long")
        fits = acc["held"].isNotNull() & (acc["n"] + size <= limit)
        return F.struct(
            F.when(fits | acc["held"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["held"]))).alias("done"),
            F.when(fits, F.concat(acc["held"], F.lit(joiner), piece)).otherwise(piece).alias("held"),
            F.when(fits, acc["n"] + size).otherwise(size).alias("n"),
        )

    return F.aggregate(items, start, step, lambda acc: F.when(acc["held"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["held"]))))
