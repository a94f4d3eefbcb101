"""Noise profiles, comparison of original and cleaned texts, and dry runs of compression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import text as T

#: Share of input tokens that a compressed text is assumed to have.
ASSUMED_OUTPUT = 0.4


def profile(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the 18 fields of a noise profile. Lines are those between newlines; ratios are rounded to 4 places."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_lines", T.nl_lines(t))
    n, lines = F.length(t), F.size("_lines")
    empty = F.size(F.filter("_lines", lambda x: ~T.not_blank(x)))
    cjk = T.count_of(t, T.CJK)
    counts = {
        "h1_count": T.count_of(t, r"(?md)^#[" + T.SPACE + "]"),
        "h2_count": T.count_of(t, r"(?md)^##[" + T.SPACE + "]"),
        "h3_count": T.count_of(t, r"(?md)^###[" + T.SPACE + "]"),
        "table_rows": T.count_of(t, r"(?md)^\|.*\|$"),
        "garbled_chars": T.count_of(t, T.BOX_DRAWING),
        "yi_syllables": T.count_of(t, T.YI),
        "ics_spacing_noise": T.count_of(t, "I C S"),
        "pagebreak_noise": T.count_of(t, r"(?i)---[" + T.SPACE + "]*pagebreak"),
        "img_placeholder_noise": T.count_of(t, r"(?d)<!--.*?-->"),
    }
    df = df.withColumns(
        {
            "total_chars": n,
            "chinese_chars": cjk,
            "chinese_ratio": F.when(n > 0, F.round(cjk / n, 4)).otherwise(0.0),
            "total_lines": lines,
            "empty_lines": empty,
            "empty_line_ratio": F.round(empty / lines, 4),
            **counts,
        }
    )
    noise = sum((F.col(c) for c in ("yi_syllables", "ics_spacing_noise", "pagebreak_noise", "img_placeholder_noise")), F.col("garbled_chars"))
    return df.withColumns({"non_empty_lines": F.col("total_lines") - F.col("empty_lines"), "total_headings": F.col("h1_count") + F.col("h2_count") + F.col("h3_count"), "total_noise": noise}).drop("_lines")


SIDE = ("size_bytes", "tokens", "total_noise", "total_headings", "chinese_ratio", "empty_line_ratio", "table_rows")


def _side(docs: DataFrame, key: str, text: str, prefix: str) -> DataFrame:
    df = profile(docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("_text")), "_text")
    df = df.withColumns({"size_bytes": F.octet_length("_text"), "tokens": T.estimate_tokens("_text")})
    return df.select(key, *[F.col(c).alias(f"{prefix}_{c}") for c in SIDE])


def compare(original: DataFrame, compressed: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per key that both sides have: both profiles' main fields and their differences. Profiles are made before the
    join, so that texts are not shuffled."""
    both = _side(original, key, text, "orig").join(_side(compressed, key, text, "comp"), key)
    ratio = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b), 4)).otherwise(0.0)
    return both.withColumns(
        {
            "token_ratio": ratio("comp_tokens", "orig_tokens"),
            "size_ratio": ratio("comp_size_bytes", "orig_size_bytes"),
            "tokens_change": F.col("comp_tokens") - F.col("orig_tokens"),
            "size_change": F.col("comp_size_bytes") - F.col("orig_size_bytes"),
            "noise_change": F.col("comp_total_noise") - F.col("orig_total_noise"),
            "heading_change": F.col("comp_total_headings") - F.col("orig_total_headings"),
            "chinese_ratio_change": F.round(F.col("comp_chinese_ratio") - F.col("orig_chinese_ratio"), 4),
        }
    )


def compare_summary(compared: DataFrame) -> DataFrame:
    """One row of totals and averages; avg_token_ratio is a ratio of totals, averages are over rounded per-file ratios."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    mean = lambda c, k: F.round(F.sum(c) / F.count("*"), k)
    change = lambda c, k: F.round((F.sum(f"comp_{c}") - F.sum(f"orig_{c}")) / F.count("*"), k)
    names = (("chinese_ratio", "chinese_ratio", 4), ("empty_line_ratio", "empty_line_ratio", 4), ("total_headings", "headings", 2), ("table_rows", "table_rows", 2), ("total_noise", "noise", 2))
    averages = []
    for column, name, k in names:
        averages += [mean(f"orig_{column}", k).alias(f"avg_orig_{name}"), mean(f"comp_{column}", k).alias(f"avg_comp_{name}"), change(column, k).alias(f"avg_{name}_change")]
    return compared.agg(
        F.count("*").alias("total_files"),
        total("orig_tokens").alias("total_orig_tokens"),
        total("comp_tokens").alias("total_comp_tokens"),
        (total("orig_tokens") - total("comp_tokens")).alias("total_tokens_saved"),
        F.coalesce(F.round(F.sum("comp_tokens") / F.nullif(F.sum("orig_tokens"), F.lit(0)), 4), F.lit(0.0)).alias("avg_token_ratio"),
        total("orig_size_bytes").alias("total_orig_size"),
        total("comp_size_bytes").alias("total_comp_size"),
        (total("orig_total_noise") - total("comp_total_noise")).alias("total_noise_removed"),
        *averages,
    )


def missing(original: DataFrame, compressed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keys that one side lacks, as (key, side)."""
    a, b = original.select(key), compressed.select(key)
    return a.join(b, key, "left_anti").withColumn("side", F.lit("missing_compressed")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("missing_original")))


def dry_run(docs: DataFrame, text: str = "text") -> DataFrame:
    """Tokens and cost that compressing all documents would take."""
    t = docs.select(T.estimate_tokens(F.coalesce(F.col(text), F.lit(""))).alias("n"))
    total = t.agg(F.count("*").alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum((F.col("n") * ASSUMED_OUTPUT).cast("int")), F.lit(0)).alias("output_tokens"))
    return total.withColumn("cost_yuan", T.cost_yuan("input_tokens", "output_tokens"))
