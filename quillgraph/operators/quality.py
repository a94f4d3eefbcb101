"""Quality metrics, score, level, filter and summary of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import text as T

# Level names with their lowest scores, and the filter's defaults.
LEVELS = (("优", 0.8), ("良", 0.6), ("中", 0.4), ("差", float("-inf")))
DEFAULTS = {"min_chars": 200, "min_chinese_ratio": 0.01, "max_special_char_ratio": 0.001, "min_quality_score": 0.4, "max_repetition_ratio": 0.5}


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds counts and unrounded ratios. One projection, no shuffle; a null text counts as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_lines", T.py_lines(t)).withColumn("_full", F.filter("_lines", T.not_blank))
    sized = F.transform("_full", F.length)
    n, lines, full = F.length(t), F.size("_lines"), F.size("_full")
    short = F.size(F.filter(sized, lambda x: x < 10))
    long = F.size(F.filter(sized, lambda x: x > 200))
    cjk, special = T.count_of(t, T.CJK), T.count_of(t, T.BOX_DRAWING)
    total = F.aggregate(sized, F.lit(0).cast("long"), lambda a, x: a + x)
    found = {
        "char_count": n,
        "line_count": lines,
        "chinese_char_count": cjk,
        "nonblank_lines": full,
        "section_count": F.size(F.filter("_full", lambda x: T.strip(x).startswith("#"))),
        "has_toc": F.contains(F.substring(t, 1, 500), F.lit("目")),
        "_special": special,
        "_total": total,
        "_short": short,
        "_long": long,
        "_kinds": F.size(F.array_distinct("_full")),
    }
    # One row of counts a text, made by a generator: conditions on what follows aren't pushed below it, so it is made once
    counted = df.select(*docs.columns, F.explode(F.array(F.struct(*[c.alias(k) for k, c in found.items()]))).alias("_m")).select(*docs.columns, "_m.*")
    n, lines, full = F.col("char_count"), F.col("line_count"), F.col("nonblank_lines")
    return counted.withColumns(
        {
            "chinese_ratio": _ratio(F.col("chinese_char_count"), n),
            "special_char_ratio": _ratio(F.col("_special"), n),
            "empty_line_ratio": F.when(lines == 0, F.lit(0.0)).otherwise(1 - full / lines),
            "avg_line_length": _ratio(F.col("_total"), full),
            "short_line_ratio": _ratio(F.col("_short"), full),
            "long_line_ratio": _ratio(F.col("_long"), full),
            "repetition_line_ratio": F.when(full == 0, F.lit(0.0)).otherwise(1 - F.col("_kinds") / full),
        }
    ).drop("_special", "_total", "_short", "_long", "_kinds")


def score(df: DataFrame) -> DataFrame:
    """Adds quality_score (unrounded, sub-scores from unrounded ratios) and quality_level. Takes what metrics() adds."""
    one = F.lit(1.0)
    least = lambda x: F.least(one, x)
    total = (
        0.25 * least(F.col("char_count") / 5000)
        + 0.15 * least(F.col("chinese_ratio") / 0.5)
        + 0.15 * least(F.col("section_count") / 5)
        + 0.10 * (1 - least(F.col("short_line_ratio")))
        + 0.15 * (1 - least(F.col("special_char_ratio") * 500))
        + 0.10 * (1 - least(F.col("repetition_line_ratio") * 5))
        + 0.10 * (1 - least(F.col("empty_line_ratio") * 2))
    )
    level = F.lit(LEVELS[-1][0])
    for name, lowest in reversed(LEVELS[:-1]):
        level = F.when(F.col("quality_score") >= lowest, F.lit(name)).otherwise(level)
    return df.withColumn("quality_score", total).withColumn("quality_level", level)


def filter_reasons(df: DataFrame, **limits) -> DataFrame:
    """Adds filter_reason (null if the document passes); thresholds are compared with the rounded values."""
    k = {**DEFAULTS, **limits}
    chinese, special = T.nearest("chinese_ratio", 4), T.nearest("special_char_ratio", 6)
    quality, repeated = T.nearest("quality_score", 4), T.nearest("repetition_line_ratio", 4)
    says = lambda name, x, digits, sign, limit: F.concat(F.lit(f"{name}("), T.fixed(x, digits), F.lit(f"{sign}{k[limit]})"))
    found = F.array(
        F.when(F.col("char_count") < k["min_chars"], F.format_string(f"too_short(%d<{k['min_chars']})", "char_count")),
        F.when(chinese < k["min_chinese_ratio"], says("low_chinese_ratio", chinese, 2, "<", "min_chinese_ratio")),
        F.when(special > k["max_special_char_ratio"], says("high_garbled", special, 4, ">", "max_special_char_ratio")),
        F.when(quality < k["min_quality_score"], says("low_quality", quality, 2, "<", "min_quality_score")),
        F.when(repeated > k["max_repetition_ratio"], says("high_repetition", repeated, 2, ">", "max_repetition_ratio")),
    )
    return df.withColumn("filter_reason", F.nullif(F.array_join(found, ";"), F.lit("")))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that pass, and those that are excluded with their reason."""
    return df.where("filter_reason IS NULL").drop("filter_reason"), df.where("filter_reason IS NOT NULL")


def levels(df: DataFrame) -> DataFrame:
    """Count and share of every level, zero where there is none."""
    counted = df.groupBy("quality_level").agg(F.count("*").alias("n"))
    names = df.sparkSession.createDataFrame([(name,) for name, _ in LEVELS], "quality_level string")
    out = names.join(counted, "quality_level", "left").select("quality_level", F.coalesce("n", F.lit(0)).alias("n"))
    from pyspark.sql import Window

    everything = Window.partitionBy()  # over four rows
    return out.withColumn("pct", F.when(F.sum("n").over(everything) == 0, 0.0).otherwise(F.col("n") * 100 / F.sum("n").over(everything)))


def summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.avg("quality_score").alias("avg_score"), F.max("quality_score").alias("max_score"), F.min("quality_score").alias("min_score"))


def passed(everything: DataFrame, excluded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Reconciliation by id: all but the excluded."""
    return everything.join(excluded.select(key), key, "left_anti")
