"""Text expressions, quality, noise and file bookkeeping against plain Python."""

import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillgraph.functions import text as T
from quillgraph.operators import files, noise, quality

MARKDOWN = "# 标题目录\r\n## A\n| a | b |\n│─ 压力 容器\n\nI C S\n--- Pagebreak\n<!-- x -->\n 　\nꀀ line\x0b# two\n"
TEXTS = ["", " ", "a", "\n", "a\n", "a\r\nb\rc\x85d", MARKDOWN, "x" * 250 + "\nshort\nshort\n", "#\n##\n"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def plain_metrics(t):
    lines = t.splitlines()
    full = [x for x in lines if x.strip()]
    n, cjk, special = len(t), sum("一" <= c <= "鿿" for c in t), sum("─" <= c <= "▟" for c in t)
    r = lambda a, b: a / b if b else 0.0
    m = {
        "char_count": n, "line_count": len(lines), "chinese_char_count": cjk, "nonblank_lines": len(full),
        "section_count": sum(x.strip().startswith("#") for x in full), "has_toc": "目" in t[:500],
        "chinese_ratio": r(cjk, n), "special_char_ratio": r(special, n), "empty_line_ratio": 1 - len(full) / len(lines) if lines else 0.0,
        "avg_line_length": r(sum(map(len, full)), len(full)), "short_line_ratio": r(sum(len(x) < 10 for x in full), len(full)),
        "long_line_ratio": r(sum(len(x) > 200 for x in full), len(full)), "repetition_line_ratio": 1 - len(set(full)) / len(full) if full else 0.0,
    }
    m["quality_score"] = 0.25 * min(1, n / 5000) + 0.15 * min(1, m["chinese_ratio"] / 0.5) + 0.15 * min(1, m["section_count"] / 5) + 0.10 * (1 - min(1, m["short_line_ratio"])) + 0.15 * (1 - min(1, m["special_char_ratio"] * 500)) + 0.10 * (1 - min(1, m["repetition_line_ratio"] * 5)) + 0.10 * (1 - min(1, m["empty_line_ratio"] * 2))
    return m


def check_metrics(spark, texts):
    for r in quality.score(quality.metrics(frame(spark, texts))).collect():
        want = plain_metrics(texts[r.doc_id] or "")
        for k, v in want.items():
            assert math.isclose(r[k], v, abs_tol=1e-12) if isinstance(v, float) else r[k] == v, (k, r[k], v, texts[r.doc_id])


def test_metrics_of_crafted_texts(spark):
    check_metrics(spark, TEXTS)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab# 目压─\n\r \x85\x0b \t", max_size=60), min_size=8, max_size=20))
def test_metrics_of_generated_texts(spark, texts):
    check_metrics(spark, texts)


def test_null_text_counts_as_empty(spark):
    r = quality.score(quality.metrics(frame(spark, [None]))).first()
    assert r.char_count == 0 and r.line_count == 0


def test_levels_filter_and_reconciliation(spark):
    rich = "\n".join(["# 标题"] * 1 + [f"## 节 {i} " + "压力容器" * 50 for i in range(30)])
    df = quality.filter_reasons(quality.score(quality.metrics(frame(spark, [rich, "short", "latin " * 100, "一\n" * 300]))))
    passed, excluded = quality.split(df)
    reasons = {r.doc_id: r.filter_reason for r in excluded.collect()}
    assert {r.doc_id for r in passed.collect()} == {0} and reasons[1].startswith("too_short(5<200);low_chinese_ratio(0.00<0.01)")
    assert reasons[2].startswith("low_chinese_ratio") and reasons[3].endswith("high_repetition(1.00>0.5)")
    assert {r.doc_id for r in quality.passed(df, excluded).collect()} == {0}
    levels = {r.quality_level: r.n for r in quality.levels(df).collect()}
    assert set(levels) == {"优", "良", "中", "差"} and sum(levels.values()) == 4
    assert quality.levels(df.limit(0)).count() == 4


def test_reasons_write_halves_as_sql_does(spark):
    docs = ["\n".join(["x" * 60] * 6 + ["y" * 60, "z" * 60]), "\n".join(["x" * 60] * 14 + ["y" * 60, "z" * 60])]  # 0.625 and 0.8125
    got = quality.filter_reasons(quality.score(quality.metrics(frame(spark, docs)))).orderBy("doc_id").collect()
    assert [r.filter_reason.split(";")[-1] for r in got] == ["high_repetition(0.62>0.5)", "high_repetition(0.81>0.5)"]
    values = spark.createDataFrame([(x,) for x in (0.625, 0.615, 0.605, 0.375, 0.00015, 0.62505)], "x double")
    assert [r.f for r in values.select(T.fixed("x", 2).alias("f")).collect()] == [f"{x:.2f}" for x in (0.625, 0.615, 0.605, 0.375, 0.00015, 0.62505)]
    assert [r.n for r in values.select(T.nearest("x", 4).alias("n")).collect()] == [0.625, 0.615, 0.605, 0.375, 0.0001, 0.6251]


def test_tokens_cost_and_lines(spark):
    df = frame(spark, ["压力ab", "", "abcd"])
    assert [r[0] for r in df.select(T.estimate_tokens("text")).collect()] == [3, 0, 1]
    assert df.select(T.cost_yuan(F.lit(1_000_000), F.lit(500_000))).first()[0] == 2.0
    for t in TEXTS:
        assert frame(spark, [t]).select(T.py_lines("text")).first()[0] == t.splitlines()
        assert frame(spark, [t]).select(T.strip("text")).first()[0] == t.strip()


def test_fences_and_packing(spark):
    assert frame(spark, ["```json\n[1]\n```"]).select(T.strip_fences("text")).first()[0] == "[1]"
    one = spark.range(1)
    got = one.select(T.pack(F.array(*map(F.lit, "abcd")), F.array(F.lit(3), F.lit(3), F.lit(9), F.lit(1)), 6, "+")).first()[0]
    assert got == ["a+b", "c", "d"]


def test_noise_profile(spark):
    r = noise.profile(frame(spark, [MARKDOWN])).first()
    assert (r.h1_count, r.h2_count, r.h3_count, r.table_rows) == (len(re.findall(r"^#\s", MARKDOWN, re.M)), 1, 0, 1)
    assert (r.garbled_chars, r.yi_syllables, r.ics_spacing_noise, r.pagebreak_noise, r.img_placeholder_noise, r.total_noise) == (2, 1, 1, 1, 1, 6)
    assert r.total_lines == len(MARKDOWN.split("\n")) and r.empty_lines == sum(not x.strip() for x in MARKDOWN.split("\n"))


def test_compare(spark):
    a, b = frame(spark, ["<!-- x --> 压力", "same", "gone"]), frame(spark, ["压力", "same"]).unionByName(spark.createDataFrame([(9, "new")], "doc_id long, text string"))
    rows = {r.doc_id: r for r in noise.compare(a, b).collect()}
    assert set(rows) == {0, 1} and rows[0].noise_change == -1 and rows[1].token_ratio == 1.0
    s = noise.compare_summary(noise.compare(a, b)).first()
    assert s.total_files == 2 and s.total_noise_removed == 1 and s.total_tokens_saved == rows[0].orig_tokens - rows[0].comp_tokens
    assert {tuple(r) for r in noise.missing(a, b).collect()} == {(2, "missing_compressed"), (9, "missing_original")}


def test_validation_sizes(spark):
    texts = ["", "a", "a" * 1023, "a" * 1024, "a" * 5119, "a" * 5120, "Image not available" + "a" * 1010, "Image not available" + "a" * 6000]
    got = {}
    for r in files.validate(frame(spark, texts)).collect():
        got.setdefault(r.doc_id, []).append(r.severity)
    assert got == {0: ["ERROR"], 1: ["ERROR"], 2: ["ERROR"], 3: ["WARNING"], 4: ["WARNING"], 6: ["WARNING", "WARNING"], 7: ["WARNING"]}
    assert {r.severity: r.n for r in files.issue_counts(files.validate(frame(spark, texts))).collect()} == {"ERROR": 3, "WARNING": 5}


def test_orphans_and_sources(spark):
    out = spark.createDataFrame([("a.md",), ("a_p001.md",), ("a_p001-p020.md",), ("b-p003.md",), ("c.md",)], "output string")
    src = spark.createDataFrame([("a.html",), ("a.pdf",), ("b.docx",), ("c.png",)], "source_file string")
    assert {r.output for r in files.orphans(out, src).collect()} == {"c.md"}
    assert {r.output: r.source_file for r in files.find_source(out, src).collect()} == {"a.md": "a.pdf", "a_p001.md": "a.pdf", "a_p001-p020.md": "a.pdf", "b-p003.md": "b.docx"}


@pytest.mark.parametrize("spec, want", [("1-5,8,10-12", {1, 2, 3, 4, 5, 8}), ("3,7,9", {3, 7, 9}), ("20", set()), ("2-4,3", {2, 3, 4}), ("", set())])
def test_file_ranges(spark, spec, want):
    df = spark.createDataFrame([(f"f{i}.md",) for i in range(1, 10)], "file string").repartition(3)
    assert {int(r.file[1]) for r in files.select_range(df, spec).collect()} == want


def test_pages(spark):
    df = spark.createDataFrame([("d", 45), ("e", 20), ("z", 0)], "stem string, n long")
    got = {(r.stem, r.start, r.end, r.piece) for r in files.page_ranges(df, "n", 20, "stem").collect()}
    assert got == {("d", 0, 20, "d_p001-p020"), ("d", 20, 40, "d_p021-p040"), ("d", 40, 45, "d_p041-p045"), ("e", 0, 20, "e_p001-p020")}
    pages = spark.createDataFrame([(1, 2, "b "), (1, 1, " a"), (2, 1, None)], "k long, o long, t string")
    assert {r.k: r.text for r in files.join_pages(pages, "k", "o", "t").collect()} == {1: "a\n\n--- pagebreak ---\n\nb", 2: ""}


def test_last_document_wins(spark):
    df = spark.createDataFrame([("a", "x", 0), ("a", "y", 1), ("b", "z", 0)], "source string, text string, load_seq int")
    assert {tuple(r) for r in files.merge_corpus(df).collect()} == {("a", "y"), ("b", "z")}
