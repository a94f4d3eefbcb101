"""Compression, question generation and the run of all stages."""

import pytest

from quillgraph.operators import preprocess


def frame(spark, rows):
    return spark.createDataFrame(rows, "file string, text string")


def test_compress_states_and_resume(spark):
    long = "word  " * 40
    docs = frame(spark, [("a", long), ("b", "short"), ("c", None), ("d", long + "x")])
    first = preprocess.compress(docs.where("file <> 'd'"))
    got = {r.file: r for r in first.collect()}
    assert got["a"].status == "completed" and got["a"].output == " ".join(["word"] * 40) and got["a"].compression_ratio == round(got["a"].output_tokens / got["a"].input_tokens, 3)
    assert {got[x].reason for x in "bc"} == {"too short"}
    again = {r.file for r in preprocess.compress(docs, first).collect()}
    assert again == {"b", "c", "d"}

    def broken(_):
        e = RuntimeError("no key")
        e.status = 401
        raise e

    r = preprocess.compress(docs.where("file = 'a'"), model=broken).first()
    assert (r.status, r.error) == ("failed", "no key")


def test_long_texts_fall_back_to_sections():
    calls = []

    def model(t):
        calls.append(t)
        if len(t) > 20:
            raise preprocess.ContextOverflow
        return t.upper()

    text = "## a\n" + "x" * 10 + "\n## b\n" + "y" * 10
    assert preprocess.compress_text(text, model, True, 1) == ("## A\nXXXXXXXXXX\n\n## B\nYYYYYYYYYY", 2) and len(calls) == 3


@pytest.mark.parametrize("text, limit, want", [("## A\nx\n## B\ny", 100, ["## A\nx\n\n## B\ny"]), ("# A\nx\n# B\ny", 1, ["# A\nx", "# B\ny"]), ("## A\n# x\ny\n# z\nw", 1, ["## A\n# x\ny\n# z\nw"]), ("  ", 1, ["  "])])
def test_sections(text, limit, want):
    assert preprocess.sections(text, limit) == want


def test_questions(spark):
    docs = frame(spark, [("a", "One line here\n" * 20 + "Other line\n"), ("b", "short")])
    rows = [(r.source, r.pos, r.question) for r in preprocess.generate_questions(docs).orderBy("pos").collect()]
    assert rows == [("a", 0, "What about One line here?"), ("a", 1, "What about Other line?")]
    assert preprocess.generate_questions(docs, docs).count() == 0
    assert preprocess.questions_dry_run(docs).first().questions == 10


def test_run_all_goes_on_after_a_failure(spark):
    docs = frame(spark, [("a", "压力容器 is fine.\n" * 80)])
    out = preprocess.run_all(docs, stages=("quality", "nonsense", "compress", "questions"), max_repetition_ratio=1.0, min_quality_score=0.0)
    assert out["nonsense"].startswith("failed") and out["compress"].count() == 1 and out["questions"].count() == 1
