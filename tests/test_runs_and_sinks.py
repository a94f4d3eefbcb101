"""Batch runs with summaries, conversions by page and again, sinks, stored progress and models that workers load."""

import json

import numpy as np
import pytest

from quillgraph import cli, settings, sources
from quillgraph.engine import Engine
from quillgraph.functions import models
from quillgraph.operators import convert, files, noise, preprocess, vectors


def lines(path):
    return [json.loads(x) for f in sorted(path.rglob("*.json")) for x in f.read_text().splitlines()]


def test_compress_batch_counts_new_resumed_and_failed(spark):
    long = "word " * 40
    docs = spark.createDataFrame([("a", long), ("b", long), ("c", "short"), ("d", long + "bad"), ("e", long)], "file string, text string")
    done = spark.createDataFrame([("a", "completed"), ("d", "failed")], "file string, status string")
    there = spark.createDataFrame([("e", "x" * 101), ("b", "x" * 100)], "file string, text string")

    def model(t):
        if t.endswith("bad"):
            e = RuntimeError("no credit")
            e.status = 402
            raise e
        return "```markdown\nfine\n```"

    states, summary = preprocess.compress_batch(docs, done, there, model=model)
    got = {r.file: (r.status, r.output) for r in states.collect()}
    assert got == {"b": ("completed", "fine"), "c": ("skipped", None), "d": ("failed", None)}
    n = preprocess.tokens(long)
    assert summary.first().asDict() == {"total_files": 5, "completed": 1, "resumed": 1, "failed": 1, "input_tokens": n, "output_tokens": 1, "compression_ratio": 1 / n, "cost_yuan": round(n / 1e6 + 2 / 1e6, 4)}
    empty = preprocess.compress_batch(docs.limit(0))[1].first()
    assert (empty.total_files, empty.input_tokens, empty.compression_ratio) == (0, 0, 0.0)


def test_questions_batch(spark):
    long = "## one\n" + "line of words here " * 5 + "\n## two\n" + "other line of words " * 5

    def model(t):
        if "## one" in t and "## two" in t:
            raise preprocess.ContextOverflow
        return '["same", "' + ("first" if "one" in t else "second") + '"]'

    docs = spark.createDataFrame([(1, long), (2, "short"), (3, long), (4, long)], "id long, text string")
    done = spark.createDataFrame([("3", "completed")], "file string, status string")
    there = spark.createDataFrame([(4, '{"question": "x"}')], "id long, text string")
    got, states, summary = preprocess.questions_batch(docs, done, there, model=lambda t: model(t), key="id", max_tokens=1)
    # The overflow isn't tried again: the text is asked about in sections
    assert [(r.source, r.pos, r.question) for r in got.orderBy("pos").collect()] == [("1", 0, "same"), ("1", 1, "first"), ("1", 2, "second")]
    assert {r.file: r.status for r in states.collect()} == {"1": "completed", "2": "skipped"}
    s = summary.first()
    assert (s.total_files, s.completed, s.resumed, s.failed, s.total_questions, s.input_tokens) == (4, 1, 1, 0, 3, preprocess.tokens(long))


def test_modes_and_conversion_stage(spark):
    docs = spark.createDataFrame([("a", "<h1>T</h1><p>" + "word " * 100 + "</p>"), ("b", "<p>x</p>")], "file string, html string")
    out = preprocess.run_all(docs, stages=("convert", "quality", "compress"), mode="stats")
    assert out["quality"].count() == 2 and {r.file: r.status for r in out["compress"].collect()} == {"a": "completed", "b": "skipped"}
    assert preprocess.run_all(docs, stages=("convert", "quality", "compress"), min_chinese_ratio=0.0, max_repetition_ratio=1.0, min_quality_score=0.0)["compress"].count() == 1
    with pytest.raises(ValueError):
        preprocess.run_all(docs, mode="other")


def test_pages_are_numbered_over_pieces(spark):
    pieces = spark.createDataFrame([("d", 0, "a|b"), ("d", 1, "c"), ("e", 0, "x"), ("d", 2, "e|f")], "doc string, piece int, content string")
    got = convert.to_pages(pieces, "doc", "piece", "content", lambda c: c.split("|")).orderBy("name").collect()
    assert [(r.name, r.text) for r in got] == [("d_p001", "a"), ("d_p002", "b"), ("d_p003", "c"), ("d_p004", "e"), ("d_p005", "f"), ("e_p001", "x")]
    bare = spark.createDataFrame([("d", 0, None), ("d", 1, ["z"])], "doc string, piece int, pages array<string>")
    assert [r.name for r in files.global_pages(bare, "doc", "piece", "pages", "doc").collect()] == ["d_p001"]


def test_reconvert_once_and_only_what_is_bad(spark):
    good = "x" * 6000
    outputs = spark.createDataFrame([(1, good), (2, ""), (3, "Image not available" + "y" * 2000), (4, "z"), (5, "w")], "page_id long, markdown string")
    pages = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three"), (3, "three"), (5, "boom")], "page_id long, html string")

    def converter(h):
        if h == "boom":
            raise MemoryError
        return h.upper()

    got = {r.page_id: (r.markdown, r.redone) for r in convert.reconvert(outputs, pages, converter=converter).collect()}
    assert got == {1: (good, False), 2: ("TWO", True), 3: ("THREE", True), 4: ("z", False), 5: ("w", False)}
    assert convert.in_turn(converter, lambda h: "thrifty")("boom") == "thrifty" and convert.in_turn(converter)("boom") is None


def test_sinks(spark, tmp_path):
    judged = spark.createDataFrame([(1, "a", 0.5, None), (2, "b", 0.9, None), (3, "c", 0.1, "low")], "doc_id long, text string, quality_score double, filter_reason string")
    sources.write_filter_log(judged, str(tmp_path / "log"))
    log = [x for f in sorted((tmp_path / "log").glob("*.txt")) for x in f.read_text().splitlines()]
    assert log == ["TOTAL 3 passed 2 excluded 1", "PASSED 0.9000  2", "PASSED 0.5000  1", "EXCLUDED 3  low"]
    sources.write_exclusions(judged, str(tmp_path / "out"))
    assert [(r["id"], r["metadata"]["filter_reason"]) for r in lines(tmp_path / "out")] == [("3", "low")]
    asked = spark.createDataFrame([("b/x", 1, "q2"), ("a", 0, "q"), ("b/x", 0, "q1")], "source string, pos int, question string")
    sources.write_questions(asked, str(tmp_path / "all"), str(tmp_path / "each"))
    assert [r["question"] for r in lines(tmp_path / "all")] == ["q", "q1", "q2"]
    assert sorted(p.name for p in (tmp_path / "each").iterdir() if p.is_dir()) == ["file=a", "file=b_x"]
    sources.write_chunks(asked, str(tmp_path / "chunks"))
    assert {p.name for p in (tmp_path / "chunks").iterdir() if p.is_dir()} == {"source_key=a", "source_key=b_x"}


def test_progress_tolerates_what_cannot_be_read(spark, tmp_path):
    schema = "file string, status string"
    assert sources.read_progress(spark, str(tmp_path / "none"), schema).count() == 0
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.json").write_text('{"file": "a", "status": "completed"}\n{"file": "b", "sta\n')
    assert [r.file for r in sources.read_progress(spark, str(tmp_path / "s"), schema).collect()] == ["a"]
    assert sources.read_progress(spark, str(tmp_path / "s"), schema).count() == 1


def test_models_are_loaded_by_workers(spark):
    class Lock:  # stands for a model that can't be sent
        def __reduce__(self):
            raise TypeError

    def load():
        held = Lock()
        return lambda texts: [[len(t), 1.0] for t in texts] if held else None

    e = models.embedder("local", load)
    e.embed(["a"])
    engine = Engine(spark, embedder=e)
    engine.load_documents({"a": "One sentence here. Another one follows."})
    assert engine.chunk_documents().count() == 1
    r = models.reranker("cross-encoder", lambda: lambda pairs: [-len(t) for _, t in pairs])
    assert r.scores("q", ["abc", "d"]) == [-3.0, -1.0] and r.scores("q", []) == []
    assert e.embed([]).shape[0] == 0 and np.asarray(e.embed(["ab"])).tolist() == [[2.0, 1.0]]


def test_a_model_extracts_where_there_is_one(spark):
    reply = '{"entities": [{"name": "Pear", "type": "fruit", "description": "green"}, {"name": "Fig", "type": "fruit", "description": ""}], "relations": []}'
    config = settings.Settings.from_dict({"graph": {"max_entities_per_chunk": 1}})
    engine = Engine(spark, config, llm=lambda prompt: reply)
    engine.load_documents(sources.demo_documents(spark))
    assert [r.name for r in engine.build_graph()[0].collect()] == ["Pear"]
    plain = Engine(spark, settings.Settings.from_dict({"graph": {"model_extraction": False}}), llm=lambda prompt: reply)
    plain.load_documents(sources.demo_documents(spark))
    assert {r.name for r in plain.build_graph()[0].collect()} == {"储罐", "钢板", "水泵", "电机"}


def test_queries_sharing_an_id_at_the_border_of_a_round(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MAX_QUERIES", 2)
    asked = spark.createDataFrame([(q, [float(i), 1.0]) for i, q in enumerate((1, 2, 2, 2, 3))], "q long, v array<double>")
    chunks = spark.createDataFrame([(7, [1.0, 0.0])], "id long, v array<double>")
    assert vectors.scores(asked, chunks, "q", "id", "v").count() == 5


def test_lists_in_settings():
    text = "a:\n  - x\n  - 2\nb:\n- y\nc: [1, true, z]\nd:\n  e: 1\n"
    assert settings.parse_yaml(text) == {"a": ["x", 2], "b": ["y"], "c": [1, True, "z"], "d": {"e": 1}}


def test_preprocess_and_compare_commands(spark, tmp_path, capsys):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.md").write_text("# 标题\n" + "".join(f"压力容器  设计{i}。\n" for i in range(200)))
    (docs / "b.md").write_text("short")
    for _ in range(2):
        cli.main(["preprocess", "--input", str(docs), "--output", str(tmp_path / "p")], spark)
    out = capsys.readouterr().out
    assert "'completed': 1, 'resumed': 0" in out and "'completed': 0, 'resumed': 1" in out
    assert [p.name for p in (tmp_path / "p" / "texts").glob("*.md")] == ["a.md"]
    cli.main(["compare", "--original", str(docs), "--compressed", str(tmp_path / "p" / "texts"), "--output", str(tmp_path / "r")], spark)
    assert lines(tmp_path / "r" / "summary")[0]["total_files"] == 1 and lines(tmp_path / "r" / "missing") == [{"id": "b", "side": "missing_compressed"}]
    cli.main(["rag-build", "--state", str(tmp_path / "s")], spark)
    assert "'documents': 2" in capsys.readouterr().out


def test_compare_report_counts_noise(spark):
    a = spark.createDataFrame([("x", "text")], "id string, text string")
    assert noise.compare(a, a, key="id").count() == 1
