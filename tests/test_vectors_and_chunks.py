"""Vectors, chunking, questions, models, sources, settings, streaming and the engine."""

import json
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillgraph import settings, sources, streaming
from quillgraph.engine import Engine
from quillgraph.functions import batches, models
from quillgraph.operators import chunking, convert, qa, vectors


def pairs(spark, *rows):
    return spark.createDataFrame([(list(map(float, a)), list(map(float, b))) for a, b in rows], "a array<double>, b array<double>")


def test_similarities(spark):
    rows = [([1, 2, 3], [1, 2, 3]), ([1, 0, 0], [0, 1, 0]), ([1, 0], [-1, 0]), ([0, 0, 0], [1, 0, 0]), ([1, 2, 3], [4, 5, 6])]
    got = [r.score for r in vectors.pairwise(pairs(spark, *rows), "a", "b").collect()]
    assert np.allclose(got, [1, 0, -1, 0, 32 / math.sqrt(14 * 77)]) and got[3] == 0.0
    assert vectors.pairwise(pairs(spark, rows[-1]), "a", "b", "dot_product").first().score == 32
    with pytest.raises(ValueError):
        vectors.strategy("euclid")


def test_search_matrix_and_rerank(spark):
    q = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "q long, v array<double>")
    c = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0])], "c long, v array<double>")
    full = {(r.query_id, r.id): r.score for r in vectors.scores(q, c, "q", "c", "v").collect()}
    assert len(full) == 8 and full[0, 0] == full[1, 1] == 1 and full[0, 1] == full[0, 4] == 0 and abs(full[0, 2] - 1 / math.sqrt(2)) < 1e-12
    top = vectors.best(vectors.scores(q, c, "q", "c", "v", k=2), 2)
    assert [(r.query_id, r.id) for r in top.orderBy("query_id", "rank").collect()] == [(0, 0), (0, 2), (1, 1), (1, 2)]
    again = vectors.rerank(top, -F.col("score"), 1)
    assert {r.query_id: r.id for r in again.collect()} == {0: 2, 1: 2}
    assert vectors.scores(q.limit(0), c, "q", "c", "v").count() == 0
    assert vectors.pick_k(None, True) == (20, 5) and vectors.pick_k(None, False) == (5, 5) and vectors.pick_k(3, True) == (3, 3)


def test_neighbouring_similarity_and_groups(spark):
    df = spark.createDataFrame([("d", i, v) for i, v in enumerate([[1.0, 0.0], [1.0, 0.1], [0.0, 1.0], [0.1, 1.0]])], "d string, i int, v array<double>")
    s = [r.similarity for r in vectors.adjacent(df, "d", "i", "v").orderBy("i").collect()]
    assert len(s) == 3 and s[0] > 0.9 > 0.2 > s[1]
    assert [r.group_id for r in vectors.split_groups(df, "d", "i", "v", 0.5).orderBy("i").collect()] == [0, 0, 1, 1]


@pytest.mark.parametrize("text, n", [("Hello world. This is a test. How are you?", 3), ("Just one sentence here.", 1), ("No punctuation at all in this text", 1), ("Mr. Smith met e.g. Bob. He left", 2), ("压力容器。第二句。", 1), ("", 1)])
def test_sentences(spark, text, n):
    got = spark.createDataFrame([(text,)], "text string").select(chunking.sentences()).first()[0]
    assert len(got) == n


def test_packing_and_offsets():
    assert chunking.pack_groups(["abcd", "efgh", "i", "jklmnopqrs"], 3, 8) == ["abcd efgh i", "jklmnopqrs"]
    assert chunking.pack_groups(["i", "jklmnopqrs"], 3, 8) == ["i", "jklmnopqrs"] and chunking.pack_groups([""], 3, 8) == []
    assert chunking.offsets("Hi.\n\nYou go.  Then stop.", ["Hi. You go.", "Then stop."]) == [(0, 11), (14, 24)]


@pytest.mark.parametrize(
    "text, limit, want",
    [
        ("## A\nx\n## B\ny", 100, ["## A\nx\n\n## B\ny"]),
        ("## A\nx\n## B\ny", 1, ["## A\nx", "## B\ny"]),
        ("# A\nx\n# B\ny", 1, ["# A\nx", "# B\ny"]),
        ("## A\n# x\ny\n# z\nw", 1, ["## A\n# x\ny\n# z\nw"]),
        ("  ", 5, ["  "]),
        (None, 5, [""]),
    ],
)
def test_section_chunks(spark, text, limit, want):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r.text for r in chunking.section_chunks(df, limit).orderBy("chunk_seq").collect()] == want


def test_semantic_chunks(spark):
    text = "Apple is a technology company. It makes iPhones. Google is a search engine company. It makes Android."
    df = spark.createDataFrame([("t", text), ("e", ""), ("b", "  \n\n "), ("n", None)], "source string, text string")
    rows = chunking.semantic_chunks(df, threshold=0.5, max_size=60).collect()
    assert {r.source for r in rows} == {"t"} and len(rows) >= 2
    for r in rows:
        assert 0 <= r.start_idx < r.end_idx and len(r.embedding) == chunking.DIMENSIONS and r.chunk_id == f"t:{r.start_idx}-{r.end_idx}"


def test_query_terms(spark):
    df = spark.createDataFrame([("What is the Où_x PUMP? 压力容器",), ("GPT-4 vs. AI, and pump PUMP",), (None,)], "text string")
    assert [r[0] for r in df.select(qa.query_terms()).collect()] == [["où_x", "pump", "压力容器"], ["gpt", "pump", "pump"], []]


@pytest.mark.parametrize("reply, want", [('["a", " b ", 1, "", null]', ["a", "b"]), ('```json\n["q"]\n```', ["q"]), ('Here: ["x",\n"y"] done', ["x", "y"]), ("none", []), ('{"a": 1}', []), (None, [])])
def test_parse_questions(reply, want):
    assert qa.parse_questions(reply) == want


def test_batches_of_answers(spark):
    data = spark.createDataFrame([(i, f"q{i}") for i in range(10)], "row_idx long, question string")
    answers = spark.createDataFrame([("q3", "old", 1), ("q3", "new", 2), ("q3", "", 3), ("q4", "找到 1 个相关实体和 0 个文本块。请配置 LLM", 1)], "question string, answer string, line long")
    rows = qa.resume(data, answers)
    assert {r.question: r.answer for r in rows.collect() if r.answer} == {"q3": "new"}
    assert sorted(r.row_idx for r in qa.worklist(rows, 2, 5).collect()) == [2, 4, 5, 6]
    runs = spark.createDataFrame([("k", i, f) for i, f in enumerate([1, 1, 0, 1, 0, 0, 1])], "k string, i int, f int").withColumn("f", F.col("f") == 1)
    assert sorted((r["first"], r.length) for r in qa.failure_runs(runs, "k", "i", "f").collect()) == [(0, 2), (3, 1), (6, 1)]
    q = spark.createDataFrame([("f", 0, " a "), ("f", 1, "b"), ("f", 2, "a"), ("g", 0, "a"), ("f", 3, " ")], "k string, i int, q string")
    assert sorted((r.k, r.i, r.question) for r in qa.dedupe_questions(q, "k", "i", "q").collect()) == [("f", 0, "a"), ("f", 1, "b"), ("g", 0, "a")]


def test_context_and_fallback(spark):
    schema = "c array<struct<chunk_id: string, text: string>>, e array<string>, r array<struct<source: string, target: string, relation: string>>, p array<array<string>>, m array<array<string>>"
    df = spark.createDataFrame([([("c1", "t1")], ["E"], [("A", "B", "x")] * 40, [["A", "B"]], [[f"m{i}" for i in range(12)]]), ([], [], [], [], [])], schema)
    full, empty = [r[0] for r in df.select(qa.context_string(*(F.col(x) for x in "cerpm"))).collect()]
    assert full.startswith("=== Text Chunks ===\n[c1]: t1\n\n=== Knowledge Graph Entities ===\n- E\n") and full.count("--[x]-->") == 30 and "m9" in full and "m10" not in full and empty == ""
    a, b = [r[0] for r in df.select(qa.fallback_answer(F.col("e"), F.size("c"))).collect()]
    assert a == "找到 1 个相关实体和 1 个文本块。实体: E。请配置 LLM 提供者以生成完整答案。" and b.startswith("未找到")


def test_models():
    calls = []
    e = models.ClientEmbedder(lambda t: calls.append(len(t)) or [[float(len(x)), 1.0] for x in t])
    got = e.embed(["a" * 7000, " ", *["b"] * 11])
    assert calls == [10, 2] and got[0][0] == 6000 and not got[1].any() and models.ClientEmbedder(lambda t: []).embed(["", " "]).shape == (2, 1)
    assert [i for i, _ in models.rerank_all("q", ["a", "bbb", "cc"], lambda q, t: [len(x) for x in t], 2)] == [1, 2]
    assert models.rerank_batches("q" * 10, ["x" * 40] * 5, max_docs=2) == [[0, 1], [2, 3], [4]] and models.rerank_batches("q", []) == []
    assert [len(b) for b in models.rerank_batches("q", ["x" * 4000] * 30)] == [14, 14, 2]

    def broken(q, t):
        raise OSError

    assert models.rerank_all("q", ["a", "b"], broken, 1) == [(0, None)]
    for make in (models.embedder, models.reranker):
        with pytest.raises(ValueError):
            make("unknown")
    waits, tries = [], iter([ValueError(), ValueError(), "ok"])

    def call(_):
        x = next(tries)
        if isinstance(x, Exception):
            raise x
        return x

    assert models.with_retries(call, wait=waits.append)("p") == "ok" and waits == [1.0, 2.0]


def test_settings(tmp_path, monkeypatch):
    monkeypatch.setenv("OPENAI_API_KEY", "k")
    (tmp_path / "s.yaml").write_text("chunking:\n  max_chunk_size: 100  # small\nrerank:\n  provider: overlap\nunknown: 1\nllm:\n  temperature: 0.5\n")
    s = settings.load(str(tmp_path / "s.yaml"))
    assert (s.chunking.max_chunk_size, s.chunking.min_chunk_size, s.rerank.provider, s.llm.temperature, s.llm.api_key) == (100, 50, "overlap", 0.5, "k")
    (tmp_path / ".env").write_text("# c\nOPENAI_API_KEY=other\nQUILL_TEST_X='1'\n")
    settings.load_env(str(tmp_path / ".env"))
    import os

    assert os.environ["OPENAI_API_KEY"] == "k" and os.environ.pop("QUILL_TEST_X") == "1"


def test_sources_and_sinks(spark, tmp_path):
    d = tmp_path / "in"
    (d / "sub").mkdir(parents=True)
    (d / "a.md").write_text("标题", encoding="utf-8")
    (d / "b.md.md").write_bytes("压力".encode("gbk"))
    (d / "c.txt").write_bytes(b"\xff\xfe\x81 latin")
    (d / "sub" / "x.PDF").write_bytes(b"%PDF")
    assert {r.id: r.text for r in sources.read_markdown(spark, str(d)).collect()} == {"a": "标题", "b": "压力"}
    assert {r.source for r in sources.read_directory(spark, str(d)).collect()} == {"a", "b.md", "c"}  # all files of the folder
    assert [r.source for r in sources.read_directory(spark, str(d), "*.txt").collect()] == ["c"]
    assert [r.file for r in sources.find_documents(spark, str(d)).collect()] == ["x.PDF"]
    assert sources.read_text(spark, str(d / "a.md"), "k").first().source == "k"
    (tmp_path / "q.jsonl").write_text('{"question": "a"}\n\n{"question": "b", "source": "s"}\n')
    assert [(r.question, r.source, r.answer) for r in sources.read_jsonl(spark, str(tmp_path / "q.jsonl")).collect()] == [("a", None, None), ("b", "s", None)]
    docs = spark.createDataFrame([("x/y", "text", 0.5)], "id string, text string, quality_score double")
    sources.write_markdown(docs, str(tmp_path / "md"))
    assert (tmp_path / "md" / "x_y.md").read_text() == "text"
    sources.write_report(docs, str(tmp_path / "report"))
    row = json.loads("".join(f.read_text() for f in (tmp_path / "report").glob("*.json")).splitlines()[0])
    assert row["metadata"] == {"quality_score": 0.5}
    nodes = spark.createDataFrame([("A", "t", None, 0), ("B", None, None, None)], "name string, type string, description string, community_id int")
    edges = spark.createDataFrame([("A", "B", "r", None), ("B", "A", "q", None)], "source string, target string, relation string, description string")
    x = sources.to_gexf(nodes, edges).decode()
    assert x.count("<edge ") == 1 and x.count("<node ") == 2 and 'value="0"' in x
    log = sources.filter_log(spark.createDataFrame([(1, 0.9, None), (2, 0.1, "bad")], "doc_id long, quality_score double, filter_reason string"))
    assert log.splitlines()[-1] == "TOTAL 2 passed 1 excluded 1"


def test_html_to_markdown():
    page = "<html><head><title>x</title></head><body><nav>menu</nav><h2>Head</h2><p>one <b>two</b><p>three<ul><li>i<li>j</ul><table><tr><td>a<td>b</td></tr></table><footer>f</footer></body></html>"
    got = convert.html_to_markdown(page)
    assert got.split("\n\n")[:5] == ["## Head", "one two", "three", "- i", "- j"] and "menu" not in got and "menu" in convert.html_to_markdown(page, True)
    assert convert.html_to_markdown(None) == ""


def test_stream_ingest_does_not_redo(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    for k in range(2):
        (d / f"{k}.json").write_text(json.dumps({"source": f"s{k}", "text": "Hello. There."}) + "\n")
        streaming.run(streaming.documents(spark, str(d)), chunking.semantic_chunks, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.source for r in got) == ["s0", "s1"]


def test_engine(spark, tmp_path):
    e = Engine(spark, settings.Settings.from_dict({"rerank": {"provider": "overlap"}}))
    e.load_documents({"d1": "See (Apple - Company - A tech company) and (iPhone - Product - phone). Also [Apple -> iPhone: produces] now.", "d2": "old"})
    e.load_documents({"d2": "Bananas are yellow fruit."})
    assert {r.source: r.text for r in e.documents.collect()}["d2"].startswith("Bananas")
    assert e.chunk_documents().count() == 2
    e.build_graph()
    stats = e.get_statistics()
    assert (stats["documents"], stats["graph_nodes"], stats["graph_edges"], stats["communities"], stats["rerank"]) == (2, 2, 1, 1, True)
    g = e.graph_context("what about apple and iphone")
    assert g["entities"] == ["Apple", "iPhone"] and g["paths"] == [["Apple", "iPhone"]] and g["subgraph_edges"][0]["relation"] == "produces"
    assert e.graph_context("nothing here")["entities"] == []
    assert e.query("apple").startswith("找到 1 个相关实体和 2 个文本块。实体: Apple。")
    e.llm = lambda prompt: f"answer to {prompt.rsplit('Question: ')[-1]}"
    assert e.query("apple") == "answer to apple"
    rows = e.answer(spark.createDataFrame([(1, "Apple?"), (2, "zzz")], "query_id long, question string")).collect()
    assert {r.query_id: (r.n_entities, r.answer) for r in rows} == {1: (1, "answer to Apple?"), 2: (0, "answer to zzz")}
    e.save(str(tmp_path / "state"))
    f = Engine(spark)
    f.load(str(tmp_path / "state"))
    assert f.get_statistics()["graph_nodes"] == 2
    e.export_graph(str(tmp_path / "g.gexf"))
    assert (tmp_path / "g.gexf").stat().st_size > 200
    assert e.chunk_documents(done=e.chunks).count() == 2


@pytest.mark.parametrize("gone", [("quillgraph/llm", "tests/llm"), ("quillgraph/llm", "tests/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",), ()])
def test_entry_imports_on_a_copy_without_the_pipeline_package(tmp_path, gone):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    for name in (n for n in gone if (copy / n).exists()):
        (shutil.rmtree if (copy / name).is_dir() else os.remove)(copy / name)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q) and {'quality_score', 'khop_neighbors'} <= set(q); print(sum(n.startswith('op') for n in q), 'pipeline' in q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, check=False)
    has = os.path.isdir(os.path.join(root, "quillgraph/llm")) and "quillgraph/llm" not in gone
    with_pipeline = has and os.path.exists(os.path.join(root, "corpus_pipeline.py")) and "corpus_pipeline.py" not in gone
    assert (done.returncode, done.stdout.split()) == (0, ["10" if has else "0", str(with_pipeline)]), done.stderr


def test_answer_ranks_entities_as_one_question_does(spark):
    e = Engine(spark)
    e.load_documents({"d": "Text."})
    e.chunk_documents()
    names = [f"Alpha {i:02d}" for i in range(12)] + ["Zeta One", "Zeta Two"]
    e.use_graph(spark.createDataFrame([(n, "T", "") for n in names], "name string, type string, description string"), spark.createDataFrame([], "source string, target string, relation string"))
    question = "zeta and alpha"
    got = e.answer(spark.createDataFrame([(1, question)], "query_id long, question string")).first()
    assert got.n_entities == 10 and "实体: Zeta One, Zeta Two, Alpha 00, Alpha 01, Alpha 02。" in got.answer
    assert got.answer == e.query(question)


def test_conversion_holds_few_texts_at_a_time(spark):
    """Pages of 100 KB in one partition: of what the converter makes at most about 1 MB's worth is alive at once."""

    class Noted(str):
        alive = 0

        def __new__(cls, text):
            cls.alive += 1
            return super().__new__(cls, text)

        def __del__(self):
            type(self).alive -= 1

    pages = spark.range(60, numPartitions=1).select(F.col("id").alias("page_id"), F.col("id").alias("turn"), F.when(F.col("id") != 7, F.repeat(F.lit("x"), 100_000)).alias("html"))
    most = convert.to_markdown(pages, converter=lambda x: Noted(f"{Noted.alive} {x is None}")).collect()
    assert len(most) == 60 and max(int(r.markdown.split()[0]) for r in most) < 20
    assert [r.page_id for r in most if r.markdown.endswith("True")] == [7]
    most = convert.to_pages(pages, "page_id", "turn", "html", lambda x: [Noted(str(Noted.alive))] if x else []).collect()
    assert sorted(r.page_id for r in most) == [i for i in range(60) if i != 7] and max(int(r.text) for r in most) < 20


def test_pieces_of_batches():
    texts = ["x" * 300_000, None, "é" * 300_000, "", "y" * 3_000_000, "z"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["n", "t"])
    found = list(batches.pieces([batch, batch.slice(0, 0)], "t"))
    assert [n for p in found for n in p["n"].to_pylist()] == list(range(len(texts))) and [t for p in found for t in p["t"].to_pylist()] == texts
    sizes = [[len((t or "").encode()) for t in p["t"].to_pylist()] for p in found]
    assert all(sum(n) - max(n) <= batches.PIECE_BYTES for n in sizes) and len(found) > 5


def test_chunks_are_embedded_a_megabyte_at_a_time(spark):
    def embed(texts):
        assert sum(map(len, texts)) < 2_500_000, "too many texts at once"
        return chunking.hash_embed(texts)

    docs = spark.range(80, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("Some words of a sentence. "), 4_000).alias("text"))
    assert {r.source for r in chunking.semantic_chunks(docs, "doc_id", embed=embed).select("source").distinct().collect()} == {str(i) for i in range(80)}
    assert chunking.hash_embed([]).shape == (0, chunking.DIMENSIONS)


def test_blocks_are_scored_against_few_queries_at_a_time(monkeypatch):
    rng = np.random.default_rng(3)
    q, x = rng.normal(size=(7, 4)), rng.normal(size=(50, 4))
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(x.tolist())], ["id", "v"])
    plain = [b.to_pydict() for b in vectors._blocks([batch], np.arange(7), q, True, 5)]
    monkeypatch.setattr(vectors, "MAX_CELLS", 120)
    few = [b.to_pydict() for b in vectors._blocks([batch], np.arange(7), q, True, 5)]
    assert [(b["query_id"], b["id"]) for b in few] == [(b["query_id"], b["id"]) for b in plain] and len(few) == 7
    assert all(np.allclose(a["score"], b["score"]) for a, b in zip(few, plain, strict=True))
