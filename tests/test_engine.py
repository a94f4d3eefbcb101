"""The engine over several builds, many questions, failing models and saved states."""

import json

import numpy as np
import pytest

from quillgraph.engine import Engine
from quillgraph.functions import models
from quillgraph.operators import chunking, graph_build
from quillgraph.settings import Settings

MARKS = "(Apple - Company - maker) makes (iPhone - Product - phone) [Apple -> iPhone: produces]"


def built(spark, docs, **k):
    e = Engine(spark, **k)
    e.load_documents(docs)
    e.chunk_documents()
    e.build_graph()
    return e


def graph(e):
    nodes = {r["name"]: (r.type, r.description, r.chunk_refs) for r in e.nodes.collect()}
    return nodes, {(r.source, r.target): (r.relation, r.chunk_refs) for r in e.edges.collect()}


def test_a_later_build_adds_to_the_graph(spark):
    e = built(spark, {"a": MARKS})
    chunks, done = e.chunks, graph_build.processed_chunks(e.nodes)
    e.load_documents({"b": "(Pear - Company - other) and (Apple - Company - grower) [Pear -> Apple: rivals] [Apple -> iPhone: sells]"})
    e.chunk_documents(chunks)
    e.build_graph(done)
    nodes, edges = graph(e)
    assert set(nodes) == {"Apple", "iPhone", "Pear"} and nodes["Apple"][:2] == ("Company", "grower") and nodes["iPhone"][:2] == ("Product", "phone")
    assert len(nodes["Apple"][2]) == 2 and set(edges) == {("Apple", "iPhone"), ("Pear", "Apple")} and edges["Apple", "iPhone"][0] == "sells"
    # As one build of both documents gives it
    assert graph(built(spark, {"a": MARKS, "b": "(Pear - Company - other) and (Apple - Company - grower) [Pear -> Apple: rivals] [Apple -> iPhone: sells]"})) == (nodes, edges)
    e.clear_graph()
    assert e.graph_context("apple")["entities"] == []


def test_many_questions_have_the_context_of_one(spark):
    links = [("Alpha", "Beta"), ("Beta", "Gamma"), ("Gamma", "Delta"), ("Delta", "Omega"), ("Kappa", "Lambda")]
    names = sorted({n for p in links for n in p})

    def make(llm):
        e = Engine(spark, llm=llm)
        e.load_documents({"d": "Some text about letters."})
        e.chunk_documents()
        e.use_graph(spark.createDataFrame([(n, "T", "") for n in names], "name string, type string, description string"), spark.createDataFrame([(a, b, "next") for a, b in links], "source string, target string, relation string"))
        return e

    asked = ["alpha and delta", "kappa", "nothing known", "delta, alpha or lambda"]
    e = make(lambda prompt: prompt)
    got = {r.query_id: r for r in e.answer(spark.createDataFrame(list(enumerate(asked)), "query_id long, question string")).collect()}
    for i, q in enumerate(asked):
        one, context = e.query(q), e.graph_context(q)
        assert got[i].answer == one, q
        assert (got[i].n_entities, got[i].n_edges, got[i].n_paths, got[i].n_communities) == tuple(len(context[k]) for k in ("entities", "subgraph_edges", "paths", "communities"))
    assert "Alpha -> Beta -> Gamma -> Delta" in got[0].answer and "--[next]-->" in got[1].answer


def test_no_graph_and_no_chunks_still_answer(spark):
    e = Engine(spark)
    e.load_documents({"d": "Some text."})
    e.chunk_documents()
    r = e.answer(spark.createDataFrame([(1, "apple")], "query_id long, question string")).first()
    assert (r.n_entities, r.n_edges, r.n_chunks) == (0, 0, 1) and e.graph_context("apple") == {"entities": [], "subgraph_nodes": [], "subgraph_edges": [], "communities": [], "paths": []}


def test_reranking_drops_failing_calls_and_keeps_order_if_all_fail(spark):
    class Picky:
        def __init__(self, always):
            self.always = always

        def scores(self, query, texts):
            if self.always:
                raise ValueError
            return [float(len(t)) for t in texts]

    docs = {f"d{i}": "word " * (i + 1) for i in range(4)}
    s = Settings()
    s.rerank.top_k, s.rerank.retrieve_k = 2, 4
    q = spark.createDataFrame([(1, "word")], "query_id long, question string")
    by = {a: built(spark, docs, settings=s, reranker=Picky(a)).retrieve(q).orderBy("rank").collect() for a in (False, True)}
    assert [r.source for r in by[False]] == ["d3", "d2"] and [r["rank"] for r in by[True]] == [1, 2]
    plain = Engine(spark, s)
    plain.load_documents(docs)
    plain.chunk_documents()
    assert [r.source for r in by[True]] == [r.source for r in plain.retrieve(q, 2).orderBy("rank").collect()]


def test_rerank_batches_and_packing_against_plain_rules():
    rs = np.random.RandomState(1)
    for _ in range(200):
        texts = ["x" * int(n) for n in rs.randint(0, 40, rs.randint(0, 12))]
        calls = models.rerank_batches("q" * 5, texts, 4, 100)
        assert [i for c in calls for i in c] == list(range(len(texts)))
        cost = lambda c: 10 + sum(2 * len(texts[i]) for i in c)
        assert all(len(c) <= 4 and (cost(c) <= 100 or len(c) == 1) for c in calls)
        assert all(len(a) == 4 or cost([*a, b[0]]) > 100 for a, b in zip(calls, calls[1:], strict=False))  # no call could take more
        groups = ["y" * int(n) for n in rs.randint(0, 9, rs.randint(0, 12))]
        chunks = chunking.pack_groups(groups, 3, 8)
        assert " ".join(chunks) == " ".join(g for g in groups if g)
    assert chunking.pack_groups(["abcd", "efgh", "i", "jklmnopqrs"], 3, 8) == ["abcd efgh i", "jklmnopqrs"]
    assert chunking.pack_groups(["i", "jklmnopqrs"], 3, 8) == ["i", "jklmnopqrs"] and chunking.pack_groups([""], 3, 8) == []
    assert chunking.offsets("Hi.\n\nYou go.  Then stop.", ["Hi. You go.", "Then stop."]) == [(0, 11), (14, 24)]


def test_a_state_may_be_saved_over_the_one_it_was_read_from(spark, tmp_path):
    e = built(spark, {"a": MARKS})
    path = str(tmp_path / "state")
    e.save(path)
    again = Engine(spark)
    again.load(path)
    again.load_documents({"b": "More text."})
    again.save(path)
    third = Engine(spark)
    third.load(path)
    assert {r.source for r in third.documents.collect()} == {"a", "b"} and graph(third) == graph(e)


def test_model_extraction_falls_back_to_marks(spark):
    reply = {"entities": [{"name": "Sun", "type": "Star", "description": "hot"}, {"name": "", "type": "", "description": ""}], "relations": [{"source": "Sun", "target": "Earth", "relation": "warms"}]}

    def llm(prompt):
        if "broken" in prompt:
            return "no json"
        if "down" in prompt:
            raise ValueError
        return f"```json\n{json.dumps(reply)}\n```"

    rows = [("c1", 1, "sky"), ("c2", 2, "broken (Moon - Rock - grey)"), ("c3", 3, "down [Moon -> Earth: circles]")]
    chunks = spark.createDataFrame(rows, "chunk_id string, chunk_seq int, text string")
    entities, relations = graph_build.model_extractor(llm, wait=lambda s: None)(chunks)
    assert {(r.chunk_id, r["name"], r.type) for r in entities.collect()} == {("c1", "Sun", "Star"), ("c2", "Moon", "Rock")}
    assert {(r.chunk_id, r.source, r.target, r.relation) for r in relations.collect()} == {("c1", "Sun", "Earth", "warms"), ("c3", "Moon", "Earth", "circles")}


@pytest.mark.parametrize("fails", [True, False])
def test_batches_save_in_steps_and_stop_after_failures(spark, fails):
    s = Settings()
    s.batch.save_interval, s.batch.max_consecutive_failures = 2, 3
    e = Engine(spark, s, llm=None if fails else lambda prompt: "fine")
    e.load_documents({"d": "Some text."})
    e.chunk_documents()
    saved = []
    asked = spark.createDataFrame([(i, f"question {i}") for i in range(7)], "row_idx long, question string")
    done = e.run_batch(asked, lambda step: saved.append(sorted((r.row_idx, r.answer) for r in step.collect())), offset=1)
    if fails:  # without a model answers are fallbacks, which count as failed
        assert done == {"rows": 4, "answered": 0, "failed": 4, "stopped": True} and [len(x) for x in saved] == [2, 2]
    else:
        assert done == {"rows": 6, "answered": 6, "failed": 0, "stopped": False} and [i for x in saved for i, _ in x] == [1, 2, 3, 4, 5, 6]
