"""Graph build, retrieval and communities."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from quillgraph.operators import communities, graph_build, graph_query


def nodes_of(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def edges_of(spark, pairs):
    return spark.createDataFrame([(a, b, "r") for a, b in pairs], "source string, target string, relation string")


TRIANGLES = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "e"), ("e", "f"), ("f", "d"), ("c", "d")]


def test_rule_extraction(spark):
    text = "There is (Apple - Company - A tech\n company) and (iPhone - Product - A smartphone ). Also [Apple -> iPhone: produces] (Où - Ville - x)."
    df = spark.createDataFrame([("c0", text), ("c1", "Just some random text with no patterns.")], "chunk_id string, text string")
    assert [(r.name, r.type, r.description) for r in graph_build.extract_entities(df).orderBy("pos").collect()] == [("Apple", "Company", "A tech\n company"), ("iPhone", "Product", "A smartphone"), ("Où", "Ville", "x")]
    assert [(r.source, r.target, r.relation) for r in graph_build.extract_relations(df).collect()] == [("Apple", "iPhone", "produces")]


def test_merges_keep_the_last_value_that_is_not_empty(spark):
    rows = [(0, 0, "c0", "A", "T1", "d1"), (1, 0, "c1", "A", "", "d2"), (2, 0, "c2", "A", "T3", ""), (2, 1, "c2", "A", "", "")]
    ent = spark.createDataFrame(rows, "chunk_seq long, pos int, chunk_id string, name string, type string, description string")
    rel = spark.createDataFrame([(0, 0, "c0", "A", "B", "x"), (1, 0, "c1", "A", "B", ""), (1, 1, "c1", "A", "B", "y")], "chunk_seq long, pos int, chunk_id string, source string, target string, relation string")
    got = {r.name: r for r in graph_build.merge_nodes(ent, rel).collect()}
    assert (got["A"].type, got["A"].description, got["A"].chunk_refs) == ("T3", "d2", ["c0", "c1", "c2", "c2"])
    assert (got["B"].type, got["B"].chunk_refs) == (None, None)
    e = graph_build.merge_edges(rel).first()
    assert (e.relation, e.chunk_refs) == ("y", ["c0", "c1", "c1"])
    assert {r.chunk_id for r in graph_build.processed_chunks(graph_build.merge_nodes(ent, rel)).collect()} == {"c0", "c1", "c2"}


def test_entity_match(spark):
    df = nodes_of(spark, ["Apple", "Apple Inc.", "Banana", "Pineapple", "Apple"])
    assert [r.name for r in graph_query.match_entities(df, ["apple"]).orderBy("term_pos", "rn").collect()] == ["Apple", "Apple Inc.", "Pineapple"]
    assert [r.name for r in graph_query.match_entities(df, ["nan", "apple"], 2).orderBy("term_pos", "rn").collect()] == ["Banana", "Apple"]
    assert graph_query.match_entities(df, []).count() == 0 and graph_query.match_entities(df, ["zzz"]).count() == 0


def plain_distances(pairs, start):
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    seen, edge = {start: 0}, [start]
    while edge:
        edge = [y for x in edge for y in sorted(near.get(x, ())) if y not in seen and not seen.update({y: seen[x] + 1})]
    return seen


@pytest.mark.parametrize("hops", [0, 1, 2, 3, 5])
def test_neighbours(spark, hops):
    pairs = [*TRIANGLES, ("f", "g"), ("g", "h"), ("h", "h"), ("x", "y"), ("b", "a")]
    got = {r.name: r.distance for r in graph_query.neighbours(edges_of(spark, pairs), nodes_of(spark, ["a"]), hops).collect()}
    assert got == {n: d for n, d in plain_distances(pairs, "a").items() if d <= hops}


def test_induced_edges_and_communities_of_seeds(spark):
    e = spark.createDataFrame([("A", "B", None), ("B", "C", "x"), ("C", "D", "y")], "source string, target string, relation string")
    assert {tuple(r) for r in graph_query.induced_edges(e, nodes_of(spark, ["A", "B", "C"])).collect()} == {("A", "B", ""), ("B", "C", "x")}
    c = spark.createDataFrame([(0, "A"), (0, "B"), (1, "C"), (1, "D"), (2, "E")], "community_id int, name string")
    assert {r.community_id for r in graph_query.communities_of(c, nodes_of(spark, ["A"])).collect()} == {0}
    assert {r.community_id for r in graph_query.communities_of(c, nodes_of(spark, ["A", "C", "E"]), 2).collect()} == {0, 1}


def test_shortest_paths(spark):
    line = [("A", "B"), ("C", "B"), ("C", "D"), ("X", "Y")]
    got = {(r.source, r.target): r.path for r in graph_query.shortest_paths(edges_of(spark, line), nodes_of(spark, ["D", "A", "X"])).collect()}
    assert got == {("A", "D"): ["A", "B", "C", "D"]}
    assert graph_query.shortest_paths(edges_of(spark, line), nodes_of(spark, ["A", "D"]), 2).count() == 0
    square = [("a", "b"), ("b", "d"), ("a", "c"), ("c", "d")]
    assert graph_query.shortest_paths(edges_of(spark, square), nodes_of(spark, ["a", "d"])).first().path == ["a", "b", "d"]
    all_pairs = {(r.source, r.target): r.length for r in graph_query.shortest_paths(edges_of(spark, TRIANGLES), nodes_of(spark, list("abcdef"))).collect()}
    assert all_pairs == {(a, b): plain_distances(TRIANGLES, a)[b] for a, b in itertools.combinations("abcdef", 2)}


@pytest.mark.parametrize("seed", range(3))
def test_shortest_paths_meet_half_way(spark, seed):
    """The least of all shortest paths, for every pair, where several lead round."""
    pick = random.Random(seed)
    names = [f"n{i:02d}" for i in range(24)]
    pairs = [tuple(pick.sample(names, 2)) for _ in range(30)]
    near = {n: {b for p in pairs for a, b in (p, p[::-1]) if a == n} for n in names}
    for most in (50, 3):
        want = {}
        for a in names[:6]:
            paths = {a: [a]}
            edge = [a]
            for _ in range(most):
                step = {}
                for n in edge:
                    for b in near[n] - set(paths):
                        step[b] = min(step.get(b, ["~"]), paths[n] + [b])
                paths |= step
                edge = list(step)
            want |= {(a, b): paths[b] for b in names[:6] if a < b and b in paths}
        got = {(r.source, r.target): r.path for r in graph_query.shortest_paths(edges_of(spark, pairs), nodes_of(spark, names[:6]), most).collect()}
        assert got == want


def test_few_names_filter_the_edges_before_they_are_made_distinct(spark):
    """What makes the edges isn't shuffled as a whole: the names' filter stands below the aggregation."""
    rows = spark.range(1000).select((F.col("id") % 50).alias("s"), (F.col("id") % 70).alias("p"))
    edges = rows.distinct().select(F.concat(F.lit("S_"), "s").alias("source"), F.concat(F.lit("P_"), "p").alias("target"), F.lit("r").alias("relation"))
    plan = graph_query._links(edges, nodes_of(spark, ["S_1"]).select(F.col("name").alias("a")))._jdf.queryExecution().optimizedPlan().toString()
    kinds = [k for line in plan.splitlines() for k in ("Aggregate", "LeftSemi") if k in line]
    assert kinds == ["Aggregate", "LeftSemi"] * 2  # from the top down
    got = {(r.a, r.b) for r in graph_query._links(edges, nodes_of(spark, ["S_1"]).select(F.col("name").alias("a"))).collect()}
    assert got == {("S_1", f"P_{i % 70}") for i in range(1000) if i % 50 == 1}
    many = graph_query.SENT_BYTES
    try:
        graph_query.SENT_BYTES = 0
        far = {r.name: r.distance for r in graph_query.neighbours(edges, nodes_of(spark, ["S_1"]), 2).collect()}
        inside = graph_query.induced_edges(edges, nodes_of(spark, ["S_1", "P_1", "P_31"])).count()
    finally:
        graph_query.SENT_BYTES = many
    assert far == {r.name: r.distance for r in graph_query.neighbours(edges, nodes_of(spark, ["S_1"]), 2).collect()}
    assert inside == graph_query.induced_edges(edges, nodes_of(spark, ["S_1", "P_1", "P_31"])).count()


def test_communities(spark):
    found = communities.detect(edges_of(spark, [*TRIANGLES, ("b", "a"), ("s", "s")]), nodes_of(spark, [*"abcdef", "lonely", "s"]))
    groups = {}
    for r in found.collect():
        groups.setdefault(r.community_id, set()).add(r.name)
    assert groups == {0: set("abc"), 1: set("def"), 2: {"lonely"}, 3: {"s"}}
    q = communities.modularity(edges_of(spark, TRIANGLES), found.where("community_id < 2")).first().modularity
    assert abs(q - 2 * (3 / 7 - 1 / 4)) < 1e-12
    empty = communities.detect(edges_of(spark, []), nodes_of(spark, ["p", "q"]))
    assert {r.name for r in empty.collect()} == {"p", "q"}
    merged = graph_build.with_communities(nodes_of(spark, ["a", "new"]), found)
    assert {r.name: r.community_id for r in merged.collect()} == {"a": 0, "new": None}


def test_star_of_two_components(spark):
    star = [("hub", f"l{i}") for i in range(6)] + [("u", "v")]
    got = communities.detect(edges_of(spark, star), nodes_of(spark, []))
    assert {r.community_id for r in got.where("name IN ('u', 'v')").collect()} == {1}


def plain_agglomeration(pairs, total, resolution):
    near = {}
    for a, b in pairs:
        near.setdefault(a, {})[b] = near.setdefault(b, {})[a] = 1.0
    degree, own = {n: float(len(x)) for n, x in near.items()}, {n: n for n in near}
    while True:
        found = [(resolution * degree[a] * degree[b] / (2.0 * total * total) - near[a][b] / total, a, b) for a in near for b in near[a] if a < b]
        if not found or min(found)[0] >= -1e-15:
            return own
        _, a, b = min(found)
        for c, w in near.pop(b).items():
            del near[c][b]
            if c != a:
                near[a][c] = near[c][a] = near[a].get(c, 0.0) + w
        degree[a] += degree.pop(b)
        own = {n: a if r == b else r for n, r in own.items()}


@pytest.mark.parametrize("seed", range(60))
def test_agglomeration_takes_the_best_pair_each_time(seed):
    pick = random.Random(seed)
    names = [f"{pick.choice('ANS')}_{i}" for i in range(pick.randint(2, 30))]
    pairs = {tuple(sorted((names[i], names[pick.randrange(min(i, pick.choice((1, 4, 30))))]))) for i in range(1, len(names)) for _ in range(pick.choice((1, 1, 3)))}
    total, resolution = len(pairs) + pick.choice((0, 0, 40)), pick.choice((1.0, 1.0, 0.5, 2.0))
    assert communities.agglomerate(list(pairs), total, resolution) == plain_agglomeration(pairs, total, resolution)


def test_a_hub_of_many_leaves_takes_time_in_proportion():
    star = [("hub", f"leaf{i}") for i in range(12_000)] + [("top", "hub")]
    start = time.process_time()
    assert set(communities.agglomerate(star, len(star)).values()) == {"hub"}
    assert time.process_time() - start < 10  # with a heap entry for each other leaf at each merge there were 72 million
