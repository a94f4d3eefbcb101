"""Graph retrieval: entity match, neighbourhoods, induced sub-graphs, communities and shortest paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.rows import cut


def match_entities(nodes: DataFrame, terms: list[str], max_entities: int = 10, name: str = "name") -> DataFrame:
    """Names that contain a term, without regard to case: for each term the first max_entities in order of name, terms in
    their order, first seen counts, cut to max_entities. The terms of a question are few and go into the expression."""
    names = nodes.select(name).distinct()
    hits = names.withColumn("t", F.explode(F.array(*[F.when(F.contains(F.lower(name), F.lit(t.lower())), F.lit(i)) for i, t in enumerate(terms)]) if terms else F.array().cast("array<int>")))
    hits = hits.where("t IS NOT NULL")
    # The first max_entities of a term: smallest names are taken within partitions before they meet
    w = Window.partitionBy("t").orderBy(name)
    first = hits.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= max_entities)
    return first.groupBy(name).agg(F.min(F.struct("t", "rn")).alias("at")).orderBy("at").limit(max_entities).select(name, F.col("at.t").alias("term_pos"), F.col("at.rn").alias("rn"))


def both_ways(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.col("source").alias("a"), F.col("target").alias("b")).where("a <> b")
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


#: Names are sent to all tasks up to this size in memory; more are joined by shuffles.
SENT_BYTES = 64 << 20


def _few(names: DataFrame, name: str) -> bool:
    """Whether the (materialised) names can be sent to all tasks: their bytes and about 80 for a row of a hash table."""
    row = names.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(name)), F.lit(0)).alias("b")).first()
    return row.n * 80 + row.b <= SENT_BYTES


def _links(edges: DataFrame, names: DataFrame) -> DataFrame:
    """a, b: undirected edges that start at one of the names (column a, materialised); an edge may repeat. Few names are a filter, which
    Spark moves below what makes the edges, so that neither all edges are made distinct nor shuffled."""
    few, out = _few(names, "a"), None
    for one, other in (("source", "target"), ("target", "source")):
        way = edges.where("source <> target").select(F.col(one).alias("a"), F.col(other).alias("b"))
        way = way.join(F.broadcast(names), "a", "left_semi") if few else way
        out = way if out is None else out.unionByName(way)
    return out


def neighbours(edges: DataFrame, seeds: DataFrame, hops: int = 2, name: str = "name", key: tuple[str, ...] = ()) -> DataFrame:
    """Nodes within so many undirected hops of any seed, with their distance; with a key (columns of seeds) for each value of it.
    Each hop joins the frontier alone, and what it finds was seen in the last two hops or never."""
    frontier = cut(seeds.select(*key, F.col(name).alias("name")).distinct())
    levels, seen = [frontier.withColumn("distance", F.lit(0))], frontier
    for hop in range(1, hops + 1):
        links = _links(edges, cut(frontier.select(F.col("name").alias("a")).distinct()))
        found = frontier.join(links, frontier["name"] == links["a"]).select(*key, F.col("b").alias("name")).distinct()
        found = cut(found.join(seen, [*key, "name"], "left_anti"))
        levels.append(found.withColumn("distance", F.lit(hop)))
        seen, frontier = frontier.unionByName(found), found
    return reduce(DataFrame.unionByName, levels)


def induced_edges(edges: DataFrame, nodes: DataFrame, name: str = "name", key: tuple[str, ...] = ()) -> DataFrame:
    """Edges with both ends among the (distinct) nodes, of each key; a null label becomes empty."""
    n = cut(nodes.select(*key, F.col(name).alias("n")))
    names = cut(n.select("n").distinct()) if key else n
    few = _few(names, "n")
    inside = edges
    for end in ("source", "target"):
        if few or not key:
            inside = inside.join(F.broadcast(names) if few else names, F.col(end) == F.col("n"), "left_semi")
    if key:
        inside = inside.join(n.withColumnRenamed("n", "source"), "source").join(n.withColumnRenamed("n", "target"), [*key, "target"])
    return inside.select(*key, "source", "target", F.coalesce("relation", F.lit("")).alias("relation"))


def communities_of(communities: DataFrame, seeds: DataFrame, limit: int = 5, name: str = "name", key: tuple[str, ...] = ()) -> DataFrame:
    """Members of the first communities (in order of id) that hold a seed, of each key."""
    ids = communities.join(seeds.select(*key, name), name).select(*key, "community_id").distinct()
    if key:
        ids = ids.withColumn("rn", F.row_number().over(Window.partitionBy(*key).orderBy("community_id"))).where(F.col("rn") <= limit).drop("rn")
        return communities.join(ids, "community_id").select(*key, "community_id", F.col(name).alias("name"))
    return communities.join(F.broadcast(ids.orderBy("community_id").limit(limit)), "community_id", "left_semi")  # at most `limit` ids


def shortest_paths(edges: DataFrame, seeds: DataFrame, max_hops: int = 50, name: str = "name", key: tuple[str, ...] = ()) -> DataFrame:
    """One shortest undirected path (the lexicographically smallest) for each pair of seeds source < target (of one key) that is
    connected by 1 to max_hops hops. A search from all seeds at once, in which the two of a pair meet half-way: after r steps from each
    seed all pairs at up to 2 r hops are found. A step keeps for each (seed, node) the least path from the seed and the least one to it:
    the least path through a node is the least one to it and then the least one on. A seed goes on while a pair of its is open."""
    start = cut(seeds.select(*key, F.col(name).alias("source")).distinct())
    ends = start.withColumnRenamed("source", "target")
    wanted = start.join(ends, list(key)) if key else start.join(ends, F.col("source") < F.col("target"))  # pairs of the seeds of one question
    wanted = cut(wanted.where("source < target").select("source", "target").distinct())
    found = edges.sparkSession.createDataFrame([], "source string, target string, path array<string>")

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        """The least path of each open pair by way of a node that both have reached."""
        here = left.select(F.col("seed").alias("source"), "node", "there").join(wanted, "source")
        both = here.join(right.select(F.col("seed").alias("target"), "node", "back"), ["target", "node"])
        return cut(both.groupBy("source", "target").agg(F.min(F.concat("there", F.slice("back", 2, max_hops))).alias("path")))

    def seeds_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("source", "target")).alias("seed")).distinct()

    last = cut(seeds_of(wanted).select("seed", F.col("seed").alias("node"), F.array("seed").alias("there"), F.array("seed").alias("back")))
    seen = last.select("seed", "node")
    for half in range(1, (max_hops + 1) // 2 + 1):
        if last.isEmpty():
            break
        links = _links(edges, cut(last.select(F.col("node").alias("a")).distinct()))
        step = last.join(links, F.col("node") == F.col("a")).select("seed", F.col("b").alias("node"), F.concat("there", F.array("b")).alias("there"), F.concat(F.array("b"), "back").alias("back"))
        # What a step finds was seen in the last two steps or never
        best = step.groupBy("seed", "node").agg(F.min("there").alias("there"), F.min("back").alias("back")).join(seen, ["seed", "node"], "left_anti")
        new = cut(best)
        for hops, other in ((2 * half - 1, last), (2 * half, new)):
            if hops <= max_hops:
                paths = met(new, other)
                found = found.unionByName(paths)
                wanted = cut(wanted.join(paths.select("source", "target"), ["source", "target"], "left_anti"))
        for end in ("source", "target"):  # a seed that reaches nothing new has no further partner
            wanted = wanted.join(new.select(F.col("seed").alias(end)).distinct(), end, "left_semi")
        wanted = cut(wanted.select("source", "target"))
        seen = last.select("seed", "node").unionByName(new.select("seed", "node"))
        last = new.join(seeds_of(wanted), "seed", "left_semi")
    found = found.select("source", "target", (F.size("path") - 1).alias("length"), "path")
    if not key:
        return found
    return start.join(ends, list(key)).where("source < target").join(found, ["source", "target"]).select(*key, "source", "target", "length", "path")
