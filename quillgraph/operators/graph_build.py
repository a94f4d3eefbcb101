"""Knowledge-graph build: rule extraction, merges, statistics and a property graph from relational tables."""

from __future__ import annotations

import time

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The marks of entities (name - type - description) and relations [a -> b: label] in a text.
ENTITY = r"(?sU)\((\w+)\s*-\s*(\w+)\s*-\s*(.+?)\)"
RELATION = r"(?sU)\[(\w+)\s*->\s*(\w+)\s*:\s*(.+?)\]"


def _marks(chunks: DataFrame, pattern: str, names: tuple[str, str, str], text: str, keys: list[str]) -> DataFrame:
    parts = [F.regexp_extract_all(text, F.lit(pattern), F.lit(i)).alias(n) for i, n in enumerate(names, 1)]
    df = chunks.select(*keys, F.posexplode(F.arrays_zip(*parts)).alias("pos", "m"))
    from quillgraph.functions.text import strip

    return df.select(*keys, "pos", F.col(f"m.{names[0]}").alias(names[0]), F.col(f"m.{names[1]}").alias(names[1]), strip(F.col(f"m.{names[2]}")).alias(names[2]))


def extract_entities(chunks: DataFrame, text: str = "text", keys: tuple[str, ...] = ("chunk_id",)) -> DataFrame:
    return _marks(chunks, ENTITY, ("name", "type", "description"), text, list(keys))


def extract_relations(chunks: DataFrame, text: str = "text", keys: tuple[str, ...] = ("chunk_id",)) -> DataFrame:
    return _marks(chunks, RELATION, ("source", "target", "relation"), text, list(keys))


def _last(column: str, order):
    """The last value that isn't empty, in the order given."""
    return F.max_by(F.nullif(F.col(column), F.lit("")), F.when(F.col(column) != "", order))


def _refs(order):
    return F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("chunk_id").alias("c")))), lambda x: x["c"])


def merge_nodes(entities: DataFrame, relations: DataFrame | None = None) -> DataFrame:
    """entities: chunk_seq, pos, chunk_id, name, type, description. One row per name: the last type and description that
    aren't empty, and all chunk references in order, repeats kept. Ends of relations become bare nodes. A reference is two
    numbers and an id: what a node gathers is its own list, which is what is stored."""
    order = F.struct("chunk_seq", "pos")
    nodes = entities.groupBy("name").agg(_last("type", order).alias("type"), _last("description", order).alias("description"), _refs(order).alias("chunk_refs"))
    if relations is None:
        return nodes
    ends = relations.select(F.col("source").alias("name")).union(relations.select(F.col("target").alias("name"))).distinct()
    bare = ends.join(nodes.select("name"), "name", "left_anti").select("name", *[F.lit(None).cast("string").alias(c) for c in ("type", "description")], F.lit(None).cast("array<string>").alias("chunk_refs"))
    return nodes.unionByName(bare)


def merge_edges(relations: DataFrame) -> DataFrame:
    """One row per ordered (source, target): the last label and description that aren't empty, references in order."""
    order = F.struct("chunk_seq", "pos")
    if "description" not in relations.columns:
        relations = relations.withColumn("description", F.lit(""))
    return relations.groupBy("source", "target").agg(_last("relation", order).alias("relation"), _last("description", order).alias("description"), _refs(order).alias("chunk_refs"))


def upsert(stored: DataFrame, new: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Stored nodes or edges with those of a later build: of every other column the later value counts unless it is empty, chunk
    references of the later build follow those stored."""
    texts = [c for c in new.columns if c not in (*key, "chunk_refs")]
    both = stored.select(*new.columns, F.lit(0).alias("build")).unionByName(new.withColumn("build", F.lit(1)))
    refs = F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col("chunk_refs").isNotNull(), F.struct("build", "chunk_refs")))), lambda x: x["chunk_refs"]))
    out = both.groupBy(*key).agg(*[_last(c, F.col("build")).alias(c) for c in texts], refs.alias("chunk_refs"))
    return out.select(*key, *texts, F.when(F.size("chunk_refs") > 0, F.col("chunk_refs")).alias("chunk_refs"))


#: How much of a chunk a model reads, and how often it is asked.
MODEL_CHARS, MODEL_TRIES = 4_000, 3
_REPLY = "entities array<struct<name: string, type: string, description: string>>, relations array<struct<source: string, target: string, relation: string, description: string>>"
_ASK = 'List the entities and relations of the text as JSON: {"entities": [{"name", "type", "description"}], "relations": [{"source", "target", "relation", "description"}]}.'


def model_extractor(llm, max_entities: int | None = None, max_relations: int | None = None, wait=None):
    """An extractor that asks a model about each chunk and takes the marks in the text where it fails or its reply can't be read."""

    def extract(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
        from quillgraph.functions.models import with_retries
        from quillgraph.functions.rows import cut
        from quillgraph.functions.text import strip_fences

        call = with_retries(llm, MODEL_TRIES, wait or time.sleep)

        @F.pandas_udf("string")
        def ask(texts: pd.Series) -> pd.Series:
            out = []
            for t in texts:
                try:
                    out.append(call(f"{_ASK}\n\n{(t or '')[:MODEL_CHARS]}"))
                except Exception:  # noqa: BLE001  the marks in the text take its place
                    out.append(None)
            return pd.Series(out, dtype=object)

        read = cut(chunks.withColumn("reply", F.from_json(strip_fences(F.regexp_extract(ask("text"), r"(?s)\{.*\}", 0)), _REPLY)))
        bad = F.col("reply").isNull() | (F.col("reply.entities").isNull() & F.col("reply.relations").isNull())
        keys, left = ("chunk_id", "chunk_seq"), read.where(bad).drop("reply")

        def rows(part: str, most: int | None, names: tuple[str, ...]) -> DataFrame:
            listed = F.col(f"reply.{part}") if most is None else F.slice(f"reply.{part}", 1, most)
            df = read.where(~bad).select(*keys, F.posexplode(listed).alias("pos", "m"))
            return df.select(*keys, "pos", *[F.coalesce(F.col(f"m.{n}"), F.lit("")).alias(n) for n in names])

        entities = rows("entities", max_entities, ("name", "type", "description")).where("name <> ''")
        relations = rows("relations", max_relations, ("source", "target", "relation", "description")).where("source <> '' AND target <> ''")
        return entities.unionByName(extract_entities(left, keys=keys)), relations.unionByName(extract_relations(left, keys=keys), allowMissingColumns=True)

    return extract


def processed_chunks(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.explode("chunk_refs").alias("chunk_id")).distinct()


def with_communities(nodes: DataFrame, communities: DataFrame) -> DataFrame:
    return nodes.drop("community_id").join(communities.select("name", "community_id"), "name", "left")


def statistics(documents: DataFrame, chunks: DataFrame, nodes: DataFrame, edges: DataFrame, communities: DataFrame, rerank: bool = False) -> DataFrame:
    count = lambda df, name: df.agg(F.count("*").alias(name))
    out = count(documents, "documents")
    for df, name in ((chunks, "chunks"), (nodes, "graph_nodes"), (edges, "graph_edges")):
        out = out.join(count(df, name))  # one row each
    return out.join(communities.agg(F.countDistinct("community_id").alias("communities"))).withColumn("rerank", F.lit(rerank))


def star_nodes(tables: dict[str, DataFrame], small: bool = False) -> DataFrame:
    """Nodes of the property graph over the star schema; the small graph has regions, nations and suppliers."""
    made = [
        tables["region"].select(F.concat(F.lit("R_"), "r_regionkey").alias("name"), F.lit("region").alias("type"), F.col("r_name").alias("description")),
        tables["nation"].select(F.concat(F.lit("N_"), "n_nationkey").alias("name"), F.lit("nation").alias("type"), F.col("n_name").alias("description")),
        tables["supplier"].select(F.concat(F.lit("S_"), "s_suppkey").alias("name"), F.lit("supplier").alias("type"), F.col("s_name").alias("description")),
    ]
    if not small:
        made += [
            tables["customer"].select(F.concat(F.lit("C_"), "c_custkey").alias("name"), F.lit("customer").alias("type"), F.col("c_name").alias("description")),
            tables["part"].select(F.concat(F.lit("P_"), "p_partkey").alias("name"), F.lit("part").alias("type"), F.col("p_name").alias("description")),
        ]
    out = made[0]
    for df in made[1:]:
        out = out.unionByName(df)
    return out


def star_edges(tables: dict[str, DataFrame], small: bool = False) -> DataFrame:
    edge = lambda df, a, b, label: df.select(a.alias("source"), b.alias("target"), F.lit(label).alias("relation"))
    node = lambda prefix, c: F.concat(F.lit(prefix), F.col(c))
    out = edge(tables["nation"], node("N_", "n_nationkey"), node("R_", "n_regionkey"), "in_region")
    out = out.unionByName(edge(tables["supplier"], node("S_", "s_suppkey"), node("N_", "s_nationkey"), "located_in"))
    if small:
        return out
    out = out.unionByName(edge(tables["customer"], node("C_", "c_custkey"), node("N_", "c_nationkey"), "located_in"))
    supplies = tables["lineitem"].select("l_suppkey", "l_partkey").distinct()
    return out.unionByName(edge(supplies, node("S_", "l_suppkey"), node("P_", "l_partkey"), "supplies"))
