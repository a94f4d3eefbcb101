"""The engine: documents to chunks, a graph, and answers. Models are passed in; the defaults are offline and deterministic."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph import sources
from quillgraph.functions import models
from quillgraph.functions.rows import cut
from quillgraph.operators import chunking, communities, files, graph_build, graph_query, qa, vectors
from quillgraph.settings import Settings

STATE = ("documents", "chunks", "nodes", "edges", "communities")


class Engine:
    def __init__(self, spark: SparkSession, settings: Settings | None = None, embedder: models.Embedder | None = None, reranker: models.Reranker | None = None, llm: Callable[[str], str] | None = None, extractor: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None):
        self.spark, self.settings = spark, settings or Settings()
        vectors.strategy(self.settings.similarity.strategy)
        self.embedder = embedder or models.embedder(self.settings.embedding.provider)
        self.reranker = reranker or (models.reranker(self.settings.rerank.provider) if self.settings.rerank.provider else None)
        g = self.settings.graph
        if extractor is None and llm is not None and g.model_extraction:
            extractor = graph_build.model_extractor(llm, g.max_entities_per_chunk, g.max_relations_per_chunk)
        self.llm, self.extractor = llm, extractor
        self.documents = spark.createDataFrame([], "source string, text string")
        self.chunks = self.nodes = self.edges = self.communities = None

    # -------------------------------------------------------------- documents

    def load_documents(self, docs: DataFrame | dict[str, str]) -> None:
        """Adds documents; of equal sources the last loaded counts."""
        if isinstance(docs, dict):
            docs = self.spark.createDataFrame(list(docs.items()), "source string, text string")
        both = self.documents.withColumn("load_seq", F.lit(0)).unionByName(docs.select("source", "text").withColumn("load_seq", F.lit(1)))
        self.documents = files.merge_corpus(both)

    def load_file(self, path: str, source: str | None = None) -> None:
        self.load_documents(sources.read_text(self.spark, path, source))

    def chunk_documents(self, done: DataFrame | None = None) -> DataFrame:
        """Chunks of all documents; with chunks that are done already only those of other sources are made."""
        k, embed = self.settings.chunking, self.embedder.embed
        work = self.documents if done is None else files.pending(self.documents, done.select("source").distinct(), "source")
        # Written once: chunks carry embeddings, which would be made again wherever the plan is read
        made = cut(chunking.semantic_chunks(work, embed=embed, threshold=k.similarity_threshold, min_size=k.min_chunk_size, max_size=k.max_chunk_size))
        self.chunks = made if done is None else done.unionByName(made)
        return self.chunks

    # -------------------------------------------------------------- graph

    def build_graph(self, done: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """Nodes, edges and communities of the chunks; with done (chunk_id of processed chunks) only new ones are read, and what they
        hold is added to the graph there is."""
        chunks = self.chunks if self.chunks is not None else self.chunk_documents()
        if done is not None:
            chunks = files.pending(chunks, done, "chunk_id")
        chunks = chunks.select("chunk_id", F.struct("source", "chunk_seq").alias("chunk_seq"), "text")
        keys = ("chunk_id", "chunk_seq")
        entities, relations = self.extractor(chunks) if self.extractor else (graph_build.extract_entities(chunks, keys=keys), graph_build.extract_relations(chunks, keys=keys))
        nodes, edges = graph_build.merge_nodes(entities, relations), graph_build.merge_edges(relations)
        if done is not None and self.nodes is not None:
            nodes = graph_build.upsert(self.nodes, nodes, ("name",))
            edges = graph_build.upsert(self.edges, edges, ("source", "target"))
        return self.use_graph(cut(nodes), cut(edges))

    def clear_graph(self) -> None:
        self.nodes = self.edges = self.communities = None

    def use_graph(self, nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
        self.edges = edges
        self.communities = communities.detect(edges, nodes, self.settings.graph.community_resolution)
        self.nodes = graph_build.with_communities(nodes, self.communities)
        return self.nodes, self.edges

    # -------------------------------------------------------------- answers

    def retrieve(self, questions: DataFrame, top_k: int | None = None) -> DataFrame:
        """query_id, rank, chunk_id, text, source, score (and rerank_score) for each question."""
        take, keep = vectors.pick_k(top_k, self.reranker is not None, self.settings.rerank.retrieve_k, self.settings.rerank.top_k)
        embed = self.embedder.embed

        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pd.DataFrame({"query_id": pdf["query_id"], "embedding": list(embed(pdf["question"].fillna("").tolist()))})

        asked = questions.select("query_id", "question").mapInPandas(ask, "query_id long, embedding array<float>")
        chunks = self.chunks.withColumn("id", F.xxhash64("chunk_id"))
        found = vectors.best(vectors.scores(asked, chunks, "query_id", "id", "embedding", self.settings.similarity.strategy, take), take)
        both = found.join(chunks.select("id", "chunk_id", "text", "source"), "id").join(questions.select("query_id", "question"), "query_id")
        if self.reranker is None:
            return both.drop("question", "id")
        score = self.reranker.scores

        @F.pandas_udf("array<double>")
        def again(question: pd.Series, texts: pd.Series) -> pd.Series:
            out = []
            for q, t in zip(question, texts, strict=True):
                got = dict(models.rerank_all(q, list(t), score, len(t)))
                out.append([got.get(i) if got.get(i) is not None or i not in got else -float(i) for i in range(len(t))])
            return pd.Series(out)

        # The candidates of a question are few: they go to the model together, in as many calls as its limits ask for
        one = F.array_sort(F.collect_list(F.struct("rank", "chunk_id", "text", "source", "score")))
        asked = both.groupBy("query_id", "question").agg(one.alias("c")).withColumn("again", again("question", F.transform("c", lambda x: x["text"])))
        scored = asked.select("query_id", F.explode(F.arrays_zip("c", "again")).alias("x")).select("query_id", "x.c.*", F.col("x.again").alias("rerank_score"))
        # Texts of a failing call are left out; if all calls fail the first ones stay in their order
        order = Window.partitionBy("query_id").orderBy(F.desc("rerank_score"), "rank")
        ranked = scored.where("rerank_score IS NOT NULL").withColumn("new", F.row_number().over(order)).where(F.col("new") <= keep)
        return ranked.withColumn("rank", F.col("new")).drop("new")

    def graph_context(self, question: str) -> dict:
        """Entities, sub-graph, communities and paths for one question; all empty if no entity matches."""
        r = self.settings.retrieval
        empty = {"entities": [], "subgraph_nodes": [], "subgraph_edges": [], "communities": [], "paths": []}
        if self.nodes is None:
            return empty
        row = self.spark.createDataFrame([(question,)], "text string").select(qa.query_terms().alias("t")).first()
        names = [x["name"] for x in graph_query.match_entities(self.nodes, row.t, r.max_entities).orderBy("term_pos", "rn").collect()]
        if not names:
            return empty
        seeds = self.spark.createDataFrame([(n,) for n in names], "name string")
        near = graph_query.neighbours(self.edges, seeds, r.max_hops)
        inside = graph_query.communities_of(self.communities, seeds, r.max_community_results).groupBy("community_id").agg(F.array_sort(F.collect_list("name")).alias("m")).orderBy("community_id")
        return {
            "entities": names,
            "subgraph_nodes": [x["name"] for x in near.orderBy("name").collect()],
            "subgraph_edges": [x.asDict() for x in graph_query.induced_edges(self.edges, near).orderBy("source", "target").collect()],
            "communities": [x.m for x in inside.collect()],
            "paths": [x.path for x in graph_query.shortest_paths(self.edges, seeds, r.max_path_hops).orderBy("source", "target").collect()],
        }

    def query(self, question: str, top_k: int | None = None, use_cot: bool = False) -> str:
        """The answer to one question."""
        asked = self.spark.createDataFrame([(0, question)], "query_id long, question string")
        found = self.retrieve(asked, top_k).orderBy("rank").select("chunk_id", "text").collect()
        g = self.graph_context(question)
        schema = "c array<struct<chunk_id: string, text: string>>, e array<string>, r array<struct<source: string, target: string, relation: string>>, p array<array<string>>, m array<array<string>>"
        one = self.spark.createDataFrame([([tuple(x) for x in found], g["entities"], [(x["source"], x["target"], x["relation"]) for x in g["subgraph_edges"]], g["paths"], g["communities"])], schema)
        row = one.select(qa.context_string(*(F.col(x) for x in "cerpm")).alias("context"), qa.fallback_answer(F.col("e"), F.size("c")).alias("fallback")).first()
        if self.llm is None:
            return row.fallback
        how = "Think step by step, then answer." if use_cot else "Answer from the context alone."
        try:
            return models.with_retries(self.llm)(f"{how}\n\n{row.context}\n\nQuestion: {question}")
        except Exception:  # noqa: BLE001  a model's failure gives the fallback answer
            return row.fallback

    def entities_of(self, questions: DataFrame) -> DataFrame:
        """query_id, name, at: for each question what match_entities finds for its terms; at orders the names."""
        terms = questions.select("query_id", F.posexplode(qa.query_terms("question")).alias("t", "term")).groupBy("query_id", "term").agg(F.min("t").alias("t"))
        names = self.nodes.select("name", F.lower("name").alias("low"))
        # A term matches names that hold it. Terms have three characters at least: their first three meet the names' trigrams
        grams = names.where("length(low) > 2").select("name", "low", F.explode(F.expr("array_distinct(transform(sequence(1, length(low) - 2), i -> substring(low, i, 3)))")).alias("gram"))
        hits = terms.withColumn("gram", F.substring("term", 1, 3)).join(grams, "gram").where(F.contains("low", "term")).select("query_id", "t", "name").distinct()
        most = self.settings.retrieval.max_entities
        first = hits.withColumn("rn", F.row_number().over(Window.partitionBy("query_id", "t").orderBy("name"))).where(F.col("rn") <= most)
        first = first.groupBy("query_id", "name").agg(F.min(F.struct("t", "rn")).alias("at"))
        return first.withColumn("rn", F.row_number().over(Window.partitionBy("query_id").orderBy("at", "name"))).where(F.col("rn") <= most).drop("rn")

    def graph_of(self, questions: DataFrame) -> DataFrame:
        """query_id, entities, edges, paths, communities: for every question with entities what graph_context has for one."""
        r, key = self.settings.retrieval, ("query_id",)
        seeds = cut(self.entities_of(questions))
        near = cut(graph_query.neighbours(self.edges, seeds, r.max_hops, key=key))
        listed = lambda *c: F.array_sort(F.collect_list(F.struct(*c)))
        out = seeds.groupBy("query_id").agg(F.transform(listed("at", "name"), lambda x: x["name"]).alias("entities"))
        edges = graph_query.induced_edges(self.edges, near, key=key).groupBy("query_id").agg(listed("source", "target", "relation").alias("edges"))
        paths = graph_query.shortest_paths(self.edges, seeds, r.max_path_hops, key=key).groupBy("query_id").agg(F.transform(listed("source", "target", "path"), lambda x: x["path"]).alias("paths"))
        inside = graph_query.communities_of(self.communities, seeds, r.max_community_results, key=key).groupBy("query_id", "community_id").agg(F.array_sort(F.collect_list("name")).alias("m"))
        inside = inside.groupBy("query_id").agg(F.transform(listed("community_id", "m"), lambda x: x["m"]).alias("communities"))
        for part in (edges, paths, inside):
            out = out.join(part, "query_id", "left")
        return out

    def answer(self, questions: DataFrame, use_cot: bool = False) -> DataFrame:
        """Answers of many questions (query_id, question) in one plan: retrieval and the graph's context for all of them, and the
        model (or the fallback answer) on Arrow batches."""
        found = self.retrieve(questions)
        per = found.groupBy("query_id").agg(F.count("*").alias("n_chunks"), F.array_sort(F.collect_list(F.struct("rank", "chunk_id", "text"))).alias("c"))
        rows = questions.join(per, "query_id", "left")
        kinds = {"entities": "array<string>", "edges": "array<struct<source: string, target: string, relation: string>>", "paths": "array<array<string>>", "communities": "array<array<string>>"}
        if self.nodes is None:
            rows = rows.withColumns({k: F.lit(None).cast(v) for k, v in kinds.items()})
        else:
            rows = rows.join(self.graph_of(questions), "query_id", "left")
        rows = rows.withColumns({**{k: F.coalesce(k, F.array().cast(v)) for k, v in kinds.items()}, "n_chunks": F.coalesce("n_chunks", F.lit(0))})
        rows = rows.withColumn("answer", qa.fallback_answer(F.col("entities"), F.col("n_chunks")))
        if self.llm is not None:
            call = models.with_retries(self.llm)
            how = "Think step by step, then answer." if use_cot else "Answer from the context alone."
            chunks = F.coalesce(F.transform("c", lambda x: F.struct(x["chunk_id"].alias("chunk_id"), x["text"].alias("text"))), F.array().cast("array<struct<chunk_id: string, text: string>>"))
            context = qa.context_string(chunks, *(F.col(k) for k in kinds))

            @F.pandas_udf("string")
            def ask(context: pd.Series, question: pd.Series, fallback: pd.Series) -> pd.Series:
                out = []
                for c, q, f in zip(context, question, fallback, strict=True):
                    try:
                        out.append(call(f"{how}\n\n{c}\n\nQuestion: {q}"))
                    except Exception:  # noqa: BLE001
                        out.append(f)
                return pd.Series(out)

            rows = rows.withColumn("answer", ask(context, "question", "answer"))
        sizes = [F.size(k).alias(f"n_{k}") for k in kinds]
        return rows.select("query_id", "question", "n_chunks", *sizes, "answer")

    def run_batch(self, dataset: DataFrame, save: Callable[[DataFrame], None], prior: DataFrame | None = None, offset: int = 0, limit: int | None = None, use_cot: bool | None = None) -> dict:
        """batch_query in steps of settings.batch.save_interval rows: after each step save() gets its answers, and after
        max_consecutive_failures failed rows in a row (over steps as well) no further step is taken. Returns totals."""
        use_cot = self.settings.batch.use_cot if use_cot is None else use_cot
        b, n = self.settings.batch, dataset.agg(F.max("row_idx")).first()[0]
        stop = (n + 1 if n is not None else 0) if limit is None else min(offset + limit, (n if n is not None else -1) + 1)
        done = {"rows": 0, "answered": 0, "failed": 0, "stopped": False}
        run = 0
        for at in range(offset, stop, b.save_interval):
            upto = min(stop, at + b.save_interval)
            step = cut(self.batch_query(dataset, prior, at, upto - at, use_cot).where((F.col("row_idx") >= at) & (F.col("row_idx") < upto)))
            save(step)
            flags = [r.failed for r in step.select("failed", "row_idx").orderBy("row_idx").collect()]  # save_interval rows at most
            done["rows"] += len(flags)
            done["failed"] += sum(flags)
            done["answered"] += step.where("answer <> ''").count()
            for failed in flags:
                run = run + 1 if failed else 0
                if run >= b.max_consecutive_failures:
                    return done | {"stopped": True}
        return done

    def batch_query(self, dataset: DataFrame, prior: DataFrame | None = None, offset: int = 0, limit: int | None = None, use_cot: bool = False) -> DataFrame:
        """dataset: row_idx, question; prior: question, answer, line. Answers of the rows from offset on (at most limit) that
        have none yet; fallback answers and empty questions leave an empty answer and count as failed."""
        none = self.spark.createDataFrame([], "question string, answer string, line long")
        rows = qa.resume(dataset, prior if prior is not None and self.settings.batch.resume else none)
        work = qa.worklist(rows, offset, limit).where(F.coalesce("question", F.lit("")) != "")
        got = self.answer(work.select(F.col("row_idx").alias("query_id"), "question"), use_cot).select(F.col("query_id").alias("row_idx"), F.when(qa.is_fallback(F.col("answer")) | (F.col("answer") == qa.NOT_FOUND), F.lit("")).otherwise(F.col("answer")).alias("new"))
        out = rows.join(got, "row_idx", "left").withColumn("failed", F.coalesce(F.col("new") == "", F.lit(False)))
        return out.select("row_idx", "question", F.coalesce(F.nullif("new", F.lit("")), "answer").alias("answer"), "failed")

    # -------------------------------------------------------------- state

    def get_statistics(self) -> dict:
        return graph_build.statistics(self.documents, self.chunks, self.nodes, self.edges, self.communities, self.reranker is not None).first().asDict()

    def export_graph(self, path: str) -> None:
        with open(path, "wb") as f:
            f.write(sources.to_gexf(self.nodes, self.edges))

    def save(self, path: str) -> None:
        sources.write_state({n: getattr(self, n) for n in STATE}, path)

    def load(self, path: str) -> None:
        for name, df in sources.read_state(self.spark, path, STATE).items():
            setattr(self, name, df)
