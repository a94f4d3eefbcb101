"""All registered queries of the reference's operators, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillgraph.functions import text as T
from quillgraph.operators import chunking, communities, convert, files, graph_build, graph_query, noise, preprocess, qa, quality, vectors
from quillgraph.plans.tables import answered, cleaned, marked_chunks, star, table

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Registers a query, and its oracle where SQL can express it."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


# ------------------------------------------------------------------ quality

_SP = T.SPACE
_QUALITY = rf"""
l AS (SELECT doc_id, text, CASE WHEN list_last(a) = '' THEN a[:-2] ELSE a END AS lines FROM (SELECT doc_id, coalesce(text, '') AS text, string_split_regex(coalesce(text, ''), '{T.LINE_BREAK}') AS a FROM documents)),
f AS (SELECT *, list_filter(lines, lambda x: regexp_matches(x, '[^{_SP}]')) AS nb FROM l),
m AS (
  SELECT doc_id, text, length(text)::INT AS char_count, len(lines)::INT AS line_count,
    (length(text) - length(regexp_replace(text, '{T.CJK}', '', 'g')))::INT AS chinese_char_count, len(nb)::INT AS nonblank_lines,
    len(list_filter(nb, lambda x: starts_with(regexp_replace(x, '^[{_SP}]+', ''), '#')))::INT AS section_count,
    contains(substr(text, 1, 500), '目') AS has_toc,
    CASE WHEN length(text) = 0 THEN 0 ELSE (length(text) - length(regexp_replace(text, '{T.CJK}', '', 'g'))) / length(text)::DOUBLE END AS chinese_ratio,
    CASE WHEN length(text) = 0 THEN 0 ELSE (length(text) - length(regexp_replace(text, '{T.BOX_DRAWING}', '', 'g'))) / length(text)::DOUBLE END AS special_char_ratio,
    CASE WHEN len(lines) = 0 THEN 0 ELSE 1 - len(nb) / len(lines)::DOUBLE END AS empty_line_ratio,
    CASE WHEN len(nb) = 0 THEN 0 ELSE list_sum(list_transform(nb, lambda x: length(x))) / len(nb)::DOUBLE END AS avg_line_length,
    CASE WHEN len(nb) = 0 THEN 0 ELSE len(list_filter(nb, lambda x: length(x) < 10)) / len(nb)::DOUBLE END AS short_line_ratio,
    CASE WHEN len(nb) = 0 THEN 0 ELSE len(list_filter(nb, lambda x: length(x) > 200)) / len(nb)::DOUBLE END AS long_line_ratio,
    CASE WHEN len(nb) = 0 THEN 0 ELSE 1 - len(list_distinct(nb)) / len(nb)::DOUBLE END AS repetition_line_ratio
  FROM f),
s AS (
  SELECT *, 0.25::DOUBLE * least(1.0::DOUBLE, char_count / 5000::DOUBLE) + 0.15::DOUBLE * least(1.0::DOUBLE, chinese_ratio / 0.5::DOUBLE) + 0.15::DOUBLE * least(1.0::DOUBLE, section_count / 5::DOUBLE)
    + 0.10::DOUBLE * (1 - least(1.0::DOUBLE, short_line_ratio)) + 0.15::DOUBLE * (1 - least(1.0::DOUBLE, special_char_ratio * 500)) + 0.10::DOUBLE * (1 - least(1.0::DOUBLE, repetition_line_ratio * 5))
    + 0.10::DOUBLE * (1 - least(1.0::DOUBLE, empty_line_ratio * 2)) AS quality_score FROM m),
q AS (SELECT *, CASE WHEN quality_score >= 0.8::DOUBLE THEN '优' WHEN quality_score >= 0.6::DOUBLE THEN '良' WHEN quality_score >= 0.4::DOUBLE THEN '中' ELSE '差' END AS quality_level FROM s),
r AS (
  SELECT *, nullif(array_to_string(list_filter([
    CASE WHEN char_count < 200 THEN format('too_short({{}}<200)', char_count) END,
    CASE WHEN round(special_char_ratio, 6) > 0.001 THEN format('high_garbled({{:.4f}}>0.001)', round(special_char_ratio, 6)) END,
    CASE WHEN round(quality_score, 4) < 0.4 THEN format('low_quality({{:.2f}}<0.4)', round(quality_score, 4)) END,
    CASE WHEN round(repetition_line_ratio, 4) > 0.5 THEN format('high_repetition({{:.2f}}>0.5)', round(repetition_line_ratio, 4)) END], lambda x: x IS NOT NULL), ';'), '') AS filter_reason
  FROM q)
"""
_METRICS = ("char_count", "line_count", "chinese_char_count", "nonblank_lines", "section_count", "has_toc", "chinese_ratio", "special_char_ratio", "empty_line_ratio", "avg_line_length", "short_line_ratio", "long_line_ratio", "repetition_line_ratio")


def _scored(spark, sf):
    return quality.score(quality.metrics(table(spark, sf, "documents")))


def _judged(spark, sf):
    return quality.filter_reasons(_scored(spark, sf), min_chinese_ratio=0.0)


@query("quality_metrics", f"WITH {_QUALITY} SELECT doc_id, {', '.join(_METRICS)} FROM m")
def quality_metrics(spark, sf):
    return quality.metrics(table(spark, sf, "documents")).select("doc_id", *_METRICS)


@query("quality_score", f"WITH {_QUALITY} SELECT doc_id, quality_score, quality_level FROM q")
def quality_score(spark, sf):
    return _scored(spark, sf).select("doc_id", "quality_score", "quality_level")


@query("quality_level_hist", f"WITH {_QUALITY} SELECT v AS quality_level, count(q.doc_id) AS n, count(q.doc_id) * 100 / (SELECT count(*) FROM q)::DOUBLE AS pct FROM (VALUES ('优'), ('良'), ('中'), ('差')) t(v) LEFT JOIN q ON q.quality_level = v GROUP BY v")
def quality_level_hist(spark, sf):
    return quality.levels(_scored(spark, sf))


@query("quality_summary", f"WITH {_QUALITY} SELECT count(*) AS total, round(avg(quality_score), 9) AS avg_score, max(quality_score) AS max_score, min(quality_score) AS min_score FROM q")
def quality_summary(spark, sf):
    return quality.summary(_scored(spark, sf)).withColumn("avg_score", F.round("avg_score", 9))


@query("quality_filter_reasons", f"WITH {_QUALITY} SELECT doc_id, filter_reason FROM r WHERE filter_reason IS NOT NULL")
def quality_filter_reasons(spark, sf):
    return quality.split(_judged(spark, sf))[1].select("doc_id", "filter_reason")


_DEFAULTS = _QUALITY.replace("    CASE WHEN round(special_char_ratio, 6)", "    CASE WHEN round(chinese_ratio, 4) < 0.01 THEN format('low_chinese_ratio({:.2f}<0.01)', round(chinese_ratio, 4)) END,\n    CASE WHEN round(special_char_ratio, 6)")


@query("quality_filter_defaults", f"WITH {_DEFAULTS} SELECT doc_id, filter_reason FROM r WHERE filter_reason IS NOT NULL")
def quality_filter_defaults(spark, sf):
    return quality.split(quality.filter_reasons(_scored(spark, sf)))[1].select("doc_id", "filter_reason")


@query("quality_pass_ids", f"WITH {_QUALITY} SELECT doc_id FROM r WHERE filter_reason IS NULL")
def quality_pass_ids(spark, sf):
    judged = _judged(spark, sf)
    return quality.passed(judged, quality.split(judged)[1]).select("doc_id")


@query("quality_excluded_ids", f"WITH {_QUALITY} SELECT doc_id FROM r WHERE filter_reason IS NOT NULL")
def quality_excluded_ids(spark, sf):
    return quality.split(_judged(spark, sf))[1].select("doc_id")


@query("quality_vs_labels", f"WITH {_QUALITY} SELECT quality, filter_reason IS NULL AS passed, count(*) AS n FROM r JOIN labels USING (doc_id) GROUP BY ALL")
def quality_vs_labels(spark, sf):
    return _judged(spark, sf).select("doc_id", "filter_reason").join(table(spark, sf, "labels"), "doc_id").groupBy("quality", F.col("filter_reason").isNull().alias("passed")).agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ tokens, noise, comparison

def _tokens(text: str) -> str:
    rest = f"length(regexp_replace({text}, '{T.CJK}', '', 'g'))"
    return f"floor((length({text}) - {rest}) * 1.5 + {rest} * 0.25)::INT"



@query("token_estimate", f"SELECT doc_id, {_tokens('text')} AS tokens FROM documents")
def token_estimate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.estimate_tokens("text").alias("tokens"))


@query("token_cost_dry_run", f"WITH t AS (SELECT {_tokens('text')} AS n FROM documents), a AS (SELECT count(*) AS files, sum(n)::BIGINT AS input_tokens, sum(floor(n * 0.4::DOUBLE))::BIGINT AS output_tokens FROM t) SELECT *, input_tokens / 1e6::DOUBLE * 1.0::DOUBLE + output_tokens / 1e6::DOUBLE * 2.0::DOUBLE AS cost_yuan FROM a")
def token_cost_dry_run(spark, sf):
    return noise.dry_run(table(spark, sf, "documents"))


_NOISE_FIELDS = ("total_chars", "chinese_chars", "chinese_ratio", "total_lines", "non_empty_lines", "empty_lines", "empty_line_ratio", "h1_count", "h2_count", "h3_count", "total_headings", "table_rows", "garbled_chars", "yi_syllables", "ics_spacing_noise", "pagebreak_noise", "img_placeholder_noise", "total_noise")


def _noise_sql(source: str, key: str, text: str) -> str:
    count = lambda pattern: f"len(regexp_extract_all({text}, '{pattern}'))::INT"
    removed = lambda cls: f"(length({text}) - length(regexp_replace({text}, '{cls}', '', 'g')))::INT"
    return rf"""
  SELECT *, total_lines - empty_lines AS non_empty_lines, h1_count + h2_count + h3_count AS total_headings, garbled_chars + yi_syllables + ics_spacing_noise + pagebreak_noise + img_placeholder_noise AS total_noise FROM (
  SELECT {key}, {text} AS body, length({text})::INT AS total_chars, {removed(T.CJK)} AS chinese_chars,
    CASE WHEN length({text}) > 0 THEN round({removed(T.CJK)} / length({text})::DOUBLE, 4) ELSE 0 END AS chinese_ratio,
    len(string_split({text}, chr(10)))::INT AS total_lines,
    len(list_filter(string_split({text}, chr(10)), lambda x: NOT regexp_matches(x, '[^{_SP}]')))::INT AS empty_lines,
    round(len(list_filter(string_split({text}, chr(10)), lambda x: NOT regexp_matches(x, '[^{_SP}]'))) / len(string_split({text}, chr(10)))::DOUBLE, 4) AS empty_line_ratio,
    {count('(?m)^#[' + _SP + ']')} AS h1_count, {count('(?m)^##[' + _SP + ']')} AS h2_count, {count('(?m)^###[' + _SP + ']')} AS h3_count,
    {count('(?m)^[|].*[|]$')} AS table_rows, {removed(T.BOX_DRAWING)} AS garbled_chars, {removed(T.YI)} AS yi_syllables, {count('I C S')} AS ics_spacing_noise,
    {count('(?i)---[' + _SP + ']*pagebreak')} AS pagebreak_noise, {count('<!--.*?-->')} AS img_placeholder_noise FROM {source})"""


@query("noise_profile", f"WITH p AS ({_noise_sql('documents', 'doc_id', 'text')}) SELECT doc_id, {', '.join(_NOISE_FIELDS)} FROM p")
def noise_profile(spark, sf):
    return noise.profile(table(spark, sf, "documents")).select("doc_id", *_NOISE_FIELDS)


@query("noise_profile_pages", f"WITH p AS ({_noise_sql('pages', 'page_id', 'html')}) SELECT page_id, {', '.join(_NOISE_FIELDS)} FROM p")
def noise_profile_pages(spark, sf):
    return noise.profile(table(spark, sf, "pages"), "html").select("page_id", *_NOISE_FIELDS)


_COMPARED = rf"""
c AS (SELECT doc_id, regexp_replace(text, '[\x09-\x0d\x20]+', ' ', 'g') AS text FROM documents WHERE length(text) >= 200 UNION ALL SELECT -1, 'extra'),
po AS ({_noise_sql('documents', 'doc_id', 'text')}), pc AS ({_noise_sql('c', 'doc_id', 'text')}),
b AS (
  SELECT po.doc_id, {', '.join(f"{p}.{e} AS {side}_{n}" for p, side in (('po', 'orig'), ('pc', 'comp')) for n, e in (('total_noise', 'total_noise'), ('total_headings', 'total_headings'), ('chinese_ratio', 'chinese_ratio'), ('empty_line_ratio', 'empty_line_ratio'), ('table_rows', 'table_rows')))},
    octet_length(encode(po.body))::INT AS orig_size_bytes, octet_length(encode(pc.body))::INT AS comp_size_bytes, {_tokens('po.body')} AS orig_tokens, {_tokens('pc.body')} AS comp_tokens
  FROM po JOIN pc ON po.doc_id = pc.doc_id),
d AS (
  SELECT *, CASE WHEN orig_tokens > 0 THEN round(comp_tokens / orig_tokens::DOUBLE, 4) ELSE 0 END AS token_ratio, CASE WHEN orig_size_bytes > 0 THEN round(comp_size_bytes / orig_size_bytes::DOUBLE, 4) ELSE 0 END AS size_ratio,
    comp_tokens - orig_tokens AS tokens_change, comp_size_bytes - orig_size_bytes AS size_change, comp_total_noise - orig_total_noise AS noise_change, comp_total_headings - orig_total_headings AS heading_change,
    round(comp_chinese_ratio - orig_chinese_ratio, 4) AS chinese_ratio_change FROM b)
"""


def _compared(spark, sf):
    docs = table(spark, sf, "documents")
    return noise.compare(docs, cleaned(docs))


@query("compare_files", f"WITH {_COMPARED} SELECT * FROM d")
def compare_files(spark, sf):
    return _compared(spark, sf)


def _averages() -> str:
    out = []
    for column, name, k in (("chinese_ratio", "chinese_ratio", 4), ("empty_line_ratio", "empty_line_ratio", 4), ("total_headings", "headings", 2), ("table_rows", "table_rows", 2), ("total_noise", "noise", 2)):
        out += [f"round(sum(orig_{column})::DOUBLE / count(*), {k}) AS avg_orig_{name}", f"round(sum(comp_{column})::DOUBLE / count(*), {k}) AS avg_comp_{name}", f"round((sum(comp_{column}) - sum(orig_{column}))::DOUBLE / count(*), {k}) AS avg_{name}_change"]
    return ", ".join(out)


@query("compare_summary", f"WITH {_COMPARED} SELECT count(*) AS total_files, sum(orig_tokens)::BIGINT AS total_orig_tokens, sum(comp_tokens)::BIGINT AS total_comp_tokens, (sum(orig_tokens) - sum(comp_tokens))::BIGINT AS total_tokens_saved, round(sum(comp_tokens)::DOUBLE / sum(orig_tokens), 4) AS avg_token_ratio, sum(orig_size_bytes)::BIGINT AS total_orig_size, sum(comp_size_bytes)::BIGINT AS total_comp_size, (sum(orig_total_noise) - sum(comp_total_noise))::BIGINT AS total_noise_removed, {_averages()} FROM d")
def compare_summary(spark, sf):
    return noise.compare_summary(_compared(spark, sf))


@query("compare_missing", "SELECT doc_id, 'missing_compressed' AS side FROM documents WHERE NOT length(text) >= 200 UNION ALL SELECT -1, 'missing_original'")
def compare_missing(spark, sf):
    docs = table(spark, sf, "documents")
    return noise.missing(docs, cleaned(docs))


# ------------------------------------------------------------------ files

_ISSUES = "SELECT doc_id, severity, reason FROM (SELECT doc_id, octet_length(encode(text)) AS n FROM documents) d, LATERAL (SELECT CASE WHEN n < 1024 THEN 'ERROR' ELSE 'WARNING' END AS severity, CASE WHEN n = 0 THEN '文件为空 (0 bytes)' WHEN n < 1024 THEN '文件过小 (' || n || ' bytes)，可能转换失败' ELSE '文件偏小 (' || n || ' bytes)，可能不完整' END AS reason) WHERE n < 5120 UNION ALL SELECT doc_id, 'WARNING', '包含 ''Image not available''' FROM documents WHERE contains(text, 'Image not available') AND octet_length(encode(text)) >= 1024"


@query("md_validate_issues", _ISSUES)
def md_validate_issues(spark, sf):
    return files.validate(table(spark, sf, "documents").select("doc_id", "text")).drop("text")


@query("issue_counts", f"SELECT severity, count(*) AS n FROM ({_ISSUES}) GROUP BY severity")
def issue_counts(spark, sf):
    return files.issue_counts(files.validate(table(spark, sf, "documents").select("doc_id", "text")))


@query("orphan_outputs", r"WITH o AS (SELECT 'd' || doc_id || CASE WHEN lang = 'en' THEN '_p001-p020' WHEN lang = 'de' THEN '_p007' ELSE '' END || '.md' AS output FROM documents) SELECT regexp_replace(regexp_replace(output, '\.[^.]*$', ''), '[_-]p\d{3}(-p?\d{3})?$', '') AS stem, output FROM o WHERE stem NOT IN (SELECT 'd' || page_id FROM pages WHERE url LIKE '%.html' OR url LIKE 'https%')")
def orphan_outputs(spark, sf):
    suffix = F.expr("CASE WHEN lang = 'en' THEN '_p001-p020' WHEN lang = 'de' THEN '_p007' ELSE '' END")
    outputs = table(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id", suffix, F.lit(".md")).alias("output"))
    sources = table(spark, sf, "pages").select(F.concat(F.lit("d"), "page_id", F.expr("CASE WHEN url LIKE '%.html' THEN '.html' WHEN url LIKE 'https%' THEN '.PDF' ELSE '.png' END")).alias("source_file"))
    return files.orphans(outputs, sources)


@query("find_source", r"SELECT 'd' || doc_id || '_p003.md' AS output, 'd' || doc_id || CASE WHEN url LIKE 'https%' THEN '.pdf' ELSE '.html' END AS source_file FROM documents JOIN pages ON page_id = doc_id")
def find_source(spark, sf):
    outputs = table(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id", F.lit("_p003.md")).alias("output"))
    pages = table(spark, sf, "pages")
    html = pages.select(F.concat(F.lit("d"), "page_id", F.lit(".html")).alias("source_file"))
    return files.find_source(outputs, html.unionByName(pages.where("url LIKE 'https%'").select(F.concat(F.lit("d"), "page_id", F.lit(".pdf")).alias("source_file"))))


@query("file_range_select", "SELECT file, place FROM (SELECT file, row_number() OVER (ORDER BY file) AS place FROM (SELECT 'doc_' || lpad(doc_id::VARCHAR, 9, '0') || '.md' AS file FROM documents)) WHERE place BETWEEN 1 AND 5 OR place = 8 OR place BETWEEN 10 AND 12 OR place BETWEEN 100 AND 150")
def file_range_select(spark, sf):
    named = table(spark, sf, "documents").select(F.concat(F.lit("doc_"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".md")).alias("file"))
    return files.select_range(named, "1-5,8,10-12,100-150").select("file", "place")


@query("resume_pending", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_pending(spark, sf):
    return files.pending(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id")


@query("page_ranges", "SELECT doc_id, s AS start, least(s + 50, n_chars) AS end, format('{}_p{:03d}-p{:03d}', doc_id, s + 1, least(s + 50, n_chars)) AS piece FROM (SELECT doc_id, n_chars, unnest(range(0, n_chars, 50)) AS s FROM documents)")
def page_ranges(spark, sf):
    return files.page_ranges(table(spark, sf, "documents").select("doc_id", "n_chars"), "n_chars", 50, "doc_id").drop("n_chars")


@query("global_pages", "WITH p AS (SELECT conv_id, turn, string_split(coalesce(text, ''), '. ') AS pages FROM conversations), o AS (SELECT *, coalesce(sum(len(pages)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b FROM p) SELECT conv_id, turn, b + i AS page, format('{}_p{:03d}', conv_id, b + i) AS name, pages[i] AS text FROM (SELECT *, unnest(range(1, len(pages) + 1)) AS i FROM o)")
def global_pages(spark, sf):
    # Turns stand for the pieces that a conversation was split into, their sentences for pages
    return convert.to_pages(table(spark, sf, "conversations"), "conv_id", "turn", "text", lambda t: (t or "").split(". "))


@query("reconvert_bad", "WITH o AS (SELECT page_id, url, html, octet_length(encode(coalesce(html, ''))) AS n FROM pages), b AS (SELECT *, n < 5120 OR contains(html, 'Image not available') AS bad, url LIKE 'https%' AS found FROM o) SELECT page_id, CASE WHEN bad AND found THEN 'again: ' || coalesce(html, '') ELSE html END AS markdown, coalesce(bad AND found, false) AS redone FROM b")
def reconvert_bad(spark, sf):
    pages = table(spark, sf, "pages")
    outputs = pages.select("page_id", F.col("html").alias("markdown"))
    return convert.reconvert(outputs, pages.where("url LIKE 'https%'"), converter=lambda h: "again: " + (h or ""))


@query("join_pages", rf"SELECT conv_id, count(*) AS n_pages, regexp_replace(string_agg(coalesce(text, ''), chr(10) || chr(10) || '--- pagebreak ---' || chr(10) || chr(10) ORDER BY turn), '^[{_SP}]+|[{_SP}]+$', '', 'g') AS text FROM conversations GROUP BY conv_id")
def join_pages(spark, sf):
    return files.join_pages(table(spark, sf, "conversations"), "conv_id", "turn", "text")


@query("merge_corpus", "SELECT source, arg_max(text, doc_id) AS text FROM documents GROUP BY source")
def merge_corpus(spark, sf):
    return files.merge_corpus(table(spark, sf, "documents"), order="doc_id")


# ------------------------------------------------------------------ vectors

_MEANS = "m AS (SELECT label, list(x ORDER BY i) AS q FROM (SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY label, i) GROUP BY label)"
_SCORED = "s AS (SELECT t.label::BIGINT AS query_id, vec_id AS id, round({f}(embedding::DOUBLE[], q), 6) AS score FROM embeddings e CROSS JOIN (SELECT label, q FROM m) t)"
_BEST = "SELECT query_id, id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INT AS rank FROM s) WHERE rank <= {k}"


def _questions(spark, sf):
    return vectors.mean_vectors(table(spark, sf, "embeddings").select("label", "embedding"), "label", "embedding")


def _top(spark, sf, name, k):
    found = vectors.scores(_questions(spark, sf), table(spark, sf, "embeddings"), "label", "vec_id", "embedding", name, k)
    return vectors.best(found, k)


@query("cosine_topk", f"WITH {_MEANS}, {_SCORED.format(f='list_cosine_similarity')} {_BEST.format(k=5)}")
def cosine_topk(spark, sf):
    return _top(spark, sf, "cosine", 5).withColumn("score", F.round("score", 6))


@query("dot_topk", f"WITH {_MEANS}, {_SCORED.format(f='list_inner_product')} {_BEST.format(k=5)}")
def dot_topk(spark, sf):
    return _top(spark, sf, "dot_product", 5).withColumn("score", F.round("score", 6))


@query("cosine_matrix", f"WITH {_MEANS}, {_SCORED.format(f='list_cosine_similarity')} SELECT query_id, id, score FROM s")
def cosine_matrix(spark, sf):
    found = vectors.scores(_questions(spark, sf), table(spark, sf, "embeddings"), "label", "vec_id", "embedding")
    return found.withColumn("score", F.round("score", 6))


@query("batch_pairs", "SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score, round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS dot FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def batch_pairs(spark, sf):
    e = table(spark, sf, "embeddings")
    pairs = e.select(F.col("vec_id").alias("a"), F.col("embedding").alias("x"), (F.col("vec_id") + 1).alias("b")).join(e.select(F.col("vec_id").alias("b"), F.col("embedding").alias("y")), "b")
    return vectors.pairwise(pairs, "x", "y").select("a", "b", F.round("score", 6).alias("score"), F.round(vectors.dot("x", "y"), 6).alias("dot"))


_NEAR = "n AS (SELECT label, vec_id, lead(vec_id) OVER w AS next_id, round(list_cosine_similarity(embedding::DOUBLE[], (lead(embedding) OVER w)::DOUBLE[]), 6) AS similarity FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY vec_id))"


@query("adjacent_similarity", f"WITH {_NEAR} SELECT * FROM n WHERE next_id IS NOT NULL")
def adjacent_similarity(spark, sf):
    return vectors.adjacent(table(spark, sf, "embeddings"), "label", "vec_id", "embedding").select("label", "vec_id", "next_id", F.round("similarity", 6).alias("similarity"))


@query("split_groups", f"WITH {_NEAR}, b AS (SELECT label, vec_id, lag(similarity) OVER (PARTITION BY label ORDER BY vec_id) AS s FROM n) SELECT label, vec_id, sum(CASE WHEN s < 0.05 THEN 1 ELSE 0 END) OVER (PARTITION BY label ORDER BY vec_id)::BIGINT AS group_id FROM b")
def split_groups(spark, sf):
    return vectors.split_groups(table(spark, sf, "embeddings"), "label", "vec_id", "embedding", 0.05).select("label", "vec_id", "group_id")


@query("two_stage_rerank", f"WITH {_MEANS}, {_SCORED.format(f='list_cosine_similarity')}, c AS ({_BEST.format(k=20)}), d AS (SELECT query_id, c.id, score, round(list_inner_product(embedding::DOUBLE[], q), 6) - 0.001 * (c.id % 10) AS rerank_score FROM c JOIN embeddings e ON e.vec_id = c.id JOIN m ON m.label = c.query_id) SELECT query_id, id, score, round(rerank_score, 6) AS rerank_score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(rerank_score, 6) DESC, id)::INT AS rank FROM d) WHERE rank <= 5")
def two_stage_rerank(spark, sf):
    retrieve, keep = vectors.pick_k(None, True)
    first = _top(spark, sf, "cosine", retrieve).withColumn("score", F.round("score", 6))
    vec, ask = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding"), _questions(spark, sf).select(F.col("label").cast("long").alias("query_id"), F.col("embedding").alias("q"))
    both = first.join(vec, "id").join(ask, "query_id")
    again = vectors.rerank(both, F.round(vectors.dot("embedding", "q"), 6) - 0.001 * (F.col("id") % 10), keep)
    return again.select("query_id", "id", "score", F.round("rerank_score", 6).alias("rerank_score"), "rank")


# ------------------------------------------------------------------ chunking


@query("sentence_counts")
def sentence_counts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.size(chunking.sentences()).alias("n_sentences"))


@query("semantic_chunks")
def semantic_chunks(spark, sf):
    return chunking.semantic_chunks(table(spark, sf, "documents"), "doc_id")


@query("section_chunks")
def section_chunks(spark, sf):
    return chunking.section_chunks(convert.to_markdown(table(spark, sf, "pages")).select(F.col("page_id").alias("doc_id"), F.col("markdown").alias("text")), 400)


@query("html_to_markdown")
def html_to_markdown(spark, sf):
    return convert.to_markdown(table(spark, sf, "pages"))


# ------------------------------------------------------------------ graph build

_CHUNKS = r"""
ch AS (
  SELECT n_nationkey::BIGINT AS chunk_seq, 'In (N_' || n_nationkey || ' - nation - ' || n_name || ') and (R_' || r_regionkey || ' - region - ' || r_name || ')' || chr(10) || 'we see [N_' || n_nationkey || ' -> R_' || r_regionkey || ': in_region].' AS text FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT s_suppkey + 1000, '(S_' || s_suppkey || ' - supplier - ' || s_name || ') sits in [S_' || s_suppkey || ' -> N_' || s_nationkey || ': located_in]' FROM supplier),
en AS (SELECT 'c' || chunk_seq AS chunk_id, chunk_seq, unnest(range(0, len(regexp_extract_all(text, '(?s)\((\w+)\s*-\s*(\w+)\s*-\s*(.+?)\)'))))::INT AS pos,
  unnest(regexp_extract_all(text, '(?s)\((\w+)\s*-\s*(\w+)\s*-\s*(.+?)\)', 1)) AS name, unnest(regexp_extract_all(text, '(?s)\((\w+)\s*-\s*(\w+)\s*-\s*(.+?)\)', 2)) AS type, unnest(regexp_extract_all(text, '(?s)\((\w+)\s*-\s*(\w+)\s*-\s*(.+?)\)', 3)) AS description FROM ch),
re AS (SELECT 'c' || chunk_seq AS chunk_id, chunk_seq, unnest(range(0, len(regexp_extract_all(text, '(?s)\[(\w+)\s*->\s*(\w+)\s*:\s*(.+?)\]'))))::INT AS pos,
  unnest(regexp_extract_all(text, '(?s)\[(\w+)\s*->\s*(\w+)\s*:\s*(.+?)\]', 1)) AS source, unnest(regexp_extract_all(text, '(?s)\[(\w+)\s*->\s*(\w+)\s*:\s*(.+?)\]', 2)) AS target, unnest(regexp_extract_all(text, '(?s)\[(\w+)\s*->\s*(\w+)\s*:\s*(.+?)\]', 3)) AS relation FROM ch),
nd AS (
  SELECT name, arg_max(type, chunk_seq * 1000 + pos) AS type, arg_max(description, chunk_seq * 1000 + pos) AS description, array_to_string(list(chunk_id ORDER BY chunk_seq, pos), ',') AS chunk_refs FROM en GROUP BY name
  UNION ALL SELECT DISTINCT n, NULL, NULL, NULL FROM (SELECT source AS n FROM re UNION ALL SELECT target FROM re) WHERE n NOT IN (SELECT name FROM en)),
ed AS (SELECT source, target, arg_max(relation, chunk_seq * 1000 + pos) AS relation, array_to_string(list(chunk_id ORDER BY chunk_seq, pos), ',') AS chunk_refs FROM re GROUP BY source, target)
"""
_KEYS = ("chunk_id", "chunk_seq")


def _entities(spark, sf):
    return graph_build.extract_entities(marked_chunks(spark, sf), keys=_KEYS)


def _relations(spark, sf):
    return graph_build.extract_relations(marked_chunks(spark, sf), keys=_KEYS)


@query("extract_entities", f"WITH {_CHUNKS} SELECT * FROM en")
def extract_entities(spark, sf):
    return _entities(spark, sf)


@query("extract_relations", f"WITH {_CHUNKS} SELECT * FROM re")
def extract_relations(spark, sf):
    return _relations(spark, sf)


@query("merge_nodes", f"WITH {_CHUNKS} SELECT * FROM nd")
def merge_nodes(spark, sf):
    return graph_build.merge_nodes(_entities(spark, sf), _relations(spark, sf)).withColumn("chunk_refs", F.array_join("chunk_refs", ","))


@query("merge_edges", f"WITH {_CHUNKS} SELECT * FROM ed")
def merge_edges(spark, sf):
    return graph_build.merge_edges(_relations(spark, sf)).select("source", "target", "relation", F.array_join("chunk_refs", ",").alias("chunk_refs"))


@query("processed_chunks", f"WITH {_CHUNKS} SELECT DISTINCT chunk_id FROM en")
def processed_chunks(spark, sf):
    return graph_build.processed_chunks(graph_build.merge_nodes(_entities(spark, sf)))


def _two_builds(spark, sf):
    """Nodes and edges of a build over the nations' chunks that a second build over the suppliers' chunks is added to."""
    parts = [(e.where(c), r.where(c)) for e, r in [(_entities(spark, sf), _relations(spark, sf))] for c in ("chunk_seq < 1000", "chunk_seq >= 1000")]
    nodes = graph_build.upsert(*[graph_build.merge_nodes(e, r) for e, r in parts], ("name",))
    return nodes, graph_build.upsert(*[graph_build.merge_edges(r) for _, r in parts], ("source", "target"))


@query("resumed_nodes", f"WITH {_CHUNKS} SELECT * FROM nd")
def resumed_nodes(spark, sf):
    return _two_builds(spark, sf)[0].withColumn("chunk_refs", F.array_join("chunk_refs", ","))


@query("resumed_edges", f"WITH {_CHUNKS} SELECT * FROM ed")
def resumed_edges(spark, sf):
    return _two_builds(spark, sf)[1].select("source", "target", "relation", F.array_join("chunk_refs", ",").alias("chunk_refs"))


_STAR_SMALL = "e AS (SELECT 'N_' || n_nationkey AS source, 'R_' || n_regionkey AS target, 'in_region' AS relation FROM nation UNION ALL SELECT 'S_' || s_suppkey, 'N_' || s_nationkey, 'located_in' FROM supplier)"
_STAR = "e AS (SELECT 'N_' || n_nationkey AS source, 'R_' || n_regionkey AS target, 'in_region' AS relation FROM nation UNION ALL SELECT 'S_' || s_suppkey, 'N_' || s_nationkey, 'located_in' FROM supplier UNION ALL SELECT 'C_' || c_custkey, 'N_' || c_nationkey, 'located_in' FROM customer UNION ALL SELECT DISTINCT 'S_' || l_suppkey, 'P_' || l_partkey, 'supplies' FROM lineitem)"
_LINKS = "l AS (SELECT source AS a, target AS b FROM e UNION SELECT target, source FROM e)"


@query("graph_stats", f"WITH {_STAR} SELECT (SELECT count(*) FROM documents) AS documents, (SELECT count(*) FROM conversations) AS chunks, (SELECT count(*) FROM region) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM part) AS graph_nodes, (SELECT count(*) FROM e) AS graph_edges, (SELECT count(DISTINCT n_regionkey) FROM nation) AS communities, false AS rerank")
def graph_stats(spark, sf):
    nodes, edges = star(spark, sf)
    return graph_build.statistics(table(spark, sf, "documents"), table(spark, sf, "conversations"), nodes, edges, table(spark, sf, "nation").select(F.col("n_regionkey").alias("community_id")))


# ------------------------------------------------------------------ graph retrieval

_TERMS = ("widget", "supplier", "an", "BOLT")


@query("entity_match", "WITH n AS (SELECT DISTINCT name FROM (SELECT p_name AS name FROM part UNION ALL SELECT s_name FROM supplier UNION ALL SELECT n_name FROM nation)), h AS (SELECT name, p AS t, row_number() OVER (PARTITION BY p ORDER BY name) AS rn FROM n JOIN (VALUES (0, 'widget'), (1, 'supplier'), (2, 'an'), (3, 'bolt')) v(p, w) ON contains(lower(name), w)), f AS (SELECT name, min(t * 1000 + rn) AS k FROM h WHERE rn <= 10 GROUP BY name) SELECT name, (k // 1000)::INT AS term_pos, (k % 1000)::INT AS rn FROM f ORDER BY k LIMIT 10")
def entity_match(spark, sf):
    names = table(spark, sf, "part").select(F.col("p_name").alias("name")).union(table(spark, sf, "supplier").select("s_name")).union(table(spark, sf, "nation").select("n_name"))
    return graph_query.match_entities(names, list(_TERMS))


_BALL = "WITH RECURSIVE {star}, {links}, r(name, d) AS (SELECT 'S_1', 0 UNION SELECT b, d + 1 FROM r JOIN l ON a = name WHERE d < {hops})"


def _seed(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


@query("khop_neighbors", _BALL.format(star=_STAR, links=_LINKS, hops=2) + " SELECT name, min(d) AS distance FROM r GROUP BY name")
def khop_neighbors(spark, sf):
    return graph_query.neighbours(star(spark, sf)[1], _seed(spark, "S_1"), 2)


@query("induced_edges", _BALL.format(star=_STAR, links=_LINKS, hops=2) + ", k AS (SELECT DISTINCT name FROM r) SELECT source, target, relation FROM e WHERE source IN (SELECT name FROM k) AND target IN (SELECT name FROM k)")
def induced_edges(spark, sf):
    edges = star(spark, sf)[1]
    return graph_query.induced_edges(edges, graph_query.neighbours(edges, _seed(spark, "S_1"), 2))


@query("shortest_path_lengths", f"WITH RECURSIVE {_STAR}, {_LINKS}, s AS (SELECT 'S_' || s_suppkey AS name FROM supplier ORDER BY 1 LIMIT 10), r(source, node, d) AS (SELECT name, name, 0 FROM s UNION SELECT source, b, d + 1 FROM r JOIN l ON a = node WHERE d < 6) SELECT source, node AS target, min(d)::INT AS length FROM r WHERE node IN (SELECT name FROM s) AND source < node GROUP BY ALL")
def shortest_path_lengths(spark, sf):
    nodes, edges = star(spark, sf)
    seeds = graph_query.match_entities(nodes, ["s_"])
    return graph_query.shortest_paths(edges, seeds).drop("path")


@query("communities")
def communities_query(spark, sf):
    nodes, edges = star(spark, sf, small=True)
    return communities.detect(edges, nodes)


@query("community_retrieval", "WITH c AS (SELECT n_regionkey AS community_id, 'N_' || n_nationkey AS name FROM nation) SELECT community_id, name FROM c WHERE community_id IN (SELECT DISTINCT community_id FROM c WHERE name IN ('N_1', 'N_7', 'N_12') ORDER BY community_id LIMIT 5)")
def community_retrieval(spark, sf):
    c = table(spark, sf, "nation").select(F.col("n_regionkey").alias("community_id"), F.concat(F.lit("N_"), "n_nationkey").alias("name"))
    return graph_query.communities_of(c, _seed(spark, "N_1", "N_7", "N_12"))


@query("write_back_communities", "SELECT 'N_' || n_nationkey AS name, 'nation' AS type, n_name AS description, CASE WHEN n_regionkey <> 0 THEN n_regionkey ELSE -1 END AS community_id FROM nation")
def write_back_communities(spark, sf):
    n = table(spark, sf, "nation")
    nodes = n.select(F.concat(F.lit("N_"), "n_nationkey").alias("name"), F.lit("nation").alias("type"), F.col("n_name").alias("description"), F.lit(9).alias("community_id"))
    return graph_build.with_communities(nodes, n.where("n_regionkey <> 0").select(F.concat(F.lit("N_"), "n_nationkey").alias("name"), F.col("n_regionkey").alias("community_id"))).fillna({"community_id": -1})


# ------------------------------------------------------------------ questions and answers

_STOP = ", ".join(f"'{w}'" for w in qa.STOP_WORDS)
_TERMS_SQL = rf"array_to_string(list_filter(string_split_regex(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\p{{M}}_\s]', ' ', 'g'), '^[{_SP}]+|[{_SP}]+$', '', 'g'), '[{_SP}]+'), lambda w: length(w) > 2 AND NOT list_contains([{_STOP}], w)), ' ')"


@query("query_terms", f"SELECT conv_id AS id, turn, {_TERMS_SQL} AS terms FROM conversations WHERE role = 'user' UNION ALL SELECT item_id, -1, {_TERMS_SQL} FROM benchmark")
def query_terms(spark, sf):
    asked = table(spark, sf, "conversations").where("role = 'user'").select(F.col("conv_id").alias("id"), "turn", "text")
    asked = asked.unionByName(table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), F.lit(-1).cast("long").alias("turn"), "text"))
    return asked.select("id", "turn", F.array_join(qa.query_terms(), " ").alias("terms"))


@query("context_string", "WITH n AS (SELECT r_regionkey, r_name, list(n_name ORDER BY n_nationkey) AS names, list('- N_' || n_nationkey || ' --[in_region]--> R_' || r_regionkey ORDER BY n_nationkey) AS edges FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY ALL) SELECT r_regionkey, '=== Text Chunks ===' || chr(10) || '[c' || r_regionkey || ']: ' || r_name || chr(10) || chr(10) || '=== Knowledge Graph Entities ===' || chr(10) || array_to_string(list_transform(names, lambda x: '- ' || x), chr(10)) || chr(10) || chr(10) || '=== Entity Relations ===' || chr(10) || array_to_string(edges, chr(10)) || chr(10) || chr(10) || '=== Entity Paths ===' || chr(10) || array_to_string(names, ' -> ') || chr(10) || chr(10) || '=== Communities ===' || chr(10) || 'Community 0: ' || array_to_string(names[:10], ', ') || chr(10) AS context FROM n")
def context_string(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    own = n.join(r, n["n_regionkey"] == r["r_regionkey"]).groupBy("r_regionkey", "r_name").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("n"))
    names = F.transform("n", lambda x: x["n_name"])
    edges = F.transform("n", lambda x: F.struct(F.concat(F.lit("N_"), x["n_nationkey"].cast("string")).alias("source"), F.concat(F.lit("R_"), F.col("r_regionkey").cast("string")).alias("target"), F.lit("in_region").alias("relation")))
    chunks = F.array(F.struct(F.concat(F.lit("c"), F.col("r_regionkey").cast("string")).alias("chunk_id"), F.col("r_name").alias("text")))
    return own.select("r_regionkey", qa.context_string(chunks, names, edges, F.array(names), F.array(names)).alias("context"))


@query("fallback_answer", "WITH n AS (SELECT r_regionkey, list(n_name ORDER BY n_nationkey) FILTER (WHERE n_name IS NOT NULL) AS names FROM region LEFT JOIN nation ON n_regionkey = r_regionkey AND r_regionkey <> 3 GROUP BY r_regionkey) SELECT r_regionkey, CASE WHEN names IS NOT NULL THEN '找到 ' || len(names) || ' 个相关实体和 ' || r_regionkey || ' 个文本块。实体: ' || array_to_string(names[:5], ', ') || '。请配置 LLM 提供者以生成完整答案。' ELSE '未找到相关上下文。请提供文档或配置 LLM 提供者。' END AS answer FROM n")
def fallback_answer(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    own = r.join(n, (n["n_regionkey"] == r["r_regionkey"]) & (r["r_regionkey"] != 3), "left").groupBy("r_regionkey").agg(F.array_sort(F.collect_list(F.when(F.col("n_name").isNotNull(), F.struct("n_nationkey", "n_name")))).alias("n"))
    return own.select("r_regionkey", qa.fallback_answer(F.transform("n", lambda x: x["n_name"]), F.col("r_regionkey")).alias("answer"))


@query("dedupe_questions", rf"SELECT role, regexp_replace(text, '^[{_SP}]+|[{_SP}]+$', '', 'g') AS question, min(conv_id * 1000 + turn) AS pos FROM conversations WHERE regexp_matches(text, '[^{_SP}]') GROUP BY ALL")
def dedupe_questions(spark, sf):
    return qa.dedupe_questions(table(spark, sf, "conversations").withColumn("pos", F.col("conv_id") * 1000 + F.col("turn")), "role", "pos", "text")


@query("merge_dataset", "SELECT role AS source, text AS question, conv_id * 1000 + turn AS pos FROM conversations UNION ALL SELECT 'benchmark', text, item_id FROM benchmark")
def merge_dataset(spark, sf):
    a = table(spark, sf, "conversations").select(F.col("role").alias("source"), F.col("text").alias("question"), (F.col("conv_id") * 1000 + F.col("turn")).alias("pos"))
    return qa.merge_dataset(a.unionByName(table(spark, sf, "benchmark").select(F.lit("benchmark").alias("source"), F.col("text").alias("question"), F.col("item_id").alias("pos"))), "source", "pos")


_ANSWERED = """
q AS (SELECT conv_id, turn, text AS question FROM conversations WHERE role = 'user'),
ds AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_idx FROM q),
an AS (SELECT question, CASE WHEN q.turn >= 4 THEN NULL ELSE a.text END AS answer, q.conv_id * 1000 + q.turn AS line FROM q JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant'),
la AS (SELECT question, arg_max(answer, line) AS answer FROM an WHERE answer IS NOT NULL AND answer <> '' GROUP BY question),
rs AS (SELECT ds.*, coalesce(la.answer, '') AS answer FROM ds LEFT JOIN la USING (question))
"""


def _resumed(spark, sf):
    return qa.resume(*answered(table(spark, sf, "conversations")))


@query("batch_resume", f"WITH {_ANSWERED} SELECT row_idx, question, answer FROM rs")
def batch_resume(spark, sf):
    return _resumed(spark, sf).select("row_idx", "question", "answer")


@query("batch_worklist", f"WITH {_ANSWERED} SELECT row_idx, question FROM rs WHERE row_idx >= 10 AND row_idx < 110 AND answer = ''")
def batch_worklist(spark, sf):
    return qa.worklist(_resumed(spark, sf), 10, 100).select("row_idx", "question")


@query("batch_failure_runs", "WITH t AS (SELECT conv_id, turn, length(text) < 200 AS failed FROM conversations), g AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM t) SELECT conv_id, run::BIGINT AS run, min(turn) AS first, count(*) AS length FROM g WHERE failed GROUP BY conv_id, run")
def batch_failure_runs(spark, sf):
    return qa.failure_runs(table(spark, sf, "conversations").withColumn("failed", F.length("text") < 200), "conv_id", "turn", "failed")


@query("run_summary", "SELECT count(*) AS total_files, sum((length(text) >= 1000)::INT)::BIGINT AS completed, sum((length(text) BETWEEN 100 AND 999)::INT)::BIGINT AS resumed, sum((length(text) < 100)::INT)::BIGINT AS failed, sum(length(text))::BIGINT AS input_tokens, sum(length(text) // 2)::BIGINT AS output_tokens FROM documents")
def run_summary(spark, sf):
    status = F.when(F.length("text") >= 1000, "completed").when(F.length("text") >= 100, "resumed").otherwise("failed")
    return qa.run_summary(table(spark, sf, "documents").select(status.alias("status"), F.length("text").alias("input_tokens"), F.expr("length(text) div 2").alias("output_tokens")))


@query("rag_end_to_end")
def rag_end_to_end(spark, sf):
    from quillgraph.engine import Engine

    engine = Engine(spark)
    engine.load_documents(table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("source"), "text"))
    engine.chunk_documents()
    engine.nodes, engine.edges = star(spark, sf)
    engine.communities = table(spark, sf, "nation").select(F.col("n_regionkey").alias("community_id"), F.concat(F.lit("N_"), "n_nationkey").alias("name"))
    questions = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    return engine.answer(questions)


# ------------------------------------------------------------------ model-driven preprocessing


@query("compress_run", rf"""WITH d AS (SELECT doc_id::VARCHAR AS file, text, regexp_replace(regexp_replace(text, '[\x09-\x0d\x20]+', ' ', 'g'), '^ | $', '', 'g') AS out, length(regexp_replace(text, '^[{_SP}]+|[{_SP}]+$', '', 'g')) < 50 AS short FROM documents)
SELECT file, CASE WHEN short THEN 'skipped' ELSE 'completed' END AS status, {_tokens('text')} AS input_tokens, CASE WHEN short THEN 0 ELSE {_tokens('out')} END AS output_tokens, CASE WHEN short THEN 0 ELSE 1 END AS chunks, CASE WHEN short THEN 'too short' END AS reason, CASE WHEN NOT short THEN out END AS output FROM d""")
def compress_run(spark, sf):
    return preprocess.compress(table(spark, sf, "documents"), key="doc_id").drop("compression_ratio", "error")


@query("compress_batch", rf"""WITH d AS (SELECT lang, coalesce(text, '') AS text, {_tokens("coalesce(text, '')")} AS n, regexp_replace(regexp_replace(coalesce(text, ''), '[\x09-\x0d\x20]+', ' ', 'g'), '^ | $', '', 'g') AS out, length(regexp_replace(coalesce(text, ''), '^[{_SP}]+|[{_SP}]+$', '', 'g')) >= 50 AND lang IS DISTINCT FROM 'en' AND lang IS DISTINCT FROM 'de' AS new FROM documents),
a AS (SELECT count(*) AS total_files, count(*) FILTER (WHERE new) AS completed, count(*) FILTER (WHERE lang = 'en') AS resumed, 0::BIGINT AS failed, coalesce(sum(n) FILTER (WHERE new), 0)::BIGINT AS input_tokens, coalesce(sum({_tokens("out")}) FILTER (WHERE new), 0)::BIGINT AS output_tokens FROM d)
SELECT *, CASE WHEN input_tokens > 0 THEN output_tokens / input_tokens::DOUBLE ELSE 0 END AS compression_ratio, round(input_tokens / 1e6::DOUBLE * 1.0::DOUBLE + output_tokens / 1e6::DOUBLE * 2.0::DOUBLE, 4) AS cost_yuan FROM a""")
def compress_batch(spark, sf):
    # English documents are done by their state; German ones have an output of over 100 bytes
    docs = table(spark, sf, "documents")
    done = docs.where("lang = 'en'").select(F.col("doc_id").cast("string").alias("file"), F.lit("completed").alias("status"))
    there = docs.where("lang = 'de'").select("doc_id", F.lpad(F.coalesce("text", F.lit("")), 200, "-").alias("text"))
    return preprocess.compress_batch(docs, done, there, key="doc_id")[1]


_ASKED = rf"""
d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents WHERE length(regexp_replace(coalesce(text, ''), '^[{_SP}]+|[{_SP}]+$', '', 'g')) >= 100),
l AS (SELECT doc_id, lang, generate_subscripts(a, 1) AS i, unnest(a) AS line FROM (SELECT doc_id, lang, string_split_regex(text, '{T.LINE_BREAK}') AS a FROM d)),
w AS (SELECT doc_id, lang, i, 'What about ' || array_to_string(string_split_regex(regexp_replace(line, '^[{_SP}]+|[{_SP}]+$', '', 'g'), '[{_SP}]+')[:8], ' ') || '?' AS question FROM l WHERE regexp_matches(line, '[^{_SP}]')),
u AS (SELECT doc_id, lang, question, min(i) AS i FROM w GROUP BY ALL)
"""


@query("generate_questions", f"WITH {_ASKED} SELECT doc_id::VARCHAR AS source, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS pos, question FROM u")
def generate_questions(spark, sf):
    return preprocess.generate_questions(table(spark, sf, "documents"), key="doc_id")


@query("questions_batch", f"WITH {_ASKED} SELECT (SELECT count(*) FROM documents) AS total_files, (SELECT count(*) FROM d WHERE lang IS DISTINCT FROM 'en') AS completed, (SELECT count(*) FROM documents WHERE lang = 'en') AS resumed, 0::BIGINT AS failed, (SELECT count(*) FROM u WHERE lang IS DISTINCT FROM 'en') AS total_questions, (SELECT coalesce(sum({_tokens('text')}), 0)::BIGINT FROM d WHERE lang IS DISTINCT FROM 'en') AS input_tokens")
def questions_batch(spark, sf):
    docs = table(spark, sf, "documents")
    done = docs.where("lang = 'en'").select(F.col("doc_id").cast("string").alias("file"), F.lit("completed").alias("status"))
    return preprocess.questions_batch(docs, done, key="doc_id")[2]
