"""Model-driven preprocessing: compressing texts, generating questions, and running all stages.

Models are functions from a prompt to a reply; without one, deterministic stand-ins are used. Work that a state table shows as
completed is skipped by an anti join, so a run can be resumed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import text as T
from quillgraph.functions.models import with_retries
from quillgraph.functions.rows import cut
from quillgraph.operators import chunking, convert, files, qa, quality

# Shorter texts are not compressed, or asked about.
MIN_COMPRESS, MIN_QUESTIONS = 50, 100
# Outputs of more bytes than these are there already, whatever the state says.
DONE_BYTES, DONE_QUESTION_BYTES = 100, 10
STATE = "file string, status string, input_tokens int, output_tokens int, chunks int, compression_ratio double, error string, reason string, output string"
#: What a stored state holds; outputs are files of their own
PROGRESS = STATE.removesuffix(", output string")


def tokens(text: str) -> int:
    """The same estimate as the expression in functions.text."""
    cjk = sum("一" <= c <= "鿿" for c in text)
    return int(cjk * 1.5 + (len(text) - cjk) * 0.25)


def sections(text: str, max_tokens: int) -> list[str]:
    """A text cut before headings into parts of at most max_tokens where headings allow."""
    parts = re.split(r"(?m)^(?=##\s)", text)
    if len(parts) < 2:
        parts = re.split(r"(?m)^(?=#\s)", text)
    out: list[list[str]] = []
    size = 0
    for p in parts:
        n = tokens(p)
        if out and size + n <= max_tokens:
            out[-1].append(p)
            size += n
        else:
            out.append([p])
            size = n
    kept = [s for s in ("\n".join(x).strip() for x in out) if s]
    return kept or [text]


def collapse(text: str) -> str:
    """The offline compressor: runs of white space become one space."""
    return re.sub(r"[\x09-\x0d\x20]+", " ", text).strip(" ")


def unfenced(reply: str | None) -> str:
    """A model's reply without the code fence around it, as functions.text has it for columns."""
    body = re.sub(r"^```[a-zA-Z]*\s*\n?", "", (reply or "").strip())
    return re.sub(r"\n?```\s*$", "", body).strip()


class ContextOverflow(Exception):
    """Raised by a model whose context a prompt exceeds; trying again doesn't help."""

    fatal = True


def compress_text(text: str, model: Callable[[str], str], whole: bool, max_tokens: int) -> tuple[str, int]:
    """The compressed text and the number of parts it was compressed in: whole, or in sections if asked for or if it is too
    long for the model."""
    if whole:
        try:
            return model(text), 1
        except ContextOverflow:
            pass
    parts = sections(text, max_tokens)
    return "\n\n".join(model(p) for p in parts), len(parts)


def compress(docs: DataFrame, done: DataFrame | None = None, model: Callable[[str], str] = collapse, key: str = "file", text: str = "text", whole: bool = True, max_tokens: int = 24_000) -> DataFrame:
    """A state row and the output for each document that isn't completed: skipped if too short, failed with its error, or
    completed."""
    work = docs if done is None else files.pending(docs, done.where("status = 'completed'"), key)
    asked = with_retries(model)
    call = model if model is collapse else lambda part: unfenced(asked(part))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, t in zip(pdf["file"], pdf["text"], strict=True):
                t = t or ""
                n = tokens(t)
                if len(t.strip()) < MIN_COMPRESS:
                    rows.append((name, "skipped", n, 0, 0, 0.0, None, "too short", None))
                    continue
                try:
                    out, parts = compress_text(t, call, whole, max_tokens)
                    rows.append((name, "completed", n, tokens(out), parts, round(tokens(out) / n, 3) if n else 0.0, None, None, out))
                except Exception as e:  # noqa: BLE001  a document's failure is its state
                    rows.append((name, "failed", n, 0, 0, 0.0, str(e), None, None))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in STATE.split(", ")])

    return work.select(F.col(key).cast("string").alias("file"), F.col(text).alias("text")).mapInPandas(run, STATE)


def existing_states(outputs: DataFrame, key: str = "file", text: str = "text", min_bytes: int = DONE_BYTES) -> DataFrame:
    """State rows of outputs that are there already, for runs whose state was lost."""
    t = F.coalesce(F.col(text), F.lit(""))
    values = {"status": F.lit("completed"), "input_tokens": F.lit(0), "output_tokens": T.estimate_tokens(t), "chunks": F.lit(1), "compression_ratio": F.lit(0.0), "error": F.lit(None), "reason": F.lit(None), "output": F.col(text)}
    kinds = dict(c.split() for c in STATE.split(", "))
    return outputs.where(F.octet_length(t) > min_bytes).select(F.col(key).cast("string").alias("file"), *[v.cast(kinds[k]).alias(k) for k, v in values.items()])


def compress_batch(docs: DataFrame, done: DataFrame | None = None, outputs: DataFrame | None = None, key: str = "file", **options) -> tuple[DataFrame, DataFrame]:
    """(new states, summary) of a batch run. What done has as completed is resumed; documents whose output is there already are
    left out and count in the total alone. The summary's tokens are those of newly completed documents."""
    work = docs if outputs is None else files.pending(docs, existing_states(outputs, key).select(F.col("file").cast(docs.schema[key].dataType).alias(key)), key)
    states = cut(compress(work, None if done is None else done.withColumn(key, F.col("file").cast(docs.schema[key].dataType)), key=key, **options))
    total = docs.agg(F.count("*").alias("total_files"))
    new = F.col("status") == "completed"
    counted = states.agg(F.count_if(new).alias("completed"), F.count_if(F.col("status") == "failed").alias("failed"), *[F.coalesce(F.sum(F.when(new, F.col(c))), F.lit(0)).cast("long").alias(c) for c in ("input_tokens", "output_tokens")])
    return states, _with_resumed(total.join(counted), docs, done, key).select(
        "total_files", "completed", "resumed", "failed", "input_tokens", "output_tokens",
        F.when(F.col("input_tokens") > 0, F.col("output_tokens") / F.col("input_tokens")).otherwise(0.0).alias("compression_ratio"),
        F.round(T.cost_yuan("input_tokens", "output_tokens"), 4).alias("cost_yuan"),
    )


def _with_resumed(row: DataFrame, docs: DataFrame, done: DataFrame | None, key: str) -> DataFrame:
    """Adds to a one-row summary how many documents done has as completed."""
    if done is None:
        return row.withColumn("resumed", F.lit(0).cast("long"))
    names = done.where("status = 'completed'").select(F.col("file").alias("_file"))
    return row.join(docs.join(names, F.col(key).cast("string") == F.col("_file"), "left_semi").agg(F.count("*").alias("resumed")))


def first_sentences(prompt: str) -> str:
    """The offline question model: the first words of each line as a question, as a JSON list."""
    import json

    lines = [" ".join(line.split()[:8]) for line in prompt.splitlines() if line.strip()]
    return json.dumps([f"What about {line}?" for line in lines], ensure_ascii=False)


_QUESTION_ROWS = "source string, pos int, question string, status string, input_tokens int, error string"


def _ask_all(work: DataFrame, model: Callable[[str], str], key: str, text: str, whole: bool, max_tokens: int) -> DataFrame:
    """A row with the status of each document, without a place, and a row for each of its questions."""
    call = model if model is first_sentences else with_retries(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, t in zip(pdf["source"], pdf["text"], strict=True):
                t = t or ""
                if len(t.strip()) < MIN_QUESTIONS:
                    rows.append((name, None, None, "skipped", tokens(t), "too short"))
                    continue
                found: dict[str, None] = {}
                try:
                    parts = [call(t)] if whole else None
                except ContextOverflow:
                    parts = None
                except Exception as e:  # noqa: BLE001  a document's failure is its state
                    rows.append((name, None, None, "failed", tokens(t), str(e)))
                    continue
                if parts is None:
                    parts, error = [], None
                    for part in sections(t, max_tokens):
                        try:
                            parts.append(call(part))
                        except Exception as e:  # noqa: BLE001  a part without a reply gives no questions
                            error = str(e)
                    if not parts:
                        rows.append((name, None, None, "failed", tokens(t), error))
                        continue
                for reply in parts:
                    found.update(dict.fromkeys(qa.parse_questions(reply)))
                rows.append((name, None, None, "completed", tokens(t), None))
                rows += [(name, i, q, None, None, None) for i, q in enumerate(found)]
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in _QUESTION_ROWS.split(", ")])
            yield out.astype({"pos": "Int32", "input_tokens": "Int32"})

    return work.select(F.col(key).cast("string").alias("source"), F.col(text).alias("text")).mapInPandas(run, _QUESTION_ROWS)


def generate_questions(docs: DataFrame, done: DataFrame | None = None, model: Callable[[str], str] = first_sentences, key: str = "file", text: str = "text", whole: bool = True, max_tokens: int = 24_000) -> DataFrame:
    """source, pos, question of each document that isn't done; too short ones give none. Equal questions of a document count
    once, in their first place."""
    work = docs if done is None else files.pending(docs, done, key)
    return _ask_all(work, model, key, text, whole, max_tokens).where("pos IS NOT NULL").select("source", "pos", "question")


def questions_batch(docs: DataFrame, done: DataFrame | None = None, outputs: DataFrame | None = None, model: Callable[[str], str] = first_sentences, key: str = "file", text: str = "text", whole: bool = True, max_tokens: int = 24_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(questions, new states, summary) of a batch run. done: states (file, status); outputs: key and text of question files that are
    there, which count in the total alone if they hold more than a few bytes."""
    kind, work = docs.schema[key].dataType, docs
    if outputs is not None:
        work = files.pending(work, outputs.where(F.octet_length(F.coalesce("text", F.lit(""))) > DONE_QUESTION_BYTES).select(F.col(key).cast(kind).alias(key)), key)
    if done is not None:
        work = files.pending(work, done.where("status = 'completed'").select(F.col("file").cast(kind).alias(key)), key)
    rows = cut(_ask_all(work, model, key, text, whole, max_tokens))
    states = rows.where("pos IS NULL").select(F.col("source").alias("file"), "status", "input_tokens", "error")
    new = F.col("status") == "completed"
    counted = rows.agg(F.count_if(new).alias("completed"), F.count_if(F.col("status") == "failed").alias("failed"), F.count("pos").alias("total_questions"), F.coalesce(F.sum(F.when(new, F.col("input_tokens"))), F.lit(0)).cast("long").alias("input_tokens"))
    row = _with_resumed(docs.agg(F.count("*").alias("total_files")).join(counted), docs, done, key)
    return rows.where("pos IS NOT NULL").select("source", "pos", "question"), states, row.select("total_files", "completed", "resumed", "failed", "total_questions", "input_tokens")


def questions_dry_run(docs: DataFrame, per_chunk: int = 5, max_tokens: int = 24_000, text: str = "text") -> DataFrame:
    """Tokens that would be read and questions that would be asked for."""
    t = F.coalesce(F.col(text), F.lit(""))
    parts = chunking.section_chunks(docs.select(F.lit(0).alias("_k"), t.alias("_t")), max_tokens, "_k", "_t").agg((F.count("*") * per_chunk).alias("questions"))
    n = docs.agg(F.count("*").alias("files"), F.coalesce(F.sum(T.estimate_tokens(t)), F.lit(0)).alias("input_tokens"))
    return n.join(parts)  # one row each


def run_all(docs: DataFrame, key: str = "file", stages: tuple[str, ...] = ("quality", "compress", "questions"), mode: str = "full", max_tokens: int = 24_000, converter: Callable[[str | None], str] = convert.html_to_markdown, **limits) -> dict[str, DataFrame | str]:
    """The stages in order, each on what the one before leaves; a stage that fails is noted and the others go on. In mode stats the
    quality stage scores and lets everything pass; filter and full filter. The stage convert reads the column html."""
    if mode not in ("stats", "filter", "full"):
        raise ValueError(f"unknown mode: {mode}")
    out: dict[str, DataFrame | str] = {}
    current = docs
    for name in stages:
        try:
            if name == "convert":
                out[name] = convert.to_markdown(current, key, "html", converter)
                current = out[name].select(key, F.col("markdown").alias("text"))
            elif name == "quality":
                scored = quality.score(quality.metrics(current))
                out[name] = scored if mode == "stats" else quality.filter_reasons(scored, **limits)
                if mode != "stats":
                    current = quality.split(out[name])[0].select(key, "text")
            elif name == "compress":
                out[name] = compress(current, key=key, max_tokens=max_tokens)
                current = out[name].where("status = 'completed'").select(F.col("file").alias(key), F.col("output").alias("text"))
            elif name == "questions":
                out[name] = generate_questions(current, key=key, max_tokens=max_tokens)
            else:
                raise ValueError(f"unknown stage: {name}")
        except Exception as e:  # noqa: BLE001
            out[name] = f"failed: {e}"
    return out


__all__ = ["compress", "compress_batch", "existing_states", "generate_questions", "questions_batch", "questions_dry_run", "run_all", "sections"]
