"""Sentences, semantic chunks, sections and offsets."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import batches
from quillgraph.functions import text as T

# Fixed value: where a sentence ends (no split after abbreviations like x.y. or Mr.; what follows starts a sentence).
SENTENCE_END = r"(?<!\w\.\w.)(?<![A-Z][a-z]\.)(?<![A-Z]\.)(?<=[.?!\n])\s+(?=[A-Z\"'(])"
DIMENSIONS = 64


def sentences(text: str = "text") -> Column:
    """Stripped sentences without empty ones; the stripped text itself if there are none."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = F.filter(F.transform(F.split(t, "(?U)" + SENTENCE_END, -1), T.strip), lambda s: s != "")
    return F.when(F.size(found) > 0, found).otherwise(F.array(T.strip(t)))


def section_chunks(docs: DataFrame, max_tokens: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sections split before second-level headings (before first-level ones if there is none), packed up to max_tokens. A
    text that starts with a second-level heading has an empty first piece, which counts for the fallback."""
    t = F.coalesce(F.col(text), F.lit(""))
    by = lambda mark: F.split(t, f"(?md)(?=^{mark}[{T.SPACE}])", -1)
    two, one = by("##"), by("#")
    starts = lambda mark: t.rlike(f"^{mark}[{T.SPACE}]").cast("int")
    pieces = F.when(F.size(two) + starts("##") > 1, two).otherwise(one)
    packed = T.pack(pieces, F.transform(pieces, T.estimate_tokens), max_tokens, "\n")
    kept = F.filter(F.transform(packed, T.strip), lambda s: s != "")
    df = docs.select(key, F.when(F.size(kept) > 0, kept).otherwise(F.array(t)).alias("c"))
    return df.select(key, F.posexplode("c").alias("chunk_seq", "text"))


def pack_groups(groups: list[str], min_size: int, max_size: int) -> list[str]:
    """Joins groups to chunks. From the sums of the groups' sizes it is looked up how far a chunk reaches: all groups whose sizes,
    with the spaces inside what stands before the last one, stay within max_size, and one at least. A chunk under min_size
    belongs to the one before it; a group is never cut."""
    full = [g for g in groups if g]
    ends = [0, *accumulate(len(g) + 1 for g in full)]
    cuts = [0]
    while cuts[-1] < len(full):
        cuts.append(max(cuts[-1] + 1, bisect_right(ends, ends[cuts[-1]] + max_size + 2) - 1))
    sizes = [ends[b] - ends[a] - 1 for a, b in pairwise(cuts)]
    starts = [a for i, (a, size) in enumerate(zip(cuts, sizes, strict=False)) if not i or size >= min_size]
    return [" ".join(full[a:b]) for a, b in pairwise([*starts, len(full)])] if full else []


def offsets(text: str, chunks: list[str]) -> list[tuple[int, int]]:
    """The span of each chunk: it starts where its first 20 characters are next found, or where the last span ends."""

    def after(last: tuple[int, int], chunk: str) -> tuple[int, int]:
        found = text.find(chunk[:20], last[1])
        return (start := found if found >= 0 else last[1]), start + len(chunk)

    return list(accumulate(chunks, after, initial=(0, 0)))[1:]


@lru_cache(maxsize=50_000)
def _place(word: str) -> int:
    """A word's dimension, and after as many again those of words that count -1."""
    h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
    return h % DIMENSIONS + (0 if h >> 32 & 1 else DIMENSIONS)


def hash_embed(texts: list[str]) -> np.ndarray:
    """The offline embedder: signed feature hashing of words and their neighbours, of length 1; a blank text is zero."""
    places = [np.fromiter((_place(m[0]) for m in re.finditer(r"\w+", t.lower())), np.int64) for t in texts]
    at = np.concatenate([np.zeros(0, np.int64), *(p + i * 2 * DIMENSIONS for i, p in enumerate(places))])
    both = np.bincount(at, minlength=len(texts) * 2 * DIMENSIONS).reshape(len(texts), 2, DIMENSIONS)
    out = (both[:, 0] - both[:, 1]).astype(np.float32)
    n = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, n, out=out, where=n > 0)


def split_text(text: str, embed: Callable[[list[str]], np.ndarray], threshold: float = 0.75, min_size: int = 50, max_size: int = 2000) -> list[tuple[str, int, int]]:
    """Semantic chunks of a text with their offsets: sentences are cut apart where neighbours are less alike than the
    threshold, then packed."""
    parts = [s.strip() for s in re.split(SENTENCE_END, text) if s.strip()]
    if not parts:
        return []
    groups = [[parts[0]]]
    if len(parts) > 1:
        e = np.asarray(embed(parts), np.float64)
        n = np.linalg.norm(e, axis=1)
        for i in range(1, len(parts)):
            d = n[i - 1] * n[i]
            alike = float(e[i - 1] @ e[i] / d) if d else 0.0
            if alike < threshold:
                groups.append([])
            groups[-1].append(parts[i])
    chunks = pack_groups([" ".join(g) for g in groups], min_size, max_size)
    return [(c, a, b) for c, (a, b) in zip(chunks, offsets(text, chunks), strict=True)]


def semantic_chunks(docs: DataFrame, source: str = "source", text: str = "text", embed: Callable[[list[str]], np.ndarray] = hash_embed, threshold: float = 0.75, min_size: int = 50, max_size: int = 2000) -> DataFrame:
    """chunk_id, source, chunk_seq, start_idx, end_idx, text, embedding of every document. The fold is sequential within a
    document, so it runs as an Arrow batch function without a shuffle; about 1 MB of texts are chunked and embedded together."""

    def run(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in batches.pieces(arrived, "text"):
            rows = []
            for s, t in zip(*(piece[c].to_numpy(zero_copy_only=False) for c in ("source", "text")), strict=True):
                for seq, (c, a, b) in enumerate(split_text(t or "", embed, threshold, min_size, max_size)):
                    rows.append((f"{s}:{a}-{b}", s, seq, a, b, c))
            if not rows:
                continue
            columns = list(zip(*rows, strict=True))
            e = np.asarray(embed(list(columns[-1])), np.float32)
            columns.append(pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * e.shape[1], e.reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns[:-1], types, strict=True)] + columns[-1:], names)

    batches.bounded(docs.sparkSession)
    names = ["chunk_id", "source", "chunk_seq", "start_idx", "end_idx", "text", "embedding"]
    types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
    schema = "chunk_id string, source string, chunk_seq int, start_idx int, end_idx int, text string, embedding array<float>"
    return docs.select(F.col(source).cast("string").alias("source"), F.col(text).alias("text")).mapInArrow(run, schema)
