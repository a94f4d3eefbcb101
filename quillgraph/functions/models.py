"""Contracts of models that are called in batches, with deterministic offline stand-ins."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from typing import Protocol

import numpy as np


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> np.ndarray: ...


class Reranker(Protocol):
    def scores(self, query: str, texts: list[str]) -> list[float]: ...


class HashEmbedder:
    def embed(self, texts: list[str]) -> np.ndarray:
        from quillgraph.operators.chunking import hash_embed

        return hash_embed(texts)


class ClientEmbedder:
    """Calls an embedding function in small batches: texts are cut to max_chars, blank ones are zero vectors."""

    def __init__(self, call: Callable[[list[str]], list[list[float]]], batch: int = 10, max_chars: int = 6000):
        self.call, self.batch, self.max_chars = call, min(batch, 10), max_chars

    def embed(self, texts: list[str]) -> np.ndarray:
        full = [(i, t[: self.max_chars]) for i, t in enumerate(texts) if t.strip()]
        got = [v for at in range(0, len(full), self.batch) for v in self.call([t for _, t in full[at : at + self.batch]])]
        out = np.zeros((len(texts), len(got[0]) if got else 1), np.float32)
        for (i, _), v in zip(full, got, strict=True):
            out[i] = v
        return out


class OverlapReranker:
    """Share of the query's words that a text holds."""

    def scores(self, query: str, texts: list[str]) -> list[float]:
        q = set(re.findall(r"\w+", query.lower()))
        return [len(q & set(re.findall(r"\w+", t.lower()))) / max(1, len(q)) for t in texts]


class _Loaded:
    """A model that each worker process loads when it is first called; what is sent to workers is only how to load it."""

    def __init__(self, load: Callable[[], Callable]):
        self.load, self._model = load, None

    def __getstate__(self) -> dict:
        return {"load": self.load, "_model": None}

    @property
    def model(self) -> Callable:
        if self._model is None:
            self._model = self.load()
        return self._model


class LocalEmbedder(_Loaded):
    """An embedding model on the worker: load() gives a function from texts to vectors."""

    def embed(self, texts: list[str]) -> np.ndarray:
        return np.asarray(self.model(texts), np.float32) if texts else np.zeros((0, 1), np.float32)


class PairReranker(_Loaded):
    """A cross-encoder on the worker: load() gives a function from (query, text) pairs to scores."""

    def scores(self, query: str, texts: list[str]) -> list[float]:
        return [float(s) for s in self.model([(query, t) for t in texts])] if texts else []


def embedder(provider: str, call: Callable | None = None) -> Embedder:
    if provider == "hash":
        return HashEmbedder()
    if provider == "local" and call:
        return LocalEmbedder(call)
    if provider == "client" and call:
        return ClientEmbedder(call)
    raise ValueError(f"unknown embedding provider: {provider}")


def reranker(provider: str, scores: Callable[[str, list[str]], list[float]] | None = None) -> Reranker:
    if provider == "overlap":
        return OverlapReranker()
    if provider == "cross-encoder" and scores:
        return PairReranker(scores)
    if provider == "client" and scores:
        return type("ClientReranker", (), {"scores": staticmethod(scores)})()
    raise ValueError(f"unknown rerank provider: {provider}")


#: Limits of a rerank call: documents, estimated tokens (two a character, the query counted first), characters a document.
RERANK_DOCS, RERANK_TOKENS, RERANK_CHARS = 500, 120_000, 4_000


def rerank_batches(query: str, texts: list[str], max_docs: int = RERANK_DOCS, max_tokens: int = RERANK_TOKENS) -> list[list[int]]:
    """Places of the texts of each call: the longest ranges of at most max_docs texts whose running costs fit what the query leaves
    of max_tokens; a text that doesn't fit alone has a call of its own."""
    running = np.concatenate([[0], np.cumsum([2 * min(len(t), RERANK_CHARS) for t in texts], dtype=np.int64)])
    room = max_tokens - 2 * len(query)
    calls, at = [], 0
    while at < len(texts):
        reach = int(np.searchsorted(running, running[at] + room, side="right")) - 1
        end = max(at + 1, min(reach, at + max_docs))
        calls.append(list(range(at, end)))
        at = end
    return calls


def rerank_all(query: str, texts: list[str], call: Callable[[str, list[str]], list[float]], top_k: int) -> list[tuple[int, float | None]]:
    """(place, score) of the best texts over all calls; texts of a failing call are left out, and if all fail the first
    top_k stay in their order without a score."""
    found: list[tuple[int, float]] = []
    for places in rerank_batches(query, texts):
        try:
            found += zip(places, call(query, [texts[i][:RERANK_CHARS] for i in places]), strict=True)
        except Exception:  # noqa: BLE001  a client's failure drops its batch
            continue
    if not found:
        return [(i, None) for i in range(min(top_k, len(texts)))]
    return sorted(found, key=lambda x: -x[1])[:top_k]


def with_retries(call: Callable[[str], str], tries: int = 3, wait: Callable[[float], None] = time.sleep, fatal: tuple[int, ...] = (401, 402)) -> Callable[[str], str]:
    """Tries a call up to so many times with doubling waits; errors with a fatal status, or
    that say of themselves that they are fatal, are raised at once."""

    def run(prompt: str) -> str:
        for k in range(tries):
            try:
                return call(prompt)
            except Exception as e:  # noqa: BLE001
                if getattr(e, "fatal", False) or getattr(e, "status", None) in fatal or k == tries - 1:
                    raise
                wait(2.0**k)
        raise AssertionError

    return run
