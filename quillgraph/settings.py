"""Settings: nested dataclasses read from a dict or a YAML-like file, with environment fall-backs for secrets."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields, is_dataclass


@dataclass
class Similarity:
    strategy: str = "cosine"


@dataclass
class Chunking:
    similarity_threshold: float = 0.75
    min_chunk_size: int = 50
    max_chunk_size: int = 2000


@dataclass
class Embedding:
    provider: str = "hash"
    model: str = ""
    batch_size: int = 32
    max_chars: int = 6000


@dataclass
class Graph:
    community_resolution: float = 1.0
    model_extraction: bool = True
    max_entities_per_chunk: int | None = None
    max_relations_per_chunk: int | None = None


@dataclass
class Retrieval:
    max_entities: int = 10
    max_hops: int = 2
    max_community_results: int = 5
    max_path_hops: int = 50


@dataclass
class Rerank:
    provider: str | None = None
    top_k: int = 5
    retrieve_k: int = 20


@dataclass
class LLM:
    model: str = ""
    temperature: float = 0.3
    max_tokens: int = 2048
    api_key: str = ""
    base_url: str = ""


@dataclass
class Batch:
    save_interval: int = 10
    resume: bool = True
    use_cot: bool = False
    max_consecutive_failures: int = 20


@dataclass
class Preprocessing:
    quality_mode: str = "full"
    min_chars: int = 200
    min_quality_score: float = 0.4
    min_chinese_ratio: float = 0.01
    compress_max_chunk_tokens: int = 24_000
    compress_max_output_tokens: int = 8192
    dataset_questions_per_chunk: int = 5
    pdf_max_pages: int = 20


@dataclass
class Settings:
    similarity: Similarity = field(default_factory=Similarity)
    chunking: Chunking = field(default_factory=Chunking)
    embedding: Embedding = field(default_factory=Embedding)
    graph: Graph = field(default_factory=Graph)
    retrieval: Retrieval = field(default_factory=Retrieval)
    rerank: Rerank = field(default_factory=Rerank)
    llm: LLM = field(default_factory=LLM)
    batch: Batch = field(default_factory=Batch)
    preprocessing: Preprocessing = field(default_factory=Preprocessing)

    @classmethod
    def from_dict(cls, values: dict) -> Settings:
        """Known keys override defaults, unknown ones are ignored; secrets fall back to the environment."""
        out = _fill(cls(), values or {})
        out.llm.api_key = out.llm.api_key or os.environ.get("OPENAI_API_KEY", "")
        out.llm.base_url = out.llm.base_url or os.environ.get("OPENAI_BASE_URL", "")
        return out


def _fill(target, values: dict):
    for f in fields(target):
        if f.name in values:
            own = getattr(target, f.name)
            setattr(target, f.name, _fill(own, values[f.name] or {}) if is_dataclass(own) else values[f.name])
    return target


def parse_yaml(text: str) -> dict:
    """Nested mappings of scalars and lists of scalars: the part of YAML that settings need, for machines without a YAML library."""
    root: dict = {}
    stack: list[tuple[int, dict]] = [(-1, root)]
    lists: dict[int, tuple[dict, str]] = {}  # where the mapping below a key goes, should it be a list
    for raw in text.splitlines():
        line = raw.split(" #")[0].rstrip()
        indent, item = len(line) - len(line.lstrip()), line.strip()
        if item.startswith("- ") and len(stack) > 1:
            while stack[-1][0] > indent:
                stack.pop()
            owner, name = lists[id(stack[-1][1])]
            owner[name] = [*(owner[name] or []), _scalar(item[2:].strip())]
            continue
        if not item or item.startswith("#") or ":" not in line:
            continue
        key, _, value = line.strip().partition(":")
        while stack[-1][0] >= indent:
            stack.pop()
        value = value.strip()
        if not value:
            stack[-1][1][key] = {}
            lists[id(stack[-1][1][key])] = (stack[-1][1], key)
            stack.append((indent, stack[-1][1][key]))
        else:
            stack[-1][1][key] = _scalar(value)
    return root


def _scalar(value: str):
    if value.startswith("[") and value.endswith("]"):
        return [_scalar(x.strip()) for x in value[1:-1].split(",") if x.strip()]
    plain = {"true": True, "false": False, "null": None, "~": None}
    if value.lower() in plain:
        return plain[value.lower()]
    for kind in (int, float):
        try:
            return kind(value)
        except ValueError:
            pass
    return value.strip("\"'")


def load(path: str) -> Settings:
    """Settings of a .json or .yaml file."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    return Settings.from_dict(json.loads(text) if path.endswith(".json") else parse_yaml(text))


def load_env(path: str) -> None:
    """KEY=value lines into the environment; what is set already stays."""
    with open(path, encoding="utf-8") as f:
        for line in f:
            key, eq, value = line.strip().partition("=")
            if eq and not key.startswith("#"):
                os.environ.setdefault(key.strip(), value.strip().strip("\"'"))
