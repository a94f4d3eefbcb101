"""Byte-level BPE by traversal of a prefix trie.

All distinct words of a block of texts are put in order, so that going through them is a depth-first walk
of their trie. A trie node's state is the last token of the encoding of its prefix; it is computed once,
from the states of shorter prefixes on the path: the encoding of a prefix ends with the one token that is a
suffix of it and that may follow the last token of what stands before. Two tokens may follow each other if
no merge across their border comes before the merges that made them. Words that share a prefix share the
states of that prefix. A word's tokens are read back from its node.
"""

from __future__ import annotations

import hashlib
import json
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, read, ship

SPECIAL_DECODE = "replace"
#: Words kept with their tokens by a worker process, twice: when the younger memory is full it becomes the older one, from
#: which words in use come back, and what was in the older one is forgotten.
MEMORY_WORDS = 300_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, by the public rule:
    printable Latin-1 stands for itself, all others take the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieEncoder:
    """Encodes and decodes with a tokenizers JSON file of byte-level BPE."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in spec["model"]["vocab"]}
        self.vocab = {raw[t]: i for t, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        size = max(self.bytes_of) + 1
        self.made, self.left, self.right = [-1] * size, [0] * size, [0] * size
        self.rank: dict[int, int] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            x, y = self.vocab[raw[a]], self.vocab[raw[b]]
            self.rank[x << 32 | y] = r
            z = self.vocab[raw[a] + raw[b]]
            if self.made[z] < 0:
                self.made[z], self.left[z], self.right[z] = r, x, y
        self.longest: dict[int, int] = {}
        for b in self.vocab:
            self.longest[b[-1]] = max(self.longest.get(b[-1], 0), len(b))
        # Fixed value: the public pattern that splits text before the merges.
        self.find = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""").findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def may_follow(self, a: int, b: int) -> bool:
        """Whether encoding the bytes of a and b together gives a, b. Undoes the latest merges at the border
        one by one; a merge across it that came before the one undone would have taken place."""
        key = a << 32 | b
        found = self.pairs.get(key)
        if found is None:
            bound, made, rank = 1 << 60, self.made, self.rank
            while True:
                r = rank.get(a << 32 | b)
                if r is not None and r < bound:
                    found = False
                    break
                ra, rb = made[a], made[b]
                if ra < 0 and rb < 0:
                    found = True
                    break
                if ra > rb:
                    bound, a = ra, self.right[a]
                else:  # of equal merges the left one comes first, so one across the border wins a tie
                    bound, b = rb + 1, self.left[b]
            if len(self.pairs) > 500_000:
                self.pairs.clear()
            self.pairs[key] = found
        return found

    def walk(self, words) -> dict[str, bytes]:
        """Distinct words to their token ids (packed as 32-bit integers), by a depth-first walk of their trie."""
        get, longest, may_follow, bytes_of = self.vocab.get, self.longest, self.may_follow, self.bytes_of
        out: dict[str, bytes] = {}
        before, last = b"", [-1]  # last[d]: last token of the prefix of d bytes on the current path
        for word, text in sorted((w.encode(), w) for w in words):
            n, shared = len(word), 0
            top = min(n, len(before))
            while shared < top and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :]
            for d in range(shared + 1, n + 1):
                # Only one token can be the last, so the order of trying is free: the last one grown by this byte comes first
                grown = len(bytes_of[last[d - 1]]) + 1 if d > 1 else 1
                t = get(word[d - grown : d])
                if t is not None and (grown == d or may_follow(last[d - grown], t)):
                    last.append(t)
                    continue
                for size in range(1, min(d, longest[word[d - 1]]) + 1):
                    t = get(word[d - size : d])
                    if t is not None and size != grown and (size == d or may_follow(last[d - size], t)):
                        last.append(t)
                        break
            ids, d = [], n
            while d:
                ids.append(last[d])
                d -= len(bytes_of[last[d]])
            out[text] = array("I", ids[::-1]).tobytes()
            before = word
        return out

    def _parts(self, text: str) -> list[str]:
        return self.cut(text) if self.cut and "<" in text else [text]

    def encode_block(self, texts: list[str]) -> list[bytes]:
        """The packed token ids of each text."""
        split = []
        for text in texts:
            split.append([(p, None) if p in self.special else (p, self.find(p)) for p in self._parts(text)])
        if len(self.known) > MEMORY_WORDS:
            self.known, self.older = {}, self.known
        new = {w for parts in split for _, ws in parts if ws for w in ws} - self.known.keys()
        back = new & self.older.keys()
        self.known.update((w, self.older[w]) for w in back)
        self.known.update(self.walk(new - back))
        of = self.known.__getitem__
        return [b"".join(array("I", [self.special[p]]).tobytes() if ws is None else b"".join(map(of, ws)) for p, ws in parts) for parts in split]

    def decode(self, packed: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(packed).cast("I"))).decode("utf-8", SPECIAL_DECODE)


_encoders: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    """One per worker process, so that its words are kept from task to task."""
    if path not in _encoders:
        _encoders[path] = TrieEncoder(path)
    return _encoders[path]


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """Encodes and decodes every whole text; with ids=True the token ids are returned too.

    vocabulary: path of a tokenizers JSON file that all machines can read; it is a parameter and never copied.
    Returns doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids). No shuffle: each partition is encoded
    on its own, in blocks of about 1 MB of text. Defined results: a null or empty text has no tokens and
    the digests of nothing; a very long text is encoded whole, in a block of its own; strings of special tokens become their ids;
    rows that repeat are each encoded; of tokens that could end a prefix just one is allowed, so there are no ties; other columns are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids

    def run(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            texts, keys = batch.column(1), batch.column(0)
            for a, b in pieces(texts):
                packed = enc.encode_block([t or "" for t in texts.slice(a, b - a).to_pylist()])
                columns = [
                    keys.slice(a, b - a).cast(pa.int64()),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    pa.array([hashlib.sha256(enc.decode(p).encode()).hexdigest() for p in packed]),
                ]
                if ids:
                    columns.append(pa.array([list(memoryview(p).cast("I")) for p in packed], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def production_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents"), production_vocabulary())
