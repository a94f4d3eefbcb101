"""Toxicity by noisy-channel deobfuscation.

Written tokens that look disguised (letters mixed with leetspeak, single letters with separators between them,
letters three or more times in a row) become lattices: each sign may stand for itself, for the letters that
leetspeak uses it for, for nothing (a repeat, a separator) or for a word's end. A Viterbi search over the lattice
under a character trigram model finds the likeliest restored text. The restored text, in which disguised tokens are
replaced, is then scored by logistic regression over words and word beginnings learned from restored texts.
"""

from __future__ import annotations

import math
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _TABLE, LOWER, Scratch, Words, _pow, flat, mix, pieces, read, shingles, ship

#: What leetspeak writes for letters.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "li", "+": "t",
}
SEPARATORS = " .-_*"
#: Lengths in bytes of the word beginnings that are features.
BEGINNINGS = (4, 5, 6, 7, 8)
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[97:123] = True
_IS_LETTER[128:] = True
_NOT_LETTER = ~_IS_LETTER
_IS_LEET = np.zeros(256, bool)
_IS_LEET[[ord(c) for c in "0123456789@$|+"]] = True
_IS_INNER = np.zeros(256, bool)
_IS_INNER[[ord(c) for c in "!.-_*"]] = True
_TABLE_BITS = 20
#: Restored tokens and trigram costs that a worker keeps; when there are more it starts anew.
MEMORY = 50_000


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and for the letters of U+00C0 to U+00DE (two bytes in UTF-8)."""
    out = LOWER[data]
    if len(out) > 1:
        big = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][big] += 32
    return out


class CharModel:
    """Interpolated byte trigrams; 32 is the border of words."""

    def __init__(self, counts: dict[int, int]):
        self.three = counts
        self.two: dict[int, int] = {}
        self.pair: dict[int, int] = {}
        self.one: dict[int, int] = {}
        for k, n in counts.items():
            self.two[k >> 8] = self.two.get(k >> 8, 0) + n
            self.pair[k & 0xFFFF] = self.pair.get(k & 0xFFFF, 0) + n
            self.one[k & 0xFF] = self.one.get(k & 0xFF, 0) + n
        self.mid: dict[int, int] = {}
        for k, n in self.pair.items():
            self.mid[k >> 8] = self.mid.get(k >> 8, 0) + n
        self.all = sum(self.one.values())
        self.seen: dict[int, float] = {}

    def logp(self, a: int, b: int, c: int) -> float:
        k = a << 16 | b << 8 | c
        found = self.seen.get(k)
        if found is None:
            p = (self.one.get(c, 0) + 0.5) / (self.all + 128)
            p = (self.pair.get(b << 8 | c, 0) + 5 * p) / (self.mid.get(b, 0) + 5)
            p = (self.three.get(k, 0) + 5 * p) / (self.two.get(a << 8 | b, 0) + 5)
            if len(self.seen) > MEMORY:
                self.seen.clear()
            found = self.seen[k] = math.log(p)
        return found


#: Channel: how likely a sign stands for something else than itself.
_SELF, _LEET, _RAW_LEET, _REPEAT, _JOIN, _BREAK = (math.log(p) for p in (0.98, 0.9, 0.1, 0.02, 0.7, 0.3))


def emitted(sign: int) -> list[tuple[int, float]]:
    """What a sign may stand for, with its cost: a byte, or -1 for nothing."""
    c = chr(sign)
    if c in SEPARATORS:
        return [(-1, _JOIN), (32, _BREAK)]
    if c in LEET:
        return [(ord(x), _LEET - math.log(len(LEET[c]))) for x in LEET[c]] + [(sign, _RAW_LEET)]
    return [(sign, _SELF)]


def viterbi(token: bytes, lm: CharModel, settle: int = 512) -> bytes:
    """The likeliest text behind a disguised token (lower case). States are the last two restored bytes.

    A place keeps a number a state: the state before and what was emitted. Every `settle` places the paths of all states are followed
    back to where they meet; what lies before is decided, given out and forgotten, so a token of any length takes little memory."""
    states, scores = [(32, 32)], [0.0]
    back: list[array] = []
    out = bytearray()

    def trace(i: int, until: int) -> bytes:
        found = bytearray()
        for came in reversed(back[:until]):
            i, c = came[i] >> 9, (came[i] & 511) - 1
            if c >= 0:
                found.append(c)
        return bytes(found[::-1])

    for x in token:
        emits = emitted(x)
        following: dict[tuple[int, int], int] = {}
        after, came = [], array("I")

        def reach(state, score, i, c):
            at = following.get(state)  # noqa: B023
            if at is None:
                following[state] = len(after)  # noqa: B023
                after.append(score)  # noqa: B023
                came.append(i << 9 | c + 1)  # noqa: B023
            elif score > after[at]:  # noqa: B023
                after[at], came[at] = score, i << 9 | c + 1  # noqa: B023

        for i, ((a, b), score) in enumerate(zip(states, scores, strict=True)):
            for c, cost in emits:
                if c < 0:
                    reach((a, b), score + cost, i, -1)
                else:
                    if c == b:  # a repeat of what has been restored: it may be nothing
                        reach((a, b), score + _REPEAT, i, -1)
                    reach((b, c), score + cost + lm.logp(a, b, c), i, c)
        states, scores = list(following), after
        back.append(came)
        if len(back) % settle == 0:
            alive, t = set(range(len(states))), len(back)
            while t and len(alive) > 1:
                t -= 1
                alive = {back[t][i] >> 9 for i in alive}
            if t:
                out += trace(alive.pop(), t)
                del back[:t]
    last = max(range(len(states)), key=lambda i: (scores[i] + lm.logp(*states[i], 32), states[i]))
    return bytes(out + trace(last, len(back))).strip()


_spelled = re.compile(rb"[^ .\-_*](?:[ .\-_*][^ .\-_*]){2,}")
_triple = re.compile(rb"([a-z\x80-\xff])\1\1")


class Restorer:
    """Finds disguised tokens of texts and restores them; keeps what it has restored."""

    def __init__(self, lm: CharModel):
        self.lm, self.known = lm, {}

    def token(self, raw: bytes) -> bytes | None:
        """The restored text of a token, None if it isn't disguised."""
        found = self.known.get(raw, b"")
        if found != b"":
            return found
        core = raw.strip(b".,;:?*%&#\"'()[]{}<>/-_").rstrip(b"!")
        if core.endswith(b"$$"):
            core = core.rstrip(b"$")
        letters = sum(97 <= x < 123 or x >= 128 for x in core)
        out = None
        if letters:
            if _spelled.fullmatch(core) or _triple.search(core):
                out = viterbi(core, self.lm)
            elif any(chr(x) in LEET for x in core) or re.search(rb"[a-z]{1,3}[.\-_*][a-z]{1,3}", core):
                out = viterbi(core, self.lm)
            if out == core:
                out = None
        if len(raw) <= 64:
            if len(self.known) > MEMORY:
                self.known.clear()
            self.known[raw] = out
        return out

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], list[int], list[tuple[int, int]]]:
        """Restored tokens of lower-case texts, the text of each, and where what was written stands."""
        words = Words(data, offsets)
        if not len(words.start):
            return [], [], []
        letter, leet, inner = (np.append(0, np.cumsum(t[data])) for t in (_IS_LETTER, _IS_LEET, _IS_INNER))
        triple = np.zeros(len(data), np.int64)
        if len(data) > 2:
            triple[:-2] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & _IS_LETTER[data[:-2]]
        triple = np.append(0, np.cumsum(triple))
        s, e = words.start, words.end
        has = letter[e] > letter[s]
        odd = has & ((leet[e] > leet[s]) | (triple[np.maximum(e - 2, s)] > triple[s]) | (inner[np.maximum(e - 2, s)] > inner[np.minimum(s + 1, e)]))
        buf = data.tobytes()
        out, docs, spans = [], [], []
        for i in np.flatnonzero(odd):
            got = self.token(buf[s[i] : e[i]])
            if got:
                out.append(got)
                docs.append(int(words.doc[i]))
                spans.append((int(s[i]), int(e[i])))
        # Three or more tokens of one sign each, in a row: a spelled word
        lone = (e - s) == 1
        lone &= _IS_LETTER[data[s]] | _IS_LEET[data[s]] | (data[s] == 33)
        edge = np.diff(np.concatenate([[0], lone.astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
            cuts = np.flatnonzero(np.diff(words.doc[a:b])) + a + 1
            for x, y in zip([a, *cuts], [*cuts, b], strict=True):
                if y - x >= 3:
                    got = self.token(b" ".join(buf[s[i] : s[i] + 1] for i in range(x, y)))
                    if got:
                        out.append(got)
                        docs.append(int(words.doc[x]))
                        spans.append((int(s[x]), int(e[y - 1])))
        return out, docs, spans


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and word beginnings of lower-case texts, and the text of each."""
    words = Words(data, offsets, _NOT_LETTER)
    if not len(words.start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _pow(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=total[1:])
    s, e = words.start, words.end
    long = e - s >= 3
    hashes, docs = [mix((total[e[long]] - total[s[long]]) * down[s[long]])], [words.doc[long]]
    for n in BEGINNINGS:
        ok = e - s > n
        hashes.append(mix((total[s[ok] + n] - total[s[ok]]) * down[s[ok]] + np.uint64(n)))
        docs.append(words.doc[ok])
    return np.concatenate(hashes), np.concatenate(docs)


def all_features(texts: pa.Array, restorer: Restorer | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of texts; with a restorer those of the restored texts, in which disguised tokens are replaced."""
    data, offsets = flat(texts)
    data = lowered(data)
    found, docs, spans = restorer.find(data, offsets) if restorer is not None else ([], [], [])
    for a, b in spans:
        data[a:b] = 32
    h, d = features(data, offsets)
    if found:
        more = np.frombuffer(b"".join(found), np.uint8)
        bounds = np.append(0, np.cumsum([len(x) for x in found]))
        h2, d2 = features(more, bounds)
        h, d = np.concatenate([h, h2]), np.concatenate([d, np.asarray(docs)[d2]])
    return h, d


class Lexicon:
    """Looks hashes up in a small sorted array, after a bit table has turned most away."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))
        self.maybe = np.zeros(1 << _TABLE_BITS, bool)
        self.maybe[(self.hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True

    def match(self, h: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, place in the lexicon)."""
        if not len(self.hashes) or not len(h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ok = self.maybe[(h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]
        h, d = h[ok], d[ok]
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        ok = self.hashes[at] == h
        key = np.unique(d[ok] * np.int64(len(self.hashes)) + at[ok])
        return key // len(self.hashes), key % len(self.hashes)


def fit_logistic(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, n_features: int, l2: float = 2.0, steps: int = 300) -> tuple[float, np.ndarray]:
    """Logistic regression on 0/1 features (row and column of each 1), by gradient steps with per-weight scale."""
    w, b = np.zeros(n_features), math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    gw, gb = np.full(n_features, 1e-8), 1e-8
    for _ in range(steps):
        z = b + np.bincount(rows, weights=w[cols], minlength=len(y))
        g = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - y
        dw = np.bincount(cols, weights=g[rows], minlength=n_features) + l2 * w
        gw += dw * dw
        gb += g.sum() ** 2
        w -= 0.3 * dw / np.sqrt(gw)
        b -= 0.3 * g.sum() / math.sqrt(gb)
    return float(b), w


def held_out(id_col: str):
    """The fold that is never learned from: crc32 of the id as text is divisible by 5."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0


def together(held: list) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal keys added up."""
    k, back = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
    return k, np.bincount(back, weights=np.concatenate([n for _, n in held]), minlength=len(k)).astype(np.int64)


class Model:
    def __init__(self, bias: float, hashes: np.ndarray, weights: np.ndarray, trigrams: dict[int, int]):
        self.bias, self.hashes, self.weights, self.trigrams = bias, hashes, weights, trigrams


def train(docs: DataFrame, labels: DataFrame, max_training_rows: int = 40_000, max_candidates: int = 100_000, max_features: int = 1_000, max_trigrams: int = 100_000, ratio: float = 8.0) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic. The character model counts the byte trigrams of all documents (the
    max_trigrams commonest are kept, of ties the smaller; others are backed off). The classifier learns from the restored texts of labelled rows outside the
    held-out fold: all, or a hash sample of about max_training_rows. Of texts that share their smallest shingle hash (copies) one counts,
    so that a group of copies is no evidence for all of its words. Candidates are the max_candidates commonest features of toxic
    texts; those `ratio` times commoner there than in others are ranked by their evidence, and the best max_features are learned."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    if n > max_training_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * max_training_rows / n) + 1)
    known = scratch.table(known.coalesce(1))  # at most about max_training_rows rows of 12 bytes
    sample = scratch.table(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id"))

    def smallest(batches):
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                words = Words(*flat(batch.column(1).slice(a, b - a)))
                h, d = shingles(words, words.hashes())
                least = np.zeros(b - a, np.uint64)
                bounds = np.searchsorted(d, np.arange(b - a))
                full = np.diff(np.append(bounds, len(d))) > 0
                if full.any():
                    least[full] = np.minimum.reduceat(h, bounds[full])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(least.view(np.int64))], ["doc_id", "least"])

    firsts = sample.select("doc_id", "text").mapInArrow(smallest, "doc_id long, least long").groupBy("least").agg(F.min("doc_id").alias("doc_id"))
    rows = sample.join(F.broadcast(scratch.table(firsts.select("doc_id").distinct().coalesce(1))), "doc_id")

    def count(only: Lexicon | None):
        def run(batches):
            restorer = Restorer(CharModel(lm))
            for batch in batches:
                for a, b in pieces(batch.column(0)):
                    h, d = all_features(batch.column(0).slice(a, b - a), restorer)
                    if only is None:
                        order = np.lexsort((h, d))
                        h, d = h[order], d[order]
                        new = np.ones(len(h), bool)
                        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                        h = h[new]
                    else:
                        h = only.hashes[only.match(h, d)[1]]
                    value, times = np.unique(h, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(times.astype(np.int64))], ["h", "n"])

        return run

    def trigrams(batches):
        held, size = [], 0
        for batch in batches:
            for a, b in pieces(batch.column(0)):
                data, _ = flat(batch.column(0).slice(a, b - a))
                data = lowered(data)
                data = np.where(_IS_LETTER[data], data, 32).astype(np.uint32)
                data = np.concatenate([np.full(2, 32, np.uint32), data, np.full(1, 32, np.uint32)])
                one, two, three = data[:-2], data[1:-1], data[2:]
                one = np.where(two == 32, np.uint32(32), one)  # a word's first letter follows two borders
                k = (one << np.uint32(16) | two << np.uint32(8) | three)[(two != 32) | (three != 32)]
                k = np.sort(k)
                at = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
                held.append((k[at], np.diff(np.append(at, len(k)))))
                size += len(at)
                if size > 500_000:
                    held = [together(held)]
                    size = len(held[0][0])
        if held:
            k, n = together(held)
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(n.astype(np.int64))], ["k", "n"])

    grams = docs.select("text").mapInArrow(trigrams, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "k").limit(max_trigrams).toPandas()
    lm = dict(zip(grams["k"].tolist(), grams["n"].tolist(), strict=True))
    totals = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        bias = math.log((n1 + 0.5) / (n0 + 0.5)) if n1 + n0 else math.log(0.05)
        return Model(bias, np.zeros(0, np.uint64), np.zeros(0), lm)
    bad = rows.where("toxic = 1").select("text").mapInArrow(count(None), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    bad = bad.where(F.col("n") >= max(3, n1 // 1000)).orderBy(F.desc("n"), "h").limit(max_candidates).toPandas()
    lex = Lexicon(bad["h"].to_numpy(np.int64).view(np.uint64))
    good = rows.where("toxic = 0").select("text").mapInArrow(count(lex), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).toPandas()
    c1 = dict(zip(bad["h"], bad["n"], strict=True))
    c0 = dict(zip(good["h"], good["n"], strict=True))
    ranked = []
    for h, k1 in c1.items():
        p1, p0 = (k1 + 0.5) / (n1 + 1), (c0.get(h, 0) + 0.5) / (n0 + 1)
        if p1 >= ratio * p0:
            ranked.append((-k1 * math.log(p1 / p0), h))
    chosen = Lexicon(np.array([h for _, h in sorted(ranked)[:max_features]], np.int64).view(np.uint64))
    def presence(batches):
        restorer = Restorer(CharModel(lm))
        for batch in batches:
            for a, b in pieces(batch.column(0)):
                doc, place = chosen.match(*all_features(batch.column(0).slice(a, b - a), restorer))
                split = np.split(place, np.searchsorted(doc, np.arange(1, b - a)))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.array([x.tolist() for x in split], pa.list_(pa.int32()))], ["toxic", "on"])

    # One short row for each training row: their number is bounded
    table = rows.select("text", "toxic").mapInArrow(presence, "toxic int, on array<int>").groupBy("toxic", "on").count().orderBy("toxic", "on").collect()
    y = np.repeat([r.toxic for r in table], [r["count"] for r in table]).astype(float)
    each = [r.on for r in table for _ in range(r["count"])]
    at = np.repeat(np.arange(len(each)), [len(x) for x in each])
    cols = np.array([c for x in each for c in x], np.int64)
    bias, weights = fit_logistic(at, cols, y, len(chosen.hashes))
    scratch.drop(known, sample)
    return Model(bias, chosen.hashes, weights, lm)


def score(docs: DataFrame, model: Model, restored: bool = False, carry: bool = False) -> DataFrame:
    """doc_id, score of every whole text; with restored=True also the restored tokens; with carry=True score after all
    columns of docs."""
    ship(docs.sparkSession)

    def run(batches):
        lex, restorer = Lexicon(model.hashes), Restorer(CharModel(model.trigrams))
        for batch in batches:
            for a, b in pieces(batch.column("text")):
                texts = batch.column("text").slice(a, b - a)
                doc, place = lex.match(*all_features(texts, restorer))
                z = model.bias + np.bincount(doc, weights=model.weights[place], minlength=b - a)
                columns = batch.slice(a, b - a).columns if carry else [batch.column("doc_id").slice(a, b - a).cast(pa.int64())]
                columns.append(pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500)))))
                if restored:
                    data, offsets = flat(texts)
                    rows: list[list[str]] = [[] for _ in range(b - a)]
                    for x, d, _ in zip(*restorer.find(lowered(data), offsets), strict=True):
                        rows[d].append(x.decode("utf-8", "replace"))
                    columns.append(pa.array(rows, pa.list_(pa.string())))
                yield pa.RecordBatch.from_arrays(columns, names)

    chosen = docs if carry else docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = T.StructType([*(chosen.schema if carry else chosen.schema[:1]), T.StructField("score", T.DoubleType())])
    if restored:
        schema.add("restored", T.ArrayType(T.StringType()))
    names = schema.fieldNames()
    return chosen.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_training_rows: int = 40_000) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Scores use the text alone. The model is of bounded size (at most 1,000 features and 100,000 trigrams) and travels
    with the code; the corpus is never shuffled. Defined results: a null or empty text gets the score of a text
    without any learned feature; a very long text is read whole, in a block of its own; a score of 0.5 is predicted toxic; null labels are not learned from, of several labels of a document the highest
    counts; with labels of one kind only, or none, all texts get the same score; rows that repeat score alike;
    a null doc_id is not held out; other columns are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = train(d, labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("toxic")), max_training_rows)
    return score(d, model).select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", F.expr("int(score >= 0.5)").alias("predicted"))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
