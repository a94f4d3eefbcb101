"""Language-model scores by online logistic mixing of hashed-context predictors.

A text is its lower-case words and an end. The dictionary holds the commonest training words that stand twice at least (a
bounded number); one more entry stands for all other words. Words of the dictionary are coded in context as lm_context
says: expected words from hashed tables of the last one and two words and from the text itself are tried as binary decisions whose predictions are
mixed with gated weights and refined by a table, both of which go on learning along every text; what no context expects is
coded along a Huffman code whose decisions mix the counts of all texts and of the class that the text so far looks like.

A word outside the dictionary costs that entry, and then: whether it repeats one of the text (told online by how often
that was so), else its own share by its exact training count less an absolute discount (matched by a join with the
vocabulary, so all words keep their counts), and what discounts leave, by its spelling: bytes, bit by bit, with predictors
hashed on the last 1, 2, 3 (with the class the word looks like), 4 and 6 bytes, mixed with gated weights and refined. A
spelling is the same wherever the word stands, so it is computed once for each distinct word.

Tables and counts are filled from all training texts. A training text is scored with its own words left out of the
context tables, so that its score can be compared with others. Bounded: the dictionary (max_dictionary), the table of
contexts (2^max_table_bits slots; where contexts meet in a slot, the one whose expected word came most often stays) and the byte
tables. First weights are learned from the decisions of all training texts, of all counts in the dictionary, and of all
words that are spelled.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lm_context
from .common import _R, LOWER, Scratch, Words, flat, merged, mix, pieces, read, ship
from .lm_context import bucket, stretched

#: Bits of the table of each context: last 1, 2, 3, 4, 6 bytes.
TABLE_BITS = (18, 20, 21, 21, 21)
K = len(TABLE_BITS)
_START = np.append(0, np.cumsum([1 << b for b in TABLE_BITS]))
_SALT = mix(np.arange(11, 11 + K).astype(np.uint64))
BUCKETS = 6  # of how often a context has been seen
REFINE = 33
END_HASH = np.uint64(0x5DEECE66D1234567)
_CHUNK = 1 << 16  # small enough for a core's cache
MAX_CLASSES = 7
SHAPES = 1 << 16  # hashed byte trigrams that tell the class of a word
FLOOR = 0.02  # what a class leaves for words that look like another's


def layout(data: np.ndarray, bounds: np.ndarray):
    """Symbols of words with their closing spaces, their place in the word, and the bounds of words."""
    sizes = np.diff(bounds)
    ends = np.cumsum(sizes + 1)
    n = int(ends[-1]) if len(ends) else 0
    sym = np.full(n, 32, np.uint8)
    inside = np.ones(n, bool)
    inside[ends - 1] = False
    sym[inside] = data[bounds[0] : bounds[-1]]
    at = np.arange(n) - np.repeat(ends - sizes - 1, sizes + 1)
    return sym, at, np.append(0, ends)


def contexts(sym: np.ndarray, at: np.ndarray, cls: np.ndarray) -> list[np.ndarray]:
    """The hashes of all contexts of each symbol."""
    out, run = [], np.zeros(len(sym), np.uint64)
    z = (cls.astype(np.uint64) + np.uint64(1)) << np.uint64(58)
    for j in range(1, 7):
        b = np.zeros(len(sym), np.uint64)
        where = np.flatnonzero(at >= j)
        b[where] = sym[where - j].astype(np.uint64) + np.uint64(1)
        run = run | (b << np.uint64(9 * (j - 1)))
        if j in (1, 2, 3):
            out.append(run ^ z)
        elif j in (4, 6):
            out.append(run.copy())
    return out


def shapes(sym: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashed trigrams that end at each symbol."""
    s = sym.astype(np.uint64)
    a, b = np.zeros_like(s), np.zeros_like(s)
    w1, w2 = np.flatnonzero(at >= 1), np.flatnonzero(at >= 2)
    a[w1], b[w2] = s[w1 - 1] + np.uint64(1), s[w2 - 2] + np.uint64(1)
    return (mix(s | (a << np.uint64(9)) | (b << np.uint64(18))) & np.uint64(SHAPES - 1)).astype(np.int64)


def decisions(sym: np.ndarray, ctx: list[np.ndarray]):
    """For each of the 8 bits: the slots of all predictors, and the bit."""
    keyed = [mix(c * np.uint64(_R) + _SALT[k]) for k, c in enumerate(ctx)]
    for nibble in range(2):
        if nibble:
            high = (sym >> 4).astype(np.uint64)
            keyed = [mix(h + (high + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)) for h in keyed]
        base = [((h >> np.uint64(64 - TABLE_BITS[k] + 4)).astype(np.int64) << 4) + _START[k] for k, h in enumerate(keyed)]
        node = np.ones(len(sym), np.int64)
        for i in range(4):
            bit = (sym >> (7 - 4 * nibble - i)) & 1
            yield [b + node for b in base], bit
            node = node * 2 + bit


def word_chunks(words: pa.Array):
    """Words of an Arrow binary array in chunks of about 65,000 bytes."""
    wide = words.cast(pa.large_binary())
    where = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(wide.buffers()[2], np.uint8) if wide.buffers()[2] is not None and wide.buffers()[2].size else np.zeros(0, np.uint8)
    a = 0
    while a < len(wide):
        b = max(a + 1, int(np.searchsorted(where + np.arange(len(where)), where[a] + a + _CHUNK)) - 1)
        b = min(b, len(wide))
        yield a, b, data, where[a : b + 1]
        a = b


def gates(b: list[np.ndarray]) -> list[np.ndarray]:
    """A weight's place by predictor, its own bucket and that of the next predictor."""
    return [(k * BUCKETS + x) * BUCKETS + b[min(k + 1, len(b) - 1)] for k, x in enumerate(b)]


class Mixer:
    """Gated weights and the refining table, learned from the decisions of all words round by round: a step of Newton's
    method at a time, with the bends of earlier rounds in it."""

    def __init__(self, k: int):
        self.k = k
        self.w = np.full(k * BUCKETS * BUCKETS, 1.0 / k)
        self.bend = lm_context.CALM * np.eye(self.w.size)
        self.prior = np.tile(1 / (1 + np.exp(-(np.arange(REFINE) - REFINE // 2) / 2.0)), (BUCKETS, 1))
        self.told = np.zeros((2, self.prior.size))
        self.apm = self.prior

    def cells(self, z: np.ndarray, top: np.ndarray) -> np.ndarray:
        return top * REFINE + np.rint(z * 2).astype(np.int32).clip(-(REFINE // 2), REFINE // 2) + REFINE // 2

    def tally(self, st: list[np.ndarray], b: list[np.ndarray], bit: np.ndarray, weight: np.ndarray, into: np.ndarray) -> None:
        """Adds what a step needs to `into` (of self.size()): for all buckets together the slopes and bends of the
        predictors, then ones and all in each cell of the table."""
        z, together = np.zeros(len(bit), np.float32), np.zeros(len(bit), np.int64)
        w = self.w.astype(np.float32)
        for g, x in zip(gates(b), st, strict=True):
            z += w[g] * x
        for x in b:
            together *= BUCKETS
            together += x
        np.clip(z, -11, 11, out=z)
        s = 1 / (1 + np.exp(-z))
        err, curve = weight * (bit - s), weight * (s * (1 - s))
        rows, n = into[: -2 * self.prior.size].reshape(-1, BUCKETS**self.k), 0
        for i, x in enumerate(st):
            rows[n] += np.bincount(together, weights=err * x, minlength=rows.shape[1])
            n, by = n + 1, curve * x
            for y in st[: i + 1]:
                rows[n] += np.bincount(together, weights=by * y, minlength=rows.shape[1])
                n += 1
        cell = self.cells(z, b[-1])
        ones, every = np.split(into[-2 * self.prior.size :], 2)
        ones += np.bincount(cell, weights=weight * bit, minlength=len(ones))
        every += np.bincount(cell, weights=weight, minlength=len(every))

    def size(self) -> int:
        return (self.k + self.k * (self.k + 1) // 2) * BUCKETS**self.k + 2 * self.prior.size

    def step(self, told: np.ndarray) -> None:
        size, all_of = self.w.size, np.arange(BUCKETS**self.k)
        place = gates([all_of // BUCKETS ** (self.k - 1 - k) % BUCKETS for k in range(self.k)])
        slope, bend, rows = np.zeros(size), np.zeros((size, size)), iter(told[: -2 * self.prior.size].reshape(-1, len(all_of)))
        for i in range(self.k):
            slope += np.bincount(place[i], weights=next(rows), minlength=size)
            for j in range(i + 1):
                both = np.bincount(place[i] * size + place[j], weights=next(rows), minlength=size * size).reshape(size, size)
                bend += both if i == j else both + both.T
        self.bend = self.bend + bend
        self.w = self.w + np.linalg.solve(self.bend, slope)
        self.told = self.told + told[-2 * self.prior.size :].reshape(2, -1)
        self.apm = ((self.told[0] + lm_context.CALM * self.prior.ravel()) / (self.told[1] + lm_context.CALM)).reshape(self.prior.shape)

    def log10(self, st: list[np.ndarray], b: list[np.ndarray], bit: np.ndarray) -> np.ndarray:
        w = self.w.astype(np.float32)
        z = np.zeros(len(bit), np.float32)
        for s, g in zip(st, gates(b), strict=True):
            z += w[g] * s
        np.clip(z, -11, 11, out=z)
        p = 0.5 / (1 + np.exp(-z)) + 0.5 * self.apm.astype(np.float32).reshape(-1)[self.cells(z, b[-1])]
        np.clip(p, 1e-5, 1 - 1e-5, out=p)
        return np.log10(np.where(bit == 1, p, 1 - p))


class Speller:
    """Frozen: packed byte tables (stretched probability and bucket of each slot), mixer, and the shapes of classes."""

    def __init__(self, counts: np.ndarray, mixer: Mixer, shape_counts: np.ndarray):
        self.packed = np.empty(len(counts), np.int32)
        for at in range(0, len(counts), 1 << 18):  # piece by piece, as the driver's memory is small
            n0, n1 = counts[at : at + (1 << 18), 0].astype(np.float32), counts[at : at + (1 << 18), 1].astype(np.float32)
            st = np.rint(np.clip(stretched(n0, n1), -12, 12) * 1000).astype(np.int32)
            self.packed[at : at + len(st)] = (st << 3) | bucket(n0 + n1).astype(np.int32)
        self.mixer = mixer
        self.shape = np.log((shape_counts + 0.1) / (shape_counts.sum(axis=0) + 0.1 * SHAPES)).astype(np.float32)

    def score(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class whose words a word looks like, and its log10 probability there."""
        sym, at, ends = layout(data, bounds)
        look = np.concatenate([np.zeros((1, self.shape.shape[1])), np.cumsum(self.shape[shapes(sym, at)], axis=0, dtype=np.float64)])
        cls = (look[ends[1:]] - look[ends[:-1]]).argmax(axis=1)
        total = np.zeros(len(sym))
        for slots, bit in decisions(sym, contexts(sym, at, np.repeat(cls, np.diff(ends)))):
            v = [self.packed[s] for s in slots]
            total += self.mixer.log10([(x >> 3).astype(np.float32) / 1000 for x in v], [x & 7 for x in v], bit)
        run = np.append(0.0, np.cumsum(total))
        return cls, run[ends[1:]] - run[ends[:-1]]


def by_classes(words: pa.Array, counts: np.ndarray):
    """Symbols of words, once for each class they stand in, chunk by chunk: layout, and the class and count of each symbol."""
    for a, b, data, bounds in word_chunks(words):
        who, cls = np.nonzero(counts[a:b])
        weight = counts[a:b][who, cls]
        sizes = np.diff(bounds)[who]
        begin = np.append(0, np.cumsum(sizes))
        index = np.arange(begin[-1]) - np.repeat(begin[:-1] - bounds[:-1][who], sizes)
        sym, at, ends = layout(data[index], begin)
        per = np.diff(ends)
        yield sym, at, ends, np.repeat(cls, per), np.repeat(weight, per)


def count_slots(batches):
    """Zeros and ones of all byte predictors, and the shapes of classes, over the words of a task."""
    counts = np.zeros((_START[-1], 2), np.uint32)
    flat_counts = counts.reshape(-1)
    shape = None
    for batch in merged(batches):
        by_class = np.stack([batch.column(i).to_numpy() for i in range(1, batch.num_columns)], axis=1).astype(np.float64)
        if shape is None:
            shape = np.zeros((SHAPES, by_class.shape[1]))
        for sym, at, ends, cls, weight in by_classes(batch.column(0), by_class):
            whole_weight = np.minimum(weight, 4e9).astype(np.uint32)
            shape += np.bincount(shapes(sym, at) * shape.shape[1] + cls, weights=weight, minlength=shape.size).reshape(shape.shape)
            for slots, bit in decisions(sym, contexts(sym, at, cls)):
                for s in slots:
                    np.add.at(flat_counts, s * 2 + bit, whole_weight)
    step = 1 << 17
    for i in range(0, len(counts), step):
        part = counts[i : i + step]
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([i // step]), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["piece", "data"])
    if shape is not None:
        yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([zlib.compress(shape.tobytes(), 1)], pa.binary())], ["piece", "data"])


def add_pieces(batches):
    """Sums the pieces of one table part; pairs of counts over 65,000 are scaled down together."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(zlib.decompress(data.as_py()), np.float64 if i < 0 else np.uint32).astype(np.float64)
            totals[i] = totals[i] + part if i in totals else part
    for i, t in totals.items():
        if i >= 0:
            t = t.reshape(-1, 2)
            top = t.max(axis=1, keepdims=True)
            t = np.where(top > 65_000, np.rint(t * 65_000 / np.maximum(top, 1)), t).astype(np.uint16)
        yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([zlib.compress(t.tobytes(), 1)], pa.binary())], ["piece", "data"])


def add_up(batches):
    """The sum of rows of numbers."""
    total = None
    for batch in batches:
        for data in batch.column(0):
            part = np.frombuffer(zlib.decompress(data.as_py()), np.float64)
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["data"])


def fit_speller(words: DataFrame, scratch: Scratch, classes: int, n_words: int) -> Speller:
    """words: word, c0, c1, ... (counts by class) of the training words that are spelled. Tables, then weights from all of
    them: a first round over a 32nd (by hash) finds about where the weights are, a second one over all others has them."""
    spark = words.sparkSession
    learners = int(min(64, max(1, n_words // 400_000)))
    parts = scratch.table(words.coalesce(learners).mapInArrow(count_slots, "piece long, data binary"))
    merged_parts = parts.repartition(32, "piece").mapInArrow(add_pieces, "piece long, data binary").collect()  # of fixed size
    counts, shape, step = np.zeros((_START[-1], 2), np.uint16), np.zeros((SHAPES, classes)), 1 << 17
    for r in merged_parts:
        if r.piece < 0:
            shape = np.frombuffer(zlib.decompress(r.data), np.float64).reshape(SHAPES, classes)
            continue
        part = np.frombuffer(zlib.decompress(r.data), np.uint16).reshape(-1, 2)
        counts[r.piece * step : r.piece * step + len(part)] = part
    del merged_parts
    mixer = Mixer(K)
    if n_words:
        tables = spark.sparkContext.broadcast(counts)
        for r in ("= 0", "> 0"):
            own = words.where(F.expr(f"pmod(xxhash64(word), 32) {r}"))
            told = own.coalesce(256).mapInArrow(tally_spelling(tables, mixer.w), "data binary")
            told = told.repartition(16).mapInArrow(add_up, "data binary").repartition(1).mapInArrow(add_up, "data binary")
            for row in told.collect():
                mixer.step(np.frombuffer(zlib.decompress(row.data), np.float64))
        tables.unpersist()
    return Speller(counts, mixer, shape)


def tally_spelling(tables, w: np.ndarray):
    """A function for mapInArrow that gives what a step of the mixer with weights w needs, over the words of a task."""

    def run(batches):
        own, pairs = Mixer(K), tables.value.view(np.uint32).ravel()  # zeros in the low half, ones in the high one
        own.w = w
        into = np.zeros(own.size())
        logs = np.log(np.arange(1 << 16) + 0.4).astype(np.float32)
        logs = np.append(logs, np.append(logs[0], logs[:-1]))  # behind them, those of counts without the word itself
        of = bucket(np.arange(1 << 17)).astype(np.int32)
        for batch in merged(batches):
            by_class = np.stack([batch.column(i).to_numpy() for i in range(1, batch.num_columns)], axis=1).astype(np.float64)
            for sym, at, _, cls, weight in by_classes(batch.column(0), by_class):
                for slots, bit in decisions(sym, contexts(sym, at, cls)):
                    zero, one = (bit == 0).astype(np.uint32) << np.uint32(16), bit.astype(np.uint32) << np.uint32(16)
                    st, b = [], []
                    for s in slots:
                        pair = pairs[s]
                        n0, n1 = pair & np.uint32(0xFFFF), pair >> np.uint32(16)
                        # The word itself, which is in every slot of its own, is left out
                        st.append(logs[n1 | one] - logs[n0 | zero])
                        b.append(of[np.maximum(n0 + n1, 1) - 1])
                    own.tally(st, b, bit, weight, into)
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(into.tobytes(), 1)], pa.binary())], ["data"])

    return run


def discount(once: int, twice: int) -> float:
    """What a count outside the dictionary gives up to spelling: its leave-one-out estimate from words seen once and twice."""
    return min(0.95, max(0.05, once / max(1, once + 2 * twice)))


def shared_out(c: np.ndarray, spelled: np.ndarray, tokens: float, types: float, d: float) -> np.ndarray:
    """log10 probabilities of words outside the dictionary, given that it is left: what their training counts c keep after
    the discount d, and the discounts of all `types` words shared out by their spelling (log10)."""
    if not tokens:
        return spelled
    new = math.log10(d * types / tokens) + spelled  # may be too small for a float as such
    own = np.log10(np.where(c > 0, np.maximum(c - d, 0) / tokens, 1.0))
    return np.where(c > 0, np.logaddexp2(own / math.log10(2), new / math.log10(2)) * math.log10(2), new)


def held_out(id_col: str):
    """The fold that is not learned from: crc32 of the id as text leaves 1 when divided by 5."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def gather(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary array of byte ranges."""
    sizes = ends - starts
    bounds = np.append(0, np.cumsum(sizes))
    index = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - starts, sizes)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(rows[index].tobytes())])


class Counted:
    """Words with counts by class, put together over the pieces of a task until there are many distinct ones."""

    def __init__(self, classes: int, rows: int = 1 << 17, size: int = 1 << 24):
        self.names, self.rows, self.size = ["h", "word", *[f"c{z}" for z in range(classes)]], rows, size
        self.held, self.n, self.bytes = [], 0, 0

    def add(self, key: np.ndarray, word: pa.Array, by_class: np.ndarray):
        self.held.append((key, word, by_class))
        self.n += len(key)
        self.bytes += word.nbytes
        if self.n >= 2 * self.rows or self.bytes >= 2 * self.size:
            self.join()
            if self.n >= self.rows or self.bytes >= self.size:
                yield from self.flush()

    def join(self) -> None:
        keys, words, counts = zip(*self.held, strict=True)
        key, first, back = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        counts, word = np.concatenate(counts), pa.concat_arrays(words).take(pa.array(first))
        total = np.stack([np.bincount(back, weights=counts[:, z], minlength=len(key)) for z in range(counts.shape[1])], axis=1)
        self.held, self.n, self.bytes = [(key, word, total.astype(np.int64))], len(key), word.nbytes

    def flush(self):
        if self.held:
            self.join()
            key, word, by_class = self.held[0]
            self.held, self.n, self.bytes = [], 0, 0
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), word, *[pa.array(np.ascontiguousarray(c)) for c in by_class.T]], self.names)


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    class_col: str | None = "lang",
    max_dictionary: int = 1 << lm_context.LEAF_BITS,
    max_table_bits: int = 23,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every whole text.

    Learns from all documents outside the held-out fold. class_col splits training documents in at most MAX_CLASSES
    classes (the commonest values, and one of all others); it is never looked at when scoring. Words are matched by 64-bit
    hashes. Defined results: a null or empty text is its end alone; a very long text is coded in one block of its own;
    a null doc_id is not held out; without training documents N and V are 0; words of equal count enter the dictionary
    together or not at all, expected words of equal count go by their place in it; rows that repeat are counted and
    scored as often as they stand; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    value = F.col(class_col).cast("string") if class_col in docs.columns else F.lit(None).cast("string")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"), value.alias("value"))
    top = base.where("NOT held_out AND value IS NOT NULL").groupBy("value").count().orderBy(F.desc("count"), "value").limit(MAX_CLASSES - 1).collect()
    names = [r.value for r in top]
    n_classes = len(names) + 1
    cls = F.lit(len(names))
    for z, name in enumerate(names):
        cls = F.when(F.col("value") == name, F.lit(z)).otherwise(cls)
    learned_from = base.select(F.when(F.col("held_out"), F.lit(-1)).otherwise(cls).cast("int").alias("cls"), "text")
    cs = [f"c{z}" for z in range(n_classes)]

    def count_words(batches):
        held = Counted(n_classes)
        for batch in batches:
            kind = batch.column(0).to_numpy()
            for a, b in pieces(batch.column(1)):
                data, offsets = flat(batch.column(1).slice(a, b - a))
                words = Words(LOWER[data], offsets)
                own = kind[a:b].astype(np.int64)
                key, first, back = np.unique(words.hashes(lower=False), return_index=True, return_inverse=True)
                z = own[words.doc]
                by_class = np.bincount((back * n_classes + z)[z >= 0], minlength=len(key) * n_classes).reshape(-1, n_classes)
                word = gather(words.data, words.start[first], words.end[first])
                ended = np.bincount(own[own >= 0], minlength=n_classes)
                yield from held.add(key, word, by_class)
                yield from held.add(END_HASH[None], pa.array([b""], pa.binary()), ended[None])
        yield from held.flush()

    counted = learned_from.mapInArrow(count_words, "h long, word binary, " + ", ".join(f"{c} long" for c in cs))
    vocabulary = counted.groupBy("h", "word").agg(*[F.sum(c).alias(c) for c in cs]).withColumn("n_train", F.expr(" + ".join(cs)))
    vocabulary = scratch.table(vocabulary)
    zero = lambda c: F.coalesce(c, F.lit(0))
    facts = vocabulary.agg(zero(F.sum("n_train")), zero(F.sum(F.expr("int(n_train > 0)"))), *[zero(F.sum(c)) for c in cs]).first()
    n, v, by_class = facts[0], facts[1], np.array(facts[2:], float)
    log_all = math.log10(n + 0.5 * (v + 1))
    # The dictionary: words whose count, 2 at least, reaches the lowest bound under which they are few enough
    steps = vocabulary.where("n_train > 1").groupBy(F.least("n_train", F.lit(5_000)).alias("c")).agg(F.count("*").alias("n")).orderBy(F.desc("c")).collect()
    bound, held = 5_001, 0
    for r in steps:
        if held + r.n >= max_dictionary:
            break
        bound, held = r.c, held + r.n
    inside = (F.col("n_train") > 1) & (F.least("n_train", F.lit(5_000)) >= bound)
    rows = vocabulary.where(inside).select("h", *cs).toArrow()  # fewer than max_dictionary rows
    keys = rows.column("h").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys = keys[order]
    counts = np.stack([rows.column(c).to_numpy()[order] for c in cs], axis=1).astype(float)
    del rows, order
    # Words with counts outside the dictionary: the speller learns from all of them
    spelled = vocabulary.where(~inside & (F.col("n_train") > 0))
    kept = spelled.agg(zero(F.sum("n_train")), F.count("*"), zero(F.sum(F.expr("int(n_train = 1)"))), zero(F.sum(F.expr("int(n_train = 2)"))), *[zero(F.sum(c)) for c in cs]).first()
    tokens, types, less, new = float(kept[0]), float(kept[1]), discount(kept[2], kept[3]), np.array(kept[4:], float)
    known, coder = contexts_of(base, scratch, keys, np.concatenate([(new + 0.5)[None], counts]), n, max_table_bits)
    base_of = (np.log10(np.append(0.0, counts.sum(axis=1)) + 0.5) - log_all)[np.append(0, np.arange(1, len(keys) + 1))]
    outside = vocabulary.where(~inside)
    speller = fit_speller(spelled.select("word", *cs), scratch, n_classes, v - held)
    looks = np.log10((new + 0.5) / (new.sum() + 0.5 * n_classes))
    model, common = spark.sparkContext.broadcast(speller), spark.sparkContext.broadcast((known, coder, base_of))
    del speller, counts, keys

    def score_words(batches):
        m = model.value
        for batch in merged(batches):
            if batch.num_rows:
                got = [m.score(data, bounds) for _, _, data, bounds in word_chunks(batch.column(1))]
                c = batch.column(2).to_numpy()
                price = shared_out(c, np.concatenate([x for _, x in got]), tokens, types, less)
                columns = [batch.column(0), pa.array((c > 0).astype(np.int32)), pa.array(np.log10(c + 0.5) - log_all), pa.array(np.concatenate([x for x, _ in got]).astype(np.int32)), pa.array(price)]
                yield pa.RecordBatch.from_arrays(columns, ["h", "known", "b", "z", "m"])

    priced = outside.select("h", "word", "n_train").mapInArrow(score_words, "h long, known int, b double, z int, m double")
    fields = ["rid", "h", "tf", "cls", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "n_bytes"]

    def score_docs(batches):
        (known, coder, base_of), seq, task = common.value, 0, TaskContext.get().partitionId()
        for batch in batches:
            for a, b in pieces(batch.column(2), 1 << 18):
                size = b - a
                words = Words(*flat(batch.column(2).slice(a, size)))
                seen = lm_context.Seen(words, words.hashes(), END_HASH)
                leaf = known.find(seen.hash)
                mine = ~np.asarray(batch.column(1).slice(a, size)).astype(bool)[seen.doc]
                cls = coder.classes(seen, leaf)
                price = coder.price(seen, leaf, mine, cls)
                other = np.flatnonzero(leaf == 0)
                again, extra = repeats(seen.doc[other], seen.hash[other])
                price[other] += extra
                n_tokens = np.diff(seen.first)
                n_bytes = np.bincount(words.doc, weights=words.end - words.start, minlength=size) + n_tokens
                has = leaf > 0
                rid = (np.int64(task) << 36) + seq + np.arange(size)
                seq += size
                none = pa.nulls(size, pa.int64())
                columns = [pa.array(rid), none, none, pa.nulls(size, pa.int32()), batch.column(0).slice(a, size), batch.column(1).slice(a, size), pa.array(n_tokens.astype(np.int64))]
                columns += [pa.array(np.bincount(seen.doc[has], minlength=size).astype(np.int64)), pa.array(np.bincount(seen.doc[has], weights=base_of[leaf[has]], minlength=size).astype(float))]
                columns += [pa.array(np.bincount(seen.doc, weights=price, minlength=size)), pa.array(n_bytes.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, fields)
                if len(other):
                    first = other[~again]
                    tf = np.bincount(first_of(seen.doc[other], seen.hash[other], again), minlength=len(first))
                    void = pa.nulls(len(first), pa.int64())
                    like = cls[first].astype(np.int32)
                    columns = [pa.array(rid[seen.doc[first]]), pa.array(seen.hash[first].view(np.int64)), pa.array(tf.astype(np.int64)), pa.array(like), void, pa.nulls(len(first), pa.bool_()), void, void, *[pa.nulls(len(first), pa.float64())] * 2, void]
                    yield pa.RecordBatch.from_arrays(columns, fields)

    scored = base.select("doc_id", "held_out", "text").mapInArrow(score_docs, "rid long, h long, tf long, cls int, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, n_bytes long")
    scored = scratch.table(scored)
    # A word outside the dictionary looks like the class of its text, or like another's
    fits = F.when(F.col("z") == F.col("cls"), F.lit(math.log10(1 - FLOOR))).otherwise(F.element_at(F.array(*[F.lit(math.log10(FLOOR) + float(x)) for x in looks]), F.col("z") + 1))
    rare = scored.where("h IS NOT NULL").select("rid", "h", "tf", "cls").join(priced, "h")
    rare = rare.groupBy("rid").agg(F.sum(F.col("tf") * F.col("known")).alias("k"), F.sum(F.col("tf") * F.col("b")).alias("b"), F.sum(F.col("m") + fits).alias("m"))
    out = scored.where("h IS NULL").drop("h", "tf").join(rare, "rid", "left")
    for c in ("k", "b", "m"):
        out = out.withColumn(c, zero(c))
    out = out.withColumn("score", F.col("model") + F.col("m")).select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("k")).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("b")).alias("base_score"),
        "score",
        (-F.col("score") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"),
    )
    return scratch.last(out)


def first_of(doc: np.ndarray, h: np.ndarray, again: np.ndarray) -> np.ndarray:
    """For each word the number, among the first ones, of the first in its text that is the same."""
    key = mix(h + doc.astype(np.uint64) * np.uint64(_R))
    firsts = key[~again]
    order = np.argsort(firsts)
    return order[np.searchsorted(firsts[order], key)]


def repeats(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words outside the dictionary, in order: whether the same has stood in the text, and the log10 probability of that; for a
    repeat also of which of the words before it is. How likely a repeat is, is told by how many there have been in the text."""
    n = len(doc)
    start = np.searchsorted(doc, doc)
    place = np.arange(n) - start
    key = mix(h + doc.astype(np.uint64) * np.uint64(_R))
    order = np.argsort(key, kind="stable")
    run = key[order]
    before = np.empty(n, np.int64)
    before[order] = np.arange(n) - np.searchsorted(run, run)
    again = before > 0
    so_far = np.cumsum(again) - again
    so_far = so_far - so_far[start] if n else so_far
    p = (so_far + 0.5) / (place + 1)
    with np.errstate(divide="ignore"):
        told = np.where(again, np.log10(p * before / np.maximum(place, 1)), np.log10(1 - np.where(place > 0, p, 0)))
    return again, told


def contexts_of(base: DataFrame, scratch: Scratch, keys: np.ndarray, counts: np.ndarray, n: int, max_table_bits: int):
    """The leaves of words and the coder: code and prices from counts (leaf 0 first), the table of contexts, then the
    weights, from all training texts."""
    spark = base.sparkSession
    known = lm_context.Known(keys, np.arange(1, len(keys) + 1, dtype=np.int32))
    tree = lm_context.Tree(counts)
    price, like = tree.prices(tree.fit(counts)), tree.like
    del tree
    table_bits = int(min(max_table_bits, max(12, math.ceil(math.log2(n + 2)))))
    piece_bits = int(min(table_bits - 4, max(5, math.ceil(math.log2(n / 500_000 + 1)))))
    leaves = spark.sparkContext.broadcast(known)

    def collect_contexts(batches):
        own = lm_context.Gather(piece_bits)
        for batch in batches:
            for a, b in pieces(batch.column(0)):
                words = Words(*flat(batch.column(0).slice(a, b - a)))
                seen = lm_context.Seen(words, words.hashes(), END_HASH)
                yield from own.add(seen, leaves.value.find(seen.hash))
        yield from own.flush()

    learned_from = base.where("NOT held_out").select("text")
    parts = learned_from.mapInArrow(collect_contexts, "piece long, data binary").repartition(1 << piece_bits, "piece")
    merged_parts = parts.mapInArrow(lm_context.merge_entries(table_bits, piece_bits), "piece long, data binary").collect()  # 2^table_bits slots of 4 bytes
    table, step = np.zeros(1 << table_bits, np.uint32), 1 << (table_bits - piece_bits)
    for r in merged_parts:
        table[r.piece * step : (r.piece + 1) * step] = np.frombuffer(zlib.decompress(r.data), np.uint32)
    del merged_parts
    tables = spark.sparkContext.broadcast((like, price, table))

    def tally_decisions(batches):
        coder, tally = lm_context.Coder(*tables.value, lm_context.Weights()), lm_context.Tally()
        for batch in batches:
            for a, b in pieces(batch.column(0), 1 << 18):
                words = Words(*flat(batch.column(0).slice(a, b - a)))
                seen = lm_context.Seen(words, words.hashes(), END_HASH)
                leaf = leaves.value.find(seen.hash)
                tally.add(*coder.decisions(seen, leaf, np.ones(len(leaf), bool))[2:])
        tally.join()
        yield pa.RecordBatch.from_arrays([pa.array(tally.keys), pa.array(tally.n)], ["key", "n"])

    told = learned_from.mapInArrow(tally_decisions, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # of bounded size
    tables.unpersist()
    leaves.unpersist()
    weights = lm_context.learned(told.column("key").to_numpy(), told.column("n").to_numpy())
    return known, lm_context.Coder(like, price, table, weights)


def op10_lm(spark, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"))
