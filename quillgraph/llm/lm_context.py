"""Words in context: a Huffman code of the dictionary, tables of hashed contexts, and the mixing of their bit predictions.

A word of a text is a row of binary decisions along the code of its leaf. Each decision has up to five predictors: the
counts of the node (all texts, and the class that the text so far looks like), the word expected after the last two
words, the one expected after the last word (both from hashed tables of the whole corpus), and the word that followed
the last two words when they last stood in this text. An expected word predicts its own bits as long as the decisions
agree with it, and is silent from the first that does not. Predictions are summed in the logistic domain with weights
that are gated by the predictor, its confidence, the depth and which others speak; a table refines the result. Weights
and table start as learned from the decisions of all training texts (which are tallied) and go on learning along every text, after its first 32, 64, ... 1,024 words
and then after each 1,024; texts of a block are coded together.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from .common import _R, mix

ALIGN = 48  # codes are kept at the top of so many bits
LEAF_BITS = 18
NO = np.uint64((1 << LEAF_BITS) - 1)
EXPECT = 3  # predictors that expect a word: two last words, last word, this text
REFINE = 33
ORDER = (2, 0, 1)  # in which their words are tried
SETS = 3**EXPECT  # which are for a word, against it, or silent
COUNTED = 6  # buckets of how often a node has been seen
SURE = 12  # confidences of an expected word: 6 of its counts, and whether the last expectation came true
GATES = SETS + EXPECT * SURE * SETS
RATE, CALM, KEEP = 0.05, 8.0, 0.99
_SALT = mix(np.arange(31, 31 + 3).astype(np.uint64))
_FIRST = 32
_STEPS = 256  # of a stretched price in a tally
_RAW = 3  # bytes of a step between contexts that are kept as they are


def bucket(n: np.ndarray) -> np.ndarray:
    return np.digitize(n, [0.5, 1.5, 3.5, 9.5, 49.5])


def stretched(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + 0.4) / (n0 + 0.4))


def newton(gates, inputs, n0, n1, start: np.ndarray, calm: float = CALM, most: int = 30) -> np.ndarray:
    """Weights of the logistic mix of inputs (a row per predictor, weighted by the weights at gates) that make all n0 zeros
    and n1 ones likeliest; each weight is drawn to its start as if by calm observations."""
    w, size = start.astype(float), len(start)
    gates, n = [g.astype(np.int64) for g in gates], n0 + n1

    def at(w):
        z = np.zeros(len(n))
        for g, x in zip(gates, inputs, strict=True):
            z += w[g] * x
        np.clip(z, -11, 11, out=z)
        return 1 / (1 + np.exp(-z)), float((n0 * np.logaddexp(0, z) + n1 * np.logaddexp(0, -z)).sum() + calm / 2 * ((w - start) ** 2).sum())

    s, loss = at(w)
    for _ in range(most):
        slope, bend = calm * (start - w), calm * np.eye(size)
        err, curve = n1 - n * s, n * s * (1 - s)
        for i, (g, x) in enumerate(zip(gates, inputs, strict=True)):
            slope += np.bincount(g, weights=err * x, minlength=size)
            for h, y in zip(gates[: i + 1], inputs[: i + 1], strict=True):
                both = np.bincount(g * size + h, weights=curve * x * y, minlength=size * size).reshape(size, size)
                bend += both if h is g else both + both.T
        step, cut = np.linalg.solve(bend, slope), 1.0
        while cut > 1e-3 and not (new := at(w + cut * step))[1] <= loss:
            cut /= 2
        if cut <= 1e-3:
            break
        gain, w, (s, loss) = loss - new[1], w + cut * step, new
        if gain <= 1e-9 * max(1.0, loss):
            break
    return w


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Lengths of a Huffman code, by merging two queues. Counts below a 2^-24 share count as that, which bounds the lengths."""
    n = len(counts)
    if n == 1:
        return np.zeros(1, np.int64)
    order = np.argsort(counts, kind="stable")
    least = max(1.0, counts.sum() / 2**24)
    weight = np.maximum(counts[order], least).tolist() + [0.0] * (n - 1)
    up = [0] * (2 * n - 1)
    a, b = 0, n
    for made in range(n, 2 * n - 1):
        both = 0.0
        for _ in range(2):
            if a < n and (b >= made or weight[a] <= weight[b]):
                pick, a = a, a + 1
            else:
                pick, b = b, b + 1
            both += weight[pick]
            up[pick] = made
        weight[made] = both
    depth = [0] * (2 * n - 1)
    for i in range(2 * n - 3, -1, -1):
        depth[i] = depth[up[i]] + 1
    out = np.empty(n, np.int64)
    out[order] = depth[:n]
    return out


class Tree:
    """Canonical code of leaves with counts by class. Leaf 0 stands for all words outside of the dictionary."""

    def __init__(self, counts: np.ndarray):
        counts = counts.astype(float)
        self.classes = counts.shape[1]
        total = counts.sum(axis=1)
        self.length = code_lengths(total)
        deepest = int(self.length.max())
        per = np.bincount(self.length, minlength=deepest + 1)
        order = np.argsort(self.length, kind="stable")
        first, inner, base = np.zeros(deepest + 1, np.int64), np.zeros(deepest + 1, np.int64), np.zeros(deepest + 1, np.int64)
        nodes = 1
        for d in range(deepest + 1):
            if d:
                first[d] = (first[d - 1] + per[d - 1]) << 1
                nodes = 2 * inner[d - 1]
                base[d] = base[d - 1] + inner[d - 1]
            inner[d] = nodes - per[d]
        at = np.append(0, np.cumsum(per))
        code = np.empty(len(total), np.int64)
        code[order] = first[self.length[order]] + np.arange(len(order)) - at[self.length[order]]
        self.code = code << (ALIGN - self.length)
        #: node of the first d bits of a code: shift[d] + those bits
        self.shift = base - first - per
        self.per, self.inner, self.base, self.order, self.at, self.deepest = per, inner, base, order, at, deepest
        self.n = int(inner.sum())
        both = np.column_stack([counts, total])
        ones, zeros = np.zeros((self.classes + 1, self.n)), np.zeros((self.classes + 1, self.n))
        below = None
        for d in range(deepest, -1, -1):
            own = [both[order[at[d] : at[d + 1]]]]
            if below is not None:
                own.append(below[0::2] + below[1::2])
                s = slice(base[d], base[d] + inner[d])
                zeros[:, s], ones[:, s] = below[0::2].T, below[1::2].T
            below = np.concatenate(own)
        self.zeros, self.ones = zeros, ones
        self.stretch = np.clip(stretched(zeros, ones), -12, 12).astype(np.float32)  # a row per class, the last of all
        self.seen = bucket(zeros + ones).astype(np.int8)
        self.like = np.log((counts + 0.02 * total[:, None] / self.classes + 1e-9) / (counts.sum(axis=0) + 0.02 * total.sum() / self.classes + 1e-9)).astype(np.float32)

    def prices(self, w: np.ndarray) -> np.ndarray:
        """log10 probability by class of every leaf: along its code the predictions of all texts and of the class are
        mixed with weights w (by how often the class has seen the node)."""
        leaf = np.zeros((self.classes, len(self.code)))
        for z in range(self.classes):
            mixed = w[0, self.seen[z]] * self.stretch[-1] + w[1, self.seen[z]] * self.stretch[z]
            p = np.clip(1 / (1 + np.exp(-np.clip(mixed, -11, 11))), 1e-5, 1 - 1e-5)
            here = np.zeros(1)
            for d in range(self.deepest + 1):
                leaf[z, self.order[self.at[d] : self.at[d + 1]]] = here[: self.per[d]]
                s = slice(self.base[d], self.base[d] + self.inner[d])
                inner = here[self.per[d] :]
                here = np.stack([inner + np.log10(1 - p[s]), inner + np.log10(p[s])], axis=1).ravel()
        return leaf.astype(np.float32)

    def fit(self, counts: np.ndarray) -> np.ndarray:
        """Weights of the two predictions, learned from all counted words, each word being left out of the counts that
        predict it."""
        if not self.n or not counts.sum():
            return np.full((2, COUNTED), 0.5)
        found = []
        for z in range(self.classes):
            for bit, own in enumerate((self.zeros[z], self.ones[z])):
                node = np.flatnonzero(own)
                x = []
                for row in (-1, z):
                    n0, n1 = np.maximum(0, self.zeros[row, node] - (bit == 0)), np.maximum(0, self.ones[row, node] - (bit == 1))
                    x.append(np.clip(stretched(n0, n1), -12, 12).astype(np.float32))
                found.append((*x, bucket(n0 + n1).astype(np.int8), own[node] * (bit == 0), own[node] * (bit == 1)))
        x0, x1, seen, n0, n1 = (np.concatenate(f) for f in zip(*found, strict=True))
        return newton([seen, seen + COUNTED], [x0, x1], n0, n1, np.full(2 * COUNTED, 0.5)).reshape(2, COUNTED)


def gate_of_word(k: int, sure: np.ndarray, speak: np.ndarray) -> np.ndarray:
    return SETS + (k * SURE + sure) * SETS + speak


def cells(z: np.ndarray, speak: np.ndarray) -> np.ndarray:
    return speak * REFINE + np.rint(z * 2).astype(np.int64).clip(-(REFINE // 2), REFINE // 2) + REFINE // 2


class Weights:
    """Gated weights and the refining table as learned from the corpus."""

    def __init__(self):
        self.w = np.ones(GATES)
        self.apm = np.tile(1 / (1 + np.exp(-(np.arange(REFINE) - REFINE // 2) / 2.0)), SETS)


# ---------------------------------------------------------------- what a text shows


class Seen:
    """Tokens of a block of texts in order (words, then the end of each text), with the contexts before them."""

    def __init__(self, words, hashes: np.ndarray, end_hash: np.uint64):
        size = len(words.first) - 1
        n = len(hashes) + size
        self.size = size
        self.doc = np.concatenate([words.doc, np.arange(size)])
        where = np.concatenate([np.arange(len(hashes)) + words.doc, words.first[1:] + np.arange(size)])
        h, doc = np.empty(n, np.uint64), np.empty(n, np.int64)
        h[where] = np.concatenate([hashes, np.full(size, end_hash)])
        doc[where] = self.doc
        self.hash, self.doc = h, doc
        self.first = words.first + np.arange(size + 1)
        self.pos = np.arange(n) - self.first[:-1][doc]
        self.is_end = np.zeros(n, bool)
        self.is_end[self.first[1:] - 1] = True

    def back(self, j: int) -> np.ndarray:
        """The hash of the word j places before, 0 before the text."""
        out = np.zeros(len(self.hash), np.uint64)
        ok = np.flatnonzero(self.pos >= j)
        out[ok] = self.hash[ok - j]
        return out

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        one = self.back(1)
        return mix(one * np.uint64(_R) + self.back(2) + _SALT[0]), mix(one + _SALT[1])


class Known:
    """Leaves by word hash."""

    def __init__(self, keys: np.ndarray, leaf: np.ndarray):
        """keys: sorted hashes of the dictionary's words; leaf: the leaf of each. One more, above all, has leaf 0."""
        self.keys = keys
        self.ends, self.leaf = np.append(keys, ~np.uint64(0)), np.append(leaf, 0)
        self.shift = np.uint64(64 - max(1, len(keys)).bit_length())
        #: where the keys of each leading bits begin
        self.starts = np.searchsorted(keys, np.arange(1 << int(64 - self.shift)).astype(np.uint64) << self.shift)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Hashes are spread evenly, so a key is a few places after the first one of its leading bits."""
        at = self.starts[(h >> self.shift).astype(np.int64)]
        behind = np.flatnonzero(self.ends[at] < h)
        while len(behind):
            at[behind] += 1
            behind = behind[self.ends[at[behind]] < h[behind]]
        return np.where(self.ends[at] == h, self.leaf[at], 0)


# ---------------------------------------------------------------- tables of contexts

#: How often the expected word has followed: 1, 2, 3, up to 6, up to 15, more.
LEVELS = (1.5, 2.5, 3.5, 6.5, 15.5)


def followers(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """keys: context and leaf (low bits) of each token. The commonest leaf of each context as key, its count, and how
    often the context stands."""
    keys = np.sort(keys)
    return best_followers(keys, np.ones(len(keys), np.int64), None)


def best_followers(keys: np.ndarray, c: np.ndarray, n: np.ndarray | None):
    """The same from sorted keys with counts; n: how often the context stood where the counts were made."""
    if not len(keys):
        return keys, c, c
    new = np.append(True, keys[1:] != keys[:-1])
    at = np.flatnonzero(new)
    ctx = keys >> np.uint64(LEAF_BITS)
    groups = np.flatnonzero(np.append(True, ctx[1:] != ctx[:-1]))
    total = np.add.reduceat(c if n is None else n, groups)
    count = np.add.reduceat(c, at)
    keys = keys[at]
    ctx = keys >> np.uint64(LEAF_BITS)
    groups = np.flatnonzero(np.append(True, ctx[1:] != ctx[:-1]))
    top = np.maximum.reduceat((count.astype(np.uint64) << np.uint64(LEAF_BITS)) | (NO - (keys & NO)), groups)
    leaf = NO - (top & NO)
    return (ctx[groups] << np.uint64(LEAF_BITS)) | leaf, (top >> np.uint64(LEAF_BITS)).astype(np.int64), total


def pack_entries(keys: np.ndarray, c: np.ndarray, n: np.ndarray) -> bytes:
    """Byte by byte: the low bytes of steps between contexts are as good as random and stand as they are, all others are
    coded without a search for matches."""
    steps = np.diff(keys >> np.uint64(LEAF_BITS), prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    leaf = (keys & NO).astype(np.uint32).view(np.uint8).reshape(-1, 4)
    counts = [np.minimum(x, 60_000).astype(np.uint16).view(np.uint8).reshape(-1, 2) for x in (c, n)]
    rest = np.concatenate([steps[:, _RAW:6].T, leaf[:, :3].T, *(x.T for x in counts)])
    coder = zlib.compressobj(1, zlib.DEFLATED, 15, 8, zlib.Z_RLE)
    return len(keys).to_bytes(4, "little") + np.ascontiguousarray(steps[:, :_RAW].T).tobytes() + coder.compress(rest.tobytes()) + coder.flush()


def unpack_entries(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = int.from_bytes(data[:4], "little")
    low = np.frombuffer(data, np.uint8, _RAW * size, 4).reshape(_RAW, size)
    rest = np.frombuffer(zlib.decompress(memoryview(data)[4 + _RAW * size :]), np.uint8).reshape(13 - _RAW, size)

    def number(rows, width: int, kind) -> np.ndarray:
        out = np.zeros((size, width), np.uint8)
        for i, row in enumerate(rows):
            out[:, i] = row
        return out.view(kind).ravel()

    high = 6 - _RAW
    steps = number([*low, *rest[:high]], 8, np.uint64)
    leaf = number(rest[high : high + 3], 4, np.uint32).astype(np.uint64)
    c, n = (number(rest[a : a + 2], 2, np.uint16).astype(np.int64) for a in (high + 3, high + 5))
    return (np.cumsum(steps) << np.uint64(LEAF_BITS)) | leaf, c, n


class Gather:
    """Collects contexts of a task's texts and gives them out piece by piece (by the first bits of the context)."""

    def __init__(self, piece_bits: int, most: int = 1 << 20):
        self.piece_bits, self.most, self.held, self.n = piece_bits, most, [], 0

    def add(self, seen: Seen, leaf: np.ndarray):
        for ctx in seen.contexts():
            self.held.append((ctx & ~NO) | leaf.astype(np.uint64))
        self.n += len(leaf)
        if self.n >= self.most:
            yield from self.flush()

    def flush(self):
        if not self.n:
            return
        keys, c, n = followers(np.concatenate(self.held))
        self.held, self.n = [], 0
        cut = np.searchsorted(keys, (np.arange(1, 1 << self.piece_bits).astype(np.uint64)) << np.uint64(64 - self.piece_bits))
        cut = np.concatenate([[0], cut, [len(keys)]])
        full = np.flatnonzero(np.diff(cut))
        data = [pack_entries(keys[cut[p] : cut[p + 1]], c[cut[p] : cut[p + 1]], n[cut[p] : cut[p + 1]]) for p in full]
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int64)), pa.array(data, pa.binary())], ["piece", "data"])


def merge_entries(table_bits: int, piece_bits: int):
    """A function for mapInArrow that makes a piece of the table of all entries of the piece: in a slot stands the context
    whose expected word has come most often."""

    def run(batches):
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for p, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.setdefault(p, []).append(data.as_py())
        for p, parts in held.items():
            keys, c, n = (np.concatenate(x) for x in zip(*map(unpack_entries, parts), strict=True))
            order = np.argsort(keys, kind="stable")
            keys, c, n = best_followers(keys[order], c[order], n[order])
            slot = (keys >> np.uint64(64 - table_bits)).astype(np.int64)
            # Keys are in order of slots: the first of those in a slot that have its highest count
            new = np.append(True, slot[1:] != slot[:-1])
            most = np.flatnonzero(c == np.maximum.reduceat(c, np.flatnonzero(new))[np.cumsum(new) - 1])
            win = most[np.append(True, slot[most][1:] != slot[most][:-1])]
            out = np.zeros(1 << (table_bits - piece_bits), np.uint32)
            out[slot[win] - (p << (table_bits - piece_bits))] = packed(keys[win], c[win], n[win], table_bits)
            yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([zlib.compress(out.tobytes(), 1)], pa.binary())], ["piece", "data"])

    return run


def packed(keys: np.ndarray, c: np.ndarray, n: np.ndarray, table_bits: int) -> np.ndarray:
    """An entry: 9 bits that tell contexts of a slot apart, the level of the count (3), the share (2), and the leaf (18)."""
    share = c / np.maximum(n, 1)
    check = (keys >> np.uint64(64 - table_bits - 9)) & np.uint64(511)
    level = (np.digitize(c, LEVELS) + 1).astype(np.uint64)
    part = np.digitize(share, [0.3, 0.9]).astype(np.uint64)
    return ((check << np.uint64(23)) | (level << np.uint64(20)) | (part << np.uint64(18)) | (keys & NO)).astype(np.uint32)


def look_up(table: np.ndarray, ctx: np.ndarray):
    """Expected leaf (-1 for none), level and share of each context."""
    bits = int(len(table)).bit_length() - 1
    got = table[(ctx >> np.uint64(64 - bits)).astype(np.int64)]
    check = ((ctx >> np.uint64(64 - bits - 9)) & np.uint64(511)).astype(np.uint32)
    level = ((got >> np.uint32(20)) & np.uint32(7)).astype(np.int64)
    ok = (level > 0) & ((got >> np.uint32(23)) == check)
    return np.where(ok, (got & np.uint32(NO)).astype(np.int64), -1), level, ((got >> np.uint32(18)) & np.uint32(3)).astype(np.int64)


# ---------------------------------------------------------------- coding


class Coder:
    """What is sent to the tasks: prices of leaves by class, likeness to classes, the table of contexts, and weights."""

    def __init__(self, like: np.ndarray, leaf_price: np.ndarray, table: np.ndarray, weights: Weights):
        self.like, self.leaf_price, self.table, self.weights = like, leaf_price, table, weights
        self.like_rows = np.ascontiguousarray(like.T, np.float64)

    def classes(self, seen: Seen, leaf: np.ndarray) -> np.ndarray:
        """The class that the words before each look most like."""
        best, out, sizes = None, np.zeros(len(leaf), np.int64), np.diff(seen.first)
        run = np.zeros(len(leaf) + 1)
        for z, like in enumerate(self.like_rows):
            np.cumsum(like[leaf], out=run[1:])
            own = run[:-1] - np.repeat(run[seen.first[:-1]], sizes)
            if best is None:
                best = own
                continue
            better = own > best
            out[better] = z
            np.maximum(best, own, out=best)
        return out

    def expected(self, seen: Seen, leaf: np.ndarray, own: np.ndarray):
        """Expected leaves and confidences of the three predictors. own: tokens whose own count is left out of the tables."""
        out = []
        for k, ctx in enumerate(seen.contexts()):
            if k == 0:
                two = ctx
            want, level, share = look_up(self.table, ctx)
            hit = want == leaf
            mine = hit & own & (level <= 3)
            level = level - mine
            want = np.where(level > 0, want, -1)
            out.append((want, np.where(share == 2, np.minimum(1 + level, 5), share), hit))
        n = len(leaf)
        bits = max(1, int(n - 1).bit_length()) if n else 1
        key = np.sort((mix(two + seen.doc.astype(np.uint64) * np.uint64(_R)) & ~np.uint64((1 << bits) - 1)) | np.arange(n).astype(np.uint64))
        i = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
        same = (key[1:] >> np.uint64(bits)) == (key[:-1] >> np.uint64(bits))
        before = np.full(n, -1)
        before[i[1:][same]] = i[:-1][same]
        before[seen.pos == 0] = -1
        has = before >= 0
        longer = has.astype(np.int64)
        for j in (3, 4, 5):
            h = seen.back(j)
            longer += (longer == j - 2) & (h == h[before]) & (h != 0)
        want = np.where(has, leaf[before], -1)
        out.append((want, np.minimum(longer, 5), want == leaf))
        sure = []
        for want, level, hit in out:
            came = np.zeros(n, np.int64)
            came[1:] = hit[:-1] & (seen.pos[1:] > 0)
            sure.append((want, level * 2 + came))
        return sure

    def decisions(self, seen: Seen, leaf: np.ndarray, own: np.ndarray, cls: np.ndarray | None = None):
        """The price of every token's code where no expected word was right, and a row for each expected word that was
        tried: token, whether it was right, which predictors are for and against it, their gates and their inputs."""
        cls = self.classes(seen, leaf) if cls is None else cls
        sures = self.expected(seen, leaf, own)
        wants = [w for w, _ in sures]
        open_, out = np.ones(len(leaf), bool), np.zeros(len(leaf))
        rows = []
        for j, k in enumerate(ORDER):
            tried = open_ & (wants[k] >= 0)
            for e in ORDER[:j]:
                tried &= wants[k] != wants[e]
            tok = np.flatnonzero(tried)
            c = wants[k][tok]
            bit = leaf[tok] == c
            p = np.minimum(10.0 ** self.leaf_price[cls[tok], c], 0.999)
            speak, gates, inputs = np.zeros(len(tok), np.int64), [], [np.log(p / (1 - p))]
            for e in range(EXPECT):
                w = wants[e][tok]
                side = np.where(w < 0, 0, np.where(w == c, 1, -1))
                speak += (side + 1) * 3**e
                inputs.append(side)
            gates = [speak, *[gate_of_word(e, sures[e][1][tok], speak) for e in range(EXPECT)]]
            rows.append((tok, bit, speak, np.array(gates, np.int32), np.array(inputs, np.float32)))
            out[tok] += np.where(bit, 0.0, p)
            open_[tok[bit]] = False
        rest = np.where(open_, self.leaf_price[cls, leaf] - np.log10(np.maximum(1 - out, 1e-6)), 0.0)
        return rest, *(np.concatenate(x, axis=-1) for x in zip(*rows, strict=True))

    def price(self, seen: Seen, leaf: np.ndarray, own: np.ndarray, cls: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of every token's leaf; cls: its class, if known. Each text has weights and a table of its own."""
        rest, tok, bit, speak, gates, inputs = self.decisions(seen, leaf, own, cls)
        if not len(tok):
            return rest
        sizes = np.diff(seen.first)
        rank = np.empty(seen.size, np.int64)
        rank[np.argsort(-sizes, kind="stable")] = np.arange(seen.size)
        pos = seen.pos
        turn = np.where(pos < _FIRST, 0, np.where(pos < 1024, np.frexp(np.maximum(pos, 1) / _FIRST)[1], 5 + pos // 1024))
        turn = np.minimum(turn, 32_000).astype(np.int16)[tok] if turn.max() < 32_000 else turn[tok]  # 16 bits are sorted faster
        order = np.argsort(turn, kind="stable")
        cut = np.append(np.flatnonzero(np.append(True, np.diff(turn[order]) > 0)), len(order))
        # All in the order of turns, so that a turn is a slice
        tok, bit, speak, inputs = tok[order], bit[order], speak[order], inputs[:, order]
        row = rank[seen.doc[tok]]
        gates = gates[:, order] + row * GATES
        p = np.empty(len(tok))
        w, v, apm = (np.tile(x, seen.size) for x in (self.weights.w, np.full(GATES, CALM), self.weights.apm))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            i = slice(a, b)
            p[i] = self.learn(row[i], int(row[i].max()) + 1, bit[i], speak[i], gates[:, i], inputs[:, i], w, v, apm, b < len(tok))
        rest += np.bincount(tok, weights=np.log10(np.where(bit, p, 1 - p)), minlength=len(rest))
        return rest

    @staticmethod
    def learn(rows, n_rows, bit, speak, g, x, w, v, apm, more: bool, rate: float = RATE) -> np.ndarray:
        """Probabilities of ones with the weights as they are; then learns from the decisions where more follow. rows: the
        texts; g: their gates, in the row's part of w."""
        z = w[g[0]] * x[0]
        for k in range(1, len(g)):
            z += w[g[k]] * x[k]
        np.clip(z, -11, 11, out=z)
        cell = cells(z, speak) + rows * (SETS * REFINE)
        s = 1 / (1 + np.exp(-z))
        p = np.clip(0.5 * s + 0.5 * apm[cell], 1e-5, 1 - 1e-5)
        if more:
            push, g, size = (x * (bit - s)).ravel(), g.ravel(), n_rows * GATES
            square = np.bincount(g, weights=push**2, minlength=size)
            hit = np.flatnonzero(square)  # all others stay as they are
            v[hit] += square[hit]
            w[hit] += rate * np.bincount(g, weights=push, minlength=size)[hit] / np.sqrt(v[hit]) * 4
            size = n_rows * SETS * REFINE
            n = np.bincount(cell, minlength=size)
            ones = np.bincount(cell, weights=bit, minlength=size)
            hit = np.flatnonzero(n)
            keep = KEEP ** n[hit]
            apm[hit] = apm[hit] * keep + ones[hit] / n[hit] * (1 - keep)
        return p


class Tally:
    """How often decisions were ones and zeros, by all that their prediction depends on: which predictors are for and
    against, the confidences of those that speak, and the stretched price of the word in steps of a quarter."""

    def __init__(self, most: int = 1 << 20):
        self.keys, self.n, self.held, self.most = np.zeros(0, np.int64), np.zeros(0, np.int64), [], most

    def add(self, bit, speak, gates, inputs) -> None:
        key = speak
        for e in range(EXPECT):
            key = key * SURE + np.where(inputs[1 + e] != 0, gates[1 + e] // SETS - 1 - e * SURE, 0)
        step = np.rint(inputs[0] * 4).astype(np.int64).clip(-_STEPS // 2, _STEPS // 2 - 1) + _STEPS // 2
        self.held.append((((key * _STEPS + step) << 1) | bit).astype(np.int32))
        if sum(map(len, self.held)) >= self.most:
            self.join()

    def join(self) -> None:
        if self.held:
            keys, n = np.unique(np.concatenate(self.held), return_counts=True)
            self.held = []
            self.keys, back = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
            self.n = np.bincount(back, weights=np.concatenate([self.n, n]), minlength=len(self.keys)).astype(np.int64)


def learned(keys: np.ndarray, n: np.ndarray) -> Weights:
    """Weights and refining table that all decisions of a tally (each key once) make likeliest."""
    weights = Weights()
    if not len(keys):
        return weights
    rows, back = np.unique(keys >> 1, return_inverse=True)
    n0, n1 = (np.bincount(back, weights=n * ((keys & 1) == bit), minlength=len(rows)) for bit in (0, 1))
    inputs, rest, sure = [(rows % _STEPS - _STEPS // 2) / 4], rows // _STEPS, []
    for _ in range(EXPECT):
        sure.append(rest % SURE)
        rest = rest // SURE
    speak = rest
    inputs += [speak // 3**e % 3 - 1 for e in range(EXPECT)]
    gates = [speak, *[gate_of_word(e, sure[EXPECT - 1 - e], speak) for e in range(EXPECT)]]
    weights.w = newton(gates, inputs, n0, n1, weights.w)
    z = np.clip(sum(weights.w[g] * x for g, x in zip(gates, inputs, strict=True)), -11, 11)
    cell = cells(z, speak)
    ones, every = (np.bincount(cell, weights=x, minlength=SETS * REFINE) for x in (n1, n0 + n1))
    weights.apm = (ones + CALM * weights.apm) / (every + CALM)
    return weights


def fit(like: np.ndarray, leaf_price: np.ndarray, table: np.ndarray, blocks) -> Weights:
    """blocks: (seen, leaf) of training texts. Their own counts are left out of the tables."""
    coder, tally = Coder(like, leaf_price, table, Weights()), Tally()
    for seen, leaf in blocks:
        tally.add(*coder.decisions(seen, leaf, np.ones(len(leaf), bool))[2:])
    tally.join()
    return learned(tally.keys, tally.n)
