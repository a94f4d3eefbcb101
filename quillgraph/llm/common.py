"""What the operators share: the shared folder, code for executors, and a vectorised word scanner."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa

#: Fixed value: the word pattern of all contracts, as a Java and Python regular expression.
WORD = r"[^\x20\x09-\x0D]+"
#: Fixed value: what separates words.
GAP = r"[\x20\x09-\x0D]+"

_shipped: set[str] = set()


def read(spark, sf_dir: str, table: str):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Rows of an Arrow batch: batches hold whole texts, and several are in memory on both sides.
BATCH_ROWS = 2_000


def ship(spark) -> None:
    """Hands this package to the executors through Spark's own file server, once per application, and bounds Arrow batches
    where the session has not done so."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # Spark's default
        spark.conf.set(key, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="quill"), "quillgraph.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def shared_dir(spark) -> str:
    """The folder that driver and executors share, as the session names it. A folder of our own is
    made only in a single-machine session that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    folder = tempfile.mkdtemp(prefix="quill-shared")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive executors. Results that are read lazily need them
    until they have been read; Scratch.release() then removes what is left."""

    live: list = []

    def __init__(self, spark):
        Scratch.live.append(self)
        self.spark, self.base = spark, f"{shared_dir(spark).rstrip('/')}/quill-{uuid.uuid4().hex}"
        self.n = 0

    def table(self, df):
        """Writes df and returns it as read from its table; .quill_path has the folder."""
        self.n += 1
        path = f"{self.base}/t{self.n}"
        df.write.option("compression", "snappy").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.quill_path = path
        return out

    def drop(self, *tables) -> None:
        """Removes tables that nothing reads any more."""
        for t in tables:
            self._delete(t.quill_path)

    def last(self, df):
        """The result as read from its own table, after all other tables of this scratch space are removed."""
        out = Scratch(self.spark).table(df)
        self._delete(self.base)
        return out

    @staticmethod
    def release(since: int = 0) -> None:
        """Removes the tables of all scratch spaces opened after the first `since` ones."""
        for s in Scratch.live[since:]:
            s._delete(s.base)
        del Scratch.live[since:]

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


# ---------------------------------------------------------------- words of Arrow strings

IS_GAP = np.zeros(256, bool)
IS_GAP[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_R = 0x9E3779B97F4A7C15
_R_INV = pow(_R, -1, 1 << 64)
_TABLE = np.random.RandomState(20240607).randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _pow(n: int):
    global _powers
    if len(_powers[0]) < n:
        n = max(n, 1 << 20)
        up, down = np.full(n, _R, np.uint64), np.full(n, _R_INV, np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up), np.cumprod(down)
    return _powers


def flat(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings and n + 1 offsets into them; a null is empty."""
    if strings.null_count:
        strings = strings.fill_null("")
    if not len(strings):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(strings.type)
    _, where, data = strings.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Word starts and ends (bytes) of texts, and the text each word stands in."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_gap: np.ndarray = IS_GAP):
        self.data, self.offsets = data, offsets
        n = len(data)
        if not n:
            self.start = self.end = self.doc = np.zeros(0, np.int64)
            self.first = np.zeros(len(offsets), np.int64)
            return
        gap = is_gap[data]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        cut[n] = True
        before = np.ones(n, bool)
        before[1:] = gap[:-1]
        before |= cut[:-1]
        after = np.ones(n, bool)
        after[:-1] = gap[1:]
        after |= cut[1:]
        self.start = np.flatnonzero(~gap & before)
        self.end = np.flatnonzero(~gap & after) + 1
        #: words[first[i]:first[i + 1]] are those of text i
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def hashes(self, lower: bool = True) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = _pow(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_TABLE[LOWER[self.data] if lower else self.data] * up[: len(self.data)], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start])


def shingles(words: Words, hashes: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of k words, a text of 1 to k - 1 words being one window, and the text of each."""
    n = np.diff(words.first)
    if not len(hashes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(len(hashes), np.uint64)
    for j in range(min(k, len(hashes))):
        part = hashes * np.uint64(pow(_R, j + 1, 1 << 64))
        total[: len(hashes) - j] += part[j:]
    per = np.where(n >= k, n - k + 1, 0)
    text = np.repeat(np.arange(len(n)), per)
    at = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per) + words.first[:-1][text]
    out = mix(total[at])
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        h = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = n[short] > j
            h[has] += hashes[words.first[:-1][short[has]] + j] * np.uint64(pow(_R, j + 1, 1 << 64))
        h = mix(h ^ (n[short].astype(np.uint64) << np.uint64(56)))
        out, text = np.concatenate([out, h]), np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        out, text = out[order], text[order]
    return out, text


def merged(batches, rows: int = 20_000):
    """Batches of short rows put together, so that each is worth a vectorised pass."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def pieces(strings: pa.Array, limit: int = 1 << 20):
    """Row ranges of about `limit` bytes each, so that memory is bounded; a longer text stands alone."""
    sizes = np.diff(flat(strings)[1])
    at, filled = 0, 0
    for i, size in enumerate(sizes):
        if filled and filled + size > limit:
            yield at, i
            at, filled = i, 0
        filled += size
    if at < len(sizes):
        yield at, len(sizes)
