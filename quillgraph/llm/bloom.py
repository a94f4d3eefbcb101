"""A Bloom filter over ids: of bounded size, built by Spark, for cheap pruning before an exact join."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix

#: Bits at most (16 MB); with more ids than fit, more rows pass and the exact join has more to do.
MAX_BITS = 1 << 27
HASHES = 4
_SALTS = mix(np.arange(101, 101 + HASHES).astype(np.uint64))


def _places(ids: np.ndarray, bits: int) -> np.ndarray:
    """HASHES places of each id."""
    h = ids.astype(np.int64).view(np.uint64)
    return np.stack([mix(h ^ s) & np.uint64(bits - 1) for s in _SALTS])


class Bloom:
    def __init__(self, ids: DataFrame, column: str):
        """ids: a table with a long column. Each task sends the words of its bits, which are united before they meet."""
        spark = ids.sparkSession
        n = ids.count()
        bits = self.bits = min(MAX_BITS, 1 << max(16, int(16 * max(1, n) - 1).bit_length()))

        def fill(batches):
            own = np.zeros(bits // 64, np.uint64)
            for batch in batches:
                p = _places(batch.column(0).to_numpy(), bits).ravel()
                np.bitwise_or.at(own, (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63)))
            at = np.flatnonzero(own)
            for a in range(0, len(at), 50_000):
                part = at[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(own[part].view(np.int64))], ["word", "bits"])

        rows = ids.select(F.col(column).cast("long").alias("id")).where("id IS NOT NULL").mapInArrow(fill, "word long, bits long")
        got = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        table = np.zeros(bits // 64, np.uint64)
        table[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
        self.table = spark.sparkContext.broadcast(table)

    def mask(self, ids: np.ndarray) -> np.ndarray:
        """Whether each id may be among those the filter was built of."""
        return _mask(self.table.value, self.bits, ids)

    def column(self, name: str):
        """The same as a column; null ids are never among them. Only the ids go to Python."""
        table, bits = self.table, self.bits

        @F.pandas_udf("boolean")
        def maybe(ids: pd.Series) -> pd.Series:
            known = ids.notna().to_numpy()
            out = np.zeros(len(ids), bool)
            out[known] = _mask(table.value, bits, ids[known].to_numpy(np.int64))
            return pd.Series(out)

        return maybe(F.col(name).cast("long"))


def _mask(table: np.ndarray, bits: int, ids: np.ndarray) -> np.ndarray:
    out = np.ones(len(ids), bool)
    for p in _places(ids, bits):
        out &= (table[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return out
