"""Python over Arrow batches in bounded memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Texts that Python objects are made of at a time (beside one that may be longer), and what Spark puts in an Arrow batch.
PIECE_BYTES, BATCH_BYTES = 1 << 20, 4 << 20


def bounded(spark: SparkSession) -> None:
    """Bounds the bytes of Arrow batches where the session has Spark's default (64 MB)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in ("67108864", "67108864b", "64MB", "64m"):
        spark.conf.set(key, str(BATCH_BYTES))


def pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices whose texts come to about PIECE_BYTES."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0), np.int64)
        # Rows whose texts end in the same stretch of so many bytes: all but the first of them lie within it
        piece = np.cumsum(sizes) // PIECE_BYTES
        starts = [0, *(np.flatnonzero(piece[1:] != piece[:-1]) + 1), len(sizes)] if len(sizes) else [0, 0]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)
