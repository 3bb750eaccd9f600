"""Hashed word-shingle sets of many texts at once (inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from tsubo.llm.byte_hash import Hasher, buffers, chunks, mix

# Hashing takes some 40 times the bytes of a chunk at its peak.
CHUNK_BYTES = 1 << 18
# Rows of an Arrow batch that are worked on, and sent on, at once.
ROWS_AT_ONCE = 1000
# Bytes of an Arrow batch: a batch of 10,000 texts or token sets has tens of MB, several times over in JVM and worker.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_M = np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a chunk, and per row where its shingles begin (rows + 1 numbers).

    A-Z are lower-cased.  A row with fewer than ``width`` words has one shingle,
    the whole sequence; a row without words has none.
    """
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = Hasher(_LOWER[data]).ranges(starts, ends)
    at = np.searchsorted(starts, offsets)
    count = np.diff(at)
    made = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    begin = np.zeros(rows + 1, np.int64)
    np.cumsum(made, out=begin[1:])
    # the words at which shingles begin: all but the last width - 1 of a row, or the first of a short row
    index = np.repeat(at[:-1] - begin[:-1], made) + np.arange(begin[-1])
    short = np.repeat(count < width, made)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    limit = np.repeat(at[1:], made)
    out = np.zeros(len(index), np.uint64)
    for k in range(width):
        part = padded[index + k]
        if short.any():
            part = np.where(index + k < limit, part, np.uint64(k + 1))
        out = out * _M + part
    return mix(out), begin


def batches(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of each bounded chunk of a batch's column."""
    data, offsets = buffers(batch.column(column))
    for row, end in chunks(offsets, CHUNK_BYTES):
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]


@contextmanager
def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    """Inside, jobs hand Python Arrow batches of about ``most`` bytes, or of one row; the session's own setting returns after."""
    before = spark.conf.get(_BATCH_SETTING, None)
    spark.conf.set(_BATCH_SETTING, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_SETTING)
        else:
            spark.conf.set(_BATCH_SETTING, before)


def slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a bounded number of rows, so that results of a whole batch are never held."""
    for batch in parts:
        for row in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(row, ROWS_AT_ONCE)


def row_sets(batch: pa.RecordBatch, column: str, width: int) -> Iterator[np.ndarray]:
    """Per row of a batch, its distinct shingle hashes in ascending order."""
    for _, data, offsets in batches(batch, column):
        hashes, begin = shingle_hashes(data, offsets, width)
        for row in range(len(begin) - 1):
            yield np.unique(hashes[begin[row] : begin[row + 1]])


def binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
