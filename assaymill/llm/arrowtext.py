"""Helpers for operators that scan whole texts in Arrow batches with numpy.

A batch reaches a task as a column of strings; these helpers cut it into chunks of bounded size (a chunk always holds
whole rows, so a text longer than the bound is a chunk of its own) and view the chunk as one byte array with row offsets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Text bytes that one numpy pass works on; memory in a task is a small multiple of this.
CHUNK_BYTES = 4 << 20

#: Row and byte bounds of the Arrow batches handed to Python, so that neither side of the pipe holds a large batch.
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def plain(array: pa.Array) -> pa.Array:
    """The column as large binary without nulls (null: empty) and without an offset."""
    array = array.cast(pa.large_binary())
    return array.fill_null(b"") if array.null_count else array


def chunks(batches, column: str = "text", limit: int = CHUNK_BYTES):
    """Slices of the record batches with about `limit` bytes of text each."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        size = np.diff(byte_view(batch.column(batch.schema.get_field_index(column)))[1])
        total, start, held = np.cumsum(size), 0, 0
        while start < n:
            end = max(start + 1, int(np.searchsorted(total, held + limit, side="right")))
            yield batch.slice(start, end - start)
            held, start = int(total[end - 1]), end


def byte_view(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, offsets of the rows in them); null counts as empty."""
    a = plain(array)
    offs = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = a.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = int(offs[0]) if len(offs) else 0
    return buf[first:int(offs[-1])], offs - first


def texts(array: pa.Array) -> list[str]:
    """The rows as Python strings; null counts as empty, broken UTF-8 is replaced."""
    return [b.decode("utf-8", "replace") for b in plain(array).to_pylist()]


#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing: digits, letters and all of non-ASCII.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True


#: As WORD_BYTE, with runs of ASCII punctuation as words of their own (kind 2).
WORD_OR_MARK = WORD_BYTE.astype(np.uint8)
WORD_OR_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 2


class Words:
    """The words of a chunk: byte ranges `start:end` in the lower-cased bytes `low`, and the row of each.

    A word is a run of bytes of one kind within a row; kind 0 separates.
    """

    def __init__(self, buf: np.ndarray, offs: np.ndarray, kinds: np.ndarray = WORD_BYTE):
        self.low = LOWER[buf]
        kind = kinds[self.low]
        cut = np.ones(len(buf) + 1, bool)  # between bytes of unlike kinds, and at the edges of rows
        cut[1:-1] = kind[1:] != kind[:-1]
        cut[offs] = True
        inside = kind != 0
        self.start = np.flatnonzero(inside & cut[:-1])
        self.end = np.flatnonzero(inside & cut[1:]) + 1
        self.row = np.searchsorted(offs, self.start, side="right") - 1
        self.n_rows = len(offs) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.n_rows).astype(np.int64)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word; equal words have equal hashes in every task."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        within = np.arange(int(size.sum())) - np.repeat(first, size)
        letters = BYTE_KEYS[self.low[np.repeat(self.start, size) + within]]
        letters *= PLACE_KEYS[within & 0xFFFF]
        return mix(np.add.reduceat(letters, first) + size.astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.low[self.start[i]:self.end[i]].tobytes()


def _keys(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


BYTE_KEYS = _keys(11, 256)
PLACE_KEYS = _keys(12, 1 << 16)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser over unsigned 64-bit integers."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def windows(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of `length` consecutive hashes (one fewer than `length` results fall away at the end)."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[k:k + n]
    return mix(out)
