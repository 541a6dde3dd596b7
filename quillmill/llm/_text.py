"""Arrow text columns as byte arrays: slicing, word spans and rolling hashes without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

U64 = np.uint64
#: Odd multipliers, so that they have an inverse modulo 2**64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: Bytes of text handled at once; numpy temporaries are a few dozen times as large.
SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: A word byte after lower-casing: digit, a-z, or any byte of a non-ASCII character.
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


#: Rows of an Arrow batch of texts; a batch is held at once by Spark, outside its heap, and by Python.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_batches(df: DataFrame) -> DataFrame:
    """df, with its session set to batches of BATCH_ROWS rows at most; texts are large rows, for which Spark's own number is too high."""
    session = df.sparkSession
    if not 0 < int(session.conf.get(_BATCH)) <= BATCH_ROWS:
        session.conf.set(_BATCH, str(BATCH_ROWS))
    return df


#: All bytes but white space.
VISIBLE = np.ones(256, dtype=bool)
VISIBLE[[9, 10, 11, 12, 13, 32]] = False


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null reads as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about `limit` bytes of text; a longer text is a run of its own."""
    for batch in batches:
        _, at = text_buffers(batch.column(batch.schema.get_field_index(column)))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def word_spans(data: np.ndarray, at: np.ndarray, kind: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of bytes of a kind (words of lower-cased bytes); runs do not cross rows."""
    is_word = kind[data]
    if not is_word.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = False, is_word[:-1]
    starts = np.flatnonzero(is_word & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = False, is_word[1:]
    ends = np.flatnonzero(is_word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(at, starts, side="right") - 1


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo 2**64; kept while n is moderate."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 12), base, dtype=U64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if n <= 4 * SLICE_BYTES:
            _POWERS[base] = have
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of values[start:end] of each span, the same wherever the span stands."""
    prefix = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum((values.astype(U64) + U64(1)) * powers(base, len(values)), out=prefix[1:])
    shift = powers(inverse(base), len(values) + 1)[starts]
    return mix((prefix[ends] - prefix[starts]) * shift + (ends - starts).astype(U64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(data, starts, ends, BYTE_BASE)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` consecutive word hashes, by its first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    at = np.arange(n)
    return span_hashes(words, at, at + size, WORD_BASE)
