"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Words and runs of signs are hashed to a fixed number of slots as unigrams and bigrams, and once more by shape
(length, case, sign, equal to the word before), so that a habit such as shouting or stuttering is one feature
whatever the words. A row's values are counts over its number of words. Training runs over a bounded sample in
a few shards, bounded in rows and bytes, each a task with its own leader; their weights are averaged. A model is 2**BITS numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm._labels import held_out, sample
from quillmill.llm._store import written
from quillmill.llm._text import BYTE_BASE, LOWER, U64, WORD, in_batches, mix, slices, span_hashes, text_buffers

BITS = 18
#: Labelled rows to fit on; rows, and bytes of text, that a shard has on average at most. Features take some 10 bytes a byte of text.
MOST_LABELLED, SHARD_ROWS, SHARD_BYTES = 16_384, 4_096, 16 << 20
EPOCHS = 4
#: Step, smoothing and penalties of the leader.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.05
#: Counts over words are multiplied by this, so that a feature of every tenth word has a value of one.
SCALE = 10.0
THRESHOLD = 0.3

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[65:91] = 1
#: 0 space, 1 word, 2 sign.
_KIND = np.where(_SPACE, 0, np.where(WORD[LOWER], 1, 2)).astype(np.int8)


def features(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and slot of each feature occurrence, and the number of words and sign runs of each row."""
    raw, at = text_buffers(column)
    kind = _KIND[raw]
    n_rows = len(at) - 1
    if not kind.any():
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(n_rows, np.int64)
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[at] = True
    edge[1:-1] |= kind[1:] != kind[:-1]
    edge[0] = edge[-1] = True
    places = np.flatnonzero(edge)
    starts, ends = places[:-1], places[1:]
    full = kind[starts] > 0
    starts, ends = starts[full], ends[full]
    rows = np.searchsorted(at, starts, side="right") - 1
    hashes = span_hashes(LOWER[raw], starts, ends, BYTE_BASE)
    after = np.zeros(len(rows), dtype=bool)
    after[1:] = rows[1:] == rows[:-1]
    before = np.where(after, np.roll(hashes, 1), U64(7))
    words = kind[starts] == 1
    capitals = np.concatenate(([0], np.cumsum(_UPPER[raw])))
    capitals = capitals[ends] - capitals[starts]
    length = ends - starts
    case = np.where(capitals == 0, 0, np.where((capitals > 1) & (2 * capitals > length), 2, 1))
    shape = np.where(words, np.minimum(length, 30) // 4 * 3 + case, 64 + np.minimum(length, 3) * 256 + raw[starts])
    shape = shape.astype(U64) * U64(2) + (before == hashes)
    shape_before = np.where(after, np.roll(shape, 1), U64(1))
    slots = [hashes, mix(before * U64(31) + hashes), mix(shape + U64(1 << 40)), mix(shape_before * U64(1 << 20) + shape + U64(1 << 41))]
    return np.tile(rows, 4), np.concatenate([(x >> U64(64 - bits)).astype(np.int64) for x in slots]), np.bincount(rows, minlength=n_rows)


class Leader:
    """Follow the regularised leader, proximal, per coordinate; slot 2**bits is the constant."""

    def __init__(self, bits: int = BITS) -> None:
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, i: np.ndarray | slice) -> np.ndarray:
        z = self.z[i]
        return np.where(np.abs(z) <= L1, 0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(self.n[i])) / ALPHA + L2))

    def learn(self, i: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(i)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
        self.z[i] += g - (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / ALPHA * w
        self.n[i] += g * g


def sparse(column: pa.Array, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct slots and values of each row, the constant last."""
    rows, slots, n = features(column, bits)
    keys, counts = np.unique((rows << (bits + 1)) | slots, return_counts=True)
    cut = np.searchsorted(keys >> (bits + 1), np.arange(len(n) + 1))
    values = counts * (SCALE / np.maximum(n, 1)[keys >> (bits + 1)])
    return [(np.append(keys[a:b] & ((1 << (bits + 1)) - 1), 1 << bits), np.append(values[a:b], 1.0)) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED, bits: int = BITS) -> np.ndarray | None:
    """The weights, or None if the sample has no rows of one of the classes."""

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for part in slices(batches, "text"):
            rows += [(order, y, i, x) for order, y, (i, x) in zip(part.column(2).to_pylist(), part.column(1).to_pylist(), sparse(part.column(0), bits), strict=True)]
        if rows:
            rows.sort(key=lambda r: r[0])
            leader = Leader(bits)
            for _ in range(EPOCHS):
                for _, y, i, x in rows:
                    leader.learn(i, x, y)
            yield pa.record_batch([pa.array([len(rows)]), pa.array([sum(r[1] for r in rows)]), pa.array([leader.weights(slice(None)).tobytes()])], names=["n", "ones", "weights"])

    chosen = written(sample(in_batches(docs), labels, label, most).withColumn("order", F.xxhash64("doc_id", "text")), "labelled")
    size = chosen.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, most // SHARD_ROWS, -(-size // SHARD_BYTES))
    known = chosen.select("text", "y", "order").repartition(shards, F.pmod("order", F.lit(shards))).mapInArrow(lead, "n bigint, ones double, weights binary").collect()
    rows, ones = sum(r.n for r in known), sum(r.ones for r in known)
    if not 0 < ones < rows:
        return None
    return sum(np.frombuffer(r.weights) * (r.n / rows) for r in known)


def score(docs: DataFrame, weights: np.ndarray | None, threshold: float = THRESHOLD, bits: int = BITS) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. Null and empty texts score by the constant alone; without a model all score 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(weights if weights is not None else np.zeros((1 << bits) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for part in slices(batches, "text"):
            rows, slots, n = features(part.column(2), bits)
            dot = np.bincount(rows, w[slots], len(n)) * (SCALE / np.maximum(n, 1)) + w[-1]
            p = 1 / (1 + np.exp(-np.clip(dot, -30, 30)))
            yield pa.record_batch([part.column(0), part.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    known = in_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return known.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD, most: int = MOST_LABELLED) -> DataFrame:
    """Train on labelled rows outside the held-out fold (crc32 of the id modulo 5 is 0), then score every row of docs.

    Nothing but the text enters a score. Repeated rows each get a row; rows without id are scored, never learned
    from and not held out; other columns are ignored, whatever their names; an empty table gives no rows.
    """
    return score(docs, train(docs, labels, label, most), threshold)
