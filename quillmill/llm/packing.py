"""Packing token sequences into windows by non-negative least squares over length combinations.

A document's ids are cut into whole windows and a rest, so what is packed is a histogram of at most `window`
lengths, whatever the number of documents. On it the driver enumerates combinations of two to four lengths
that fill a window exactly, solves their repeat counts as a non-negative least-squares fit to the histogram,
rounds these down, and packs what is left greedily, largest piece first, again by whole repeats of a pattern.
The plan has at most 7 combinations and one greedy pattern a length; pieces find their place in it by their rank among
those of their length, which is counted in parts of PART_ROWS so that a common length is not one task.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm._store import written
from quillmill.llm._text import in_batches, slices

WINDOW = 4096
END = 2
TOKENIZER = "word_bpe_49k.json"
#: Pieces of one length that are ranked in one task, on average at most.
PART_ROWS = 100_000
ROUNDS = 200
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, dealt int"

# --- token ids

#: Words of a generation that a Python worker keeps with their ids.
KEPT_WORDS = 150_000
#: Characters whose normal form, class and lower case are plain: of others the library's own normaliser is asked.
_PLAIN = "\t\n\x0b\x0c\r\x20-\x7eÀ-ÖØ-öø-ÿ¡¿«»‘’“”–—…•€©®°"
_ODD = re.compile(f"[^{_PLAIN}]")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


class Encoder:
    """Ids of texts as little-endian 32-bit bytes: the tokenizer's own ids, each distinct word encoded once.

    Words are kept in two generations, so that a full table loses the words not met since it was last full.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same model for words that are normal and split already.
        self.by_word = Tokenizer(self.tokenizer.model)
        self.by_word.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, met: set[str]) -> None:
        if len(self.words) > KEPT_WORDS:
            self.words, self.older = {}, self.words
        fresh = []
        for word in met.difference(self.words):
            known = self.older.get(word)
            if known is None:
                fresh.append(word)
            else:
                self.words[word] = known
        if fresh:
            # Each is one word to the tokenizer too, so one call over them all gives each word's ids; its last one ends a word.
            ids = np.array(self.by_word.encode_batch_fast([fresh], is_pretokenized=True, add_special_tokens=False)[0].ids, dtype="<u4")
            ends = [0, *(np.flatnonzero(self.ends[ids]) + 1).tolist()]
            raw = ids.tobytes()
            self.words.update((word, raw[4 * a : 4 * b]) for word, a, b in zip(fresh, ends[:-1], ends[1:], strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split: list[list[str] | None] = []
        met: set[str] = set()
        for text in texts:
            if text and ("<|" in text or _ODD.search(text)):
                split.append(None)
                continue
            words = _PIECE.findall(text.lower()) if text else []
            met.update(words)
            split.append(words)
        self._learn(met)
        get = self.words.__getitem__
        return [b"".join(map(get, words)) if words is not None else np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes() for text, words in zip(texts, split, strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, window: int = WINDOW, end: int = END, tokenizer: str | None = None) -> DataFrame:
    """The pieces of each row: doc_id, start, length, ids_crc32, doc_tokens, and the number dealt to it in its task."""
    last = np.array([end], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for part in slices(batches, "text"):
            rows = []
            for doc, ids in zip(part.column(0).to_pylist(), encoder(tokenizer).encode(part.column(1).to_pylist()), strict=True):
                ids += last
                rows += [(doc, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, (n := n + 1) & 0x7FFFFFFF) for at in range(0, len(ids), 4 * window) for piece in (ids[at : at + 4 * window],)]
            columns = list(zip(*rows, strict=True))
            yield pa.record_batch([pa.array(c, pa.int32() if k == 5 else pa.int64()) for k, c in enumerate(columns)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "dealt"])

    return in_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, PIECES)


# --- the plan


def combinations(histogram: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rows of two to four lengths (0: none), each with pieces in the histogram, whose sum is the window."""
    lengths = np.flatnonzero(histogram[:window])
    rest, rows = window - lengths, []
    rows.append([lengths, rest])
    for part in (1 / 2, 1 / 4, 1 / 16):
        second = (rest * part).astype(np.int64)
        third = rest - second
        fourth = third // 2
        rows += [[lengths, second, third], [lengths, second, third - fourth, fourth]]
    out = np.zeros((len(lengths) * len(rows), 4), dtype=np.int64)
    for k, row in enumerate(rows):
        for d, values in enumerate(row):
            out[k * len(lengths) : (k + 1) * len(lengths), d] = values
    depth = np.repeat([len(r) for r in rows], len(lengths))
    real = np.arange(4) < depth[:, None]
    out = out[((out > 0) | ~real).all(axis=1) & ((histogram[out] > 0) | ~real).all(axis=1)]
    return np.unique(np.sort(out, axis=1)[:, ::-1], axis=0)


def repeats(rows: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative x that brings the lengths used by x repeats of the rows near the histogram in least squares, by multiplicative updates."""
    goal = histogram.astype(float)
    goal[0] = 0
    x = np.ones(len(rows))
    toward = goal[rows].sum(axis=1)
    for _ in range(rounds):
        used = np.bincount(rows.ravel(), np.repeat(x, rows.shape[1]), len(goal))
        used[0] = 0
        x *= toward / np.maximum(used[rows].sum(axis=1), 1e-12)
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, rank from, rank to, first sequence, pieces a sequence, offset) for histogram[length] pieces of each length.

    Piece rank r of a slot goes to sequence first + (r - from) // pieces, at offset + (r - from) % pieces * length.
    """
    left, taken = histogram.astype(np.int64).copy(), np.zeros(window + 1, dtype=np.int64)
    slots, sequences = [], 0

    def place(pattern: list[tuple[int, int]], times: int) -> None:
        nonlocal sequences
        offset = 0
        for length, n in pattern:
            a = int(taken[length])
            slots.append((length, a, a + n * times, sequences, n, offset))
            taken[length] += n * times
            left[length] -= n * times
            offset += n * length
        sequences += times

    rows = combinations(left, window)
    if len(rows):
        x = np.floor(repeats(rows, left)).astype(np.int64)
        for k in np.argsort(-x, kind="stable"):
            if not x[k]:
                break
            lengths, n = np.unique(rows[k][rows[k] > 0], return_counts=True)
            times = min(int(x[k]), int((left[lengths] // n).min()))
            if times:
                place([(int(a), int(b)) for a, b in zip(lengths[::-1], n[::-1], strict=True)], times)
    there = np.flatnonzero(left).tolist()
    while there:
        pattern, gap, k = [], window, len(there)
        while (k := min(k, bisect_right(there, gap))) > 0:
            length = there[k - 1]
            n = min(gap // length, int(left[length]))
            pattern.append((length, n))
            gap -= n * length
            k -= 1
        place(pattern, min(int(left[length]) // n for length, n in pattern))
        there = [x for x in there if left[x]] if any(not left[x] for x, _ in pattern) else there
    return slots


def pack(docs: DataFrame, window: int = WINDOW, end: int = END, tokenizer: str | None = None) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is one piece of the end id alone. Documents of up to `window` ids stay whole. Repeated rows
    are packed each; a document without id keeps its pieces under null. Other columns are ignored, whatever their
    names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, window, end, tokenizer), "pieces")
    histogram = np.zeros(window + 1, dtype=np.int64)
    for row in cut.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most `window` rows
        histogram[row.length] = row.n
    # Common lengths are dealt in as many parts as their rows need; pieces are a table by now, so that their numbers stay.
    parts = F.split(F.lit(",".join(str(-(-n // PART_ROWS)) for n in histogram.tolist())), ",").cast("array<int>")
    cut = cut.withColumn("salt", F.pmod("dealt", F.get(parts, F.col("length").cast("int"))))
    counts = cut.groupBy("length", "salt").agg(F.count("*").alias("n"))
    slots = spark.createDataFrame(plan(histogram, window), "size int, rank_from bigint, rank_to bigint, sequence bigint, each bigint, first_offset bigint")
    before = counts.select(F.col("length").alias("of"), F.col("salt").alias("part"), (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    ranked = cut.withColumn("in_part", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")))
    ranked = ranked.join(before, (F.col("length") == F.col("of")) & (F.col("salt") == F.col("part"))).withColumn("rank", F.col("before") + F.col("in_part") - 1)
    # The plan has at most 7 combinations and a greedy pattern a length (some 10 ** 5 slots), so it fits a broadcast at any number of documents.
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")))
    at = F.col("rank") - F.col("rank_from")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("sequence") + F.floor(at / F.col("each"))).alias("sequence_id"), (F.col("first_offset") + at % F.col("each") * F.col("length")).alias("offset"))
