"""Benchmark decontamination: windows of normalised benchmark words looked up in every document.

The benchmark's windows (13 consecutive words; a shorter item is one window) become a sorted array of
64-bit hashes that is broadcast. A document's windows are hashed in one pass over its bytes; those whose
hash is known are verified word for word before they count. The broadcast has a proven size: a benchmark
of more than BLOCK_BYTES of text is dealt into blocks by item, one after the other scanned against all documents,
and a document's hits are joined afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm._store import written
from quillmill.llm._text import LOWER, in_batches, slices, text_buffers, window_hashes, word_hashes, word_spans

WINDOW = 13
#: The most benchmark text behind one broadcast, some 80 MB in a Python worker; the driver makes and holds one at a time.
BLOCK_BYTES = 16 << 20
#: A document is contaminated if it has hits and these are at least 1 / SHARE of its words.
SHARE = 20

REPORT = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
_PART = "row_key binary, doc_id bigint, n_words bigint, hits array<int>, items array<string>"


class Index:
    """Windows of some benchmark items, by length in words: sorted distinct hashes, where each window's words stand, the items that have it.

    Words are kept once, separated by single spaces; a window is verified against them. About 5 bytes a byte of text.
    """

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW) -> None:
        self.names: list[str] = []
        #: Items of windows whose hash another window has, which is not to be expected; by their words.
        self.others: dict[bytes, set[int]] = {}
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        parts: dict[int, list[tuple[np.ndarray, ...]]] = {}
        packed, base = [], 0
        for item, text in items:
            data = LOWER[np.frombuffer((text or "").encode(), dtype=np.uint8)]
            starts, ends, _ = word_spans(data, np.array([0, len(data)]))
            if not len(starts):
                continue
            size, raw = min(window, len(starts)), data.tobytes()
            packed.append(b" ".join([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]))
            hashes = window_hashes(word_hashes(data, starts, ends), size)
            stops = base + np.cumsum(ends - starts + 1) - 1
            begins = stops - (ends - starts)
            parts.setdefault(size, []).append((hashes, begins[: len(hashes)].astype(np.int32), stops[size - 1 :].astype(np.int32), np.full(len(hashes), len(self.names), np.int32)))
            base += len(packed[-1]) + 1
            self.names.append(item)
        self.packed = b" ".join(packed)
        for size, own in parts.items():
            hashes, begins, stops, items_of = (np.concatenate(x) for x in zip(*own, strict=True))
            order = np.lexsort((items_of, hashes))
            hashes, begins, stops, items_of = hashes[order], begins[order], stops[order], items_of[order]
            again = np.concatenate(([False], hashes[1:] == hashes[:-1]))
            head = np.maximum.accumulate(np.where(again, 0, np.arange(len(hashes))))
            keep = ~(again & np.concatenate(([False], items_of[1:] == items_of[:-1])))
            for i in np.flatnonzero(again).tolist():
                if self._words(begins, stops, i) != self._words(begins, stops, head[i]):
                    self.others.setdefault(self._words(begins, stops, i), set()).add(int(items_of[i]))
                    keep[i] = False
            first = np.flatnonzero(~again)
            count = np.add.reduceat(keep, first, dtype=np.int64)
            self.windows[size] = (hashes[first], np.stack((begins[first], stops[first]), axis=1), np.concatenate(([0], np.cumsum(count))).astype(np.int32), items_of[keep])

    def _words(self, begins: np.ndarray, stops: np.ndarray, i: int) -> bytes:
        return self.packed[begins[i] : stops[i]]

    def nbytes(self) -> int:
        return len(self.packed) + sum(x.nbytes for own in self.windows.values() for x in own)

    def scan(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, set[str]]]:
        """For each row: its number of words, their starts and ends in its bytes, which are hit, the items with occurring windows."""
        raw, at = text_buffers(column)
        data = LOWER[raw]
        starts, ends, rows = word_spans(data, at)
        first = np.searchsorted(rows, np.arange(len(at)))
        cover = np.zeros(len(starts) + 1, dtype=np.int64)
        found: dict[int, set[int]] = {}
        words, text = word_hashes(data, starts, ends), None
        for size, (known, spans, firsts, owners) in self.windows.items():
            windows = window_hashes(words, size)
            if not len(windows):
                continue
            place = np.minimum(np.searchsorted(known, windows), len(known) - 1)
            met: set[tuple[int, int]] = set()
            for i in np.flatnonzero((known[place] == windows) & (rows[: len(windows)] == rows[size - 1 :])).tolist():
                text = data.tobytes() if text is None else text
                own, k, row = b" ".join([text[a:b] for a, b in zip(starts[i : i + size].tolist(), ends[i : i + size].tolist(), strict=True)]), int(place[i]), int(rows[i])
                if own == self.packed[spans[k, 0] : spans[k, 1]]:
                    if (row, k) not in met:
                        met.add((row, k))
                        found.setdefault(row, set()).update(owners[firsts[k] : firsts[k + 1]].tolist())
                elif own in self.others:
                    found.setdefault(row, set()).update(self.others[own])
                else:
                    continue
                cover[i] += 1
                cover[i + size] -= 1
        hit = np.cumsum(cover[:-1]) > 0
        for k in range(len(at) - 1):
            a, b = first[k], first[k + 1]
            yield b - a, starts[a:b] - at[k], ends[a:b] - at[k], hit[a:b], {self.names[x] for x in found.get(k, ())}


def _items(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """Items with id and text as (item, text), and the number of blocks that they are dealt into."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text")).filter("item is not null and text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return items, max(1, -(-total // block_bytes))


def _block(items: DataFrame, k: int, n: int) -> list[tuple[str, str | None]]:
    block = items if n == 1 else items.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
    return [(r.item, r.text) for r in block.collect()]


def _parts(keyed: DataFrame, items: DataFrame, n: int, window: int, all_rows: bool) -> DataFrame:
    """Hits of each block as a table of its own, so that a block's index goes before the next one is made; the first has all rows if asked to."""
    parts = []
    for k in range(n):
        index = keyed.sparkSession.sparkContext.broadcast(Index(_block(items, k, n), window))
        parts.append(written(keyed.mapInArrow(_partial(index, all_rows and k == 0), _PART), "hits"))
        index.destroy()
    return reduce(DataFrame.unionByName, parts)


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null or wordless texts have no words, no hits and the digest of the empty string. Repeated document rows
    each get a row; repeated item rows count once; items without id or text are left out. Other columns are
    ignored, whatever their names. An empty benchmark leaves every document clean; no documents, no rows.
    """
    spark = docs.sparkSession
    items, n = _items(benchmark, block_bytes)
    if n == 1:
        index = spark.sparkContext.broadcast(Index(_block(items, 0, 1), window))

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "text"):
                rows = [(int(n), int(hit.sum()), len(items), _digest(items)) for n, _, _, hit, items in index.value.scan(part.column(1))]
                n, h, k, d = (list(x) for x in zip(*rows, strict=True))
                yield pa.record_batch([part.column(0), pa.array(n, pa.int64()), pa.array(h, pa.int64()), pa.array(k, pa.int64()), pa.array(d, pa.string()), pa.array([b > 0 and share * b >= a for a, b in zip(n, h, strict=True)], pa.bool_())], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

        return in_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(whole, REPORT)
    # One row per document and block; documents without id are told apart by their digest, equal rows by their number.
    keyed = in_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("row_key"))
    parts = _parts(keyed, items, n, window, True)
    joined = parts.groupBy("row_key", "doc_id").agg(
        F.count_if(F.col("n_words").isNotNull()).alias("copies"), F.max("n_words").alias("n_words"),
        F.size(F.array_distinct(F.flatten(F.collect_set("hits")))).cast("bigint").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return joined.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def _partial(index, all_rows: bool):
    """The first block's rows stand for the documents; later blocks add rows only where they hit."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            keep, n_words, hits, ids = [], [], [], []
            for k, (n, _, _, hit, items) in enumerate(index.value.scan(part.column(1))):
                if all_rows or items:
                    keep.append(k)
                    n_words.append(int(n) if all_rows else None)
                    hits.append(np.flatnonzero(hit).astype(np.int32))
                    ids.append(sorted(items))
            taken = part.take(pa.array(keep, pa.int64()))
            yield pa.record_batch([taken.column(2), taken.column(0), pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(ids, pa.list_(pa.string()))], names=["row_key", "doc_id", "n_words", "hits", "items"])

    return scan


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without contaminated documents, and without the hit passages of the others; columns stay as they are.

    A passage goes from the first byte of its first hit word to the last byte of its last; n_chars, if there, is
    counted anew for texts that changed. Texts without hits, null texts among them, stay byte for byte. The hits of
    a benchmark of several blocks are gathered from the original texts first, so its size changes nothing. Repeated rows
    stay or go together, rows without id are judged as any; without benchmark all stay, and an empty table stays empty.
    """
    columns = docs.columns
    text_at, n_chars_at, hits_at = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None, len(columns)
    items, n = _items(benchmark, block_bytes)
    if n == 1:
        index = docs.sparkSession.sparkContext.broadcast(Index(_block(items, 0, 1), window))
        return in_batches(docs).mapInArrow(_cutter(lambda part: index.value.scan(part.column(text_at)), share, text_at, n_chars_at, columns), docs.schema)
    # What is hit depends on the text alone, so its digest joins the hits to the rows.
    key = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    keyed = in_batches(docs).select(F.lit(None).cast("bigint").alias("doc_id"), "text", key.alias("row_key"))
    hits = _parts(keyed, items, n, window, False).groupBy(F.col("row_key").alias("__key")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("hits")))).alias("__hits"))
    joined = docs.withColumn("__row_key", key).join(hits, F.col("__row_key") == F.col("__key"), "left").select(*columns, "__hits")
    return joined.mapInArrow(_cutter(lambda part: _gathered(part.column(text_at), part.column(hits_at)), share, text_at, n_chars_at, columns), docs.schema)


def _gathered(column: pa.Array, hits: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, set[str]]]:
    """What Index.scan gives, without items, from the numbers of the words that are hit."""
    raw, at = text_buffers(column)
    starts, ends, rows = word_spans(LOWER[raw], at)
    first = np.searchsorted(rows, np.arange(len(at)))
    for k in range(len(at) - 1):
        a, b = first[k], first[k + 1]
        hit = np.zeros(b - a, dtype=bool)
        hit[np.array(hits[k].as_py() or [], dtype=np.int64)] = True
        yield b - a, starts[a:b] - at[k], ends[a:b] - at[k], hit, set()


def _cutter(scan, share: int, text_at: int, n_chars_at: int | None, columns: list[str]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            keep, texts, changed = [], {}, False
            for k, (n, starts, ends, hit, _) in enumerate(scan(part)):
                hits = int(hit.sum())
                if hits and share * hits >= n:
                    continue
                keep.append(k)
                if hits:
                    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
                    raw, pieces, last = part.column(text_at)[k].as_py().encode(), [], 0
                    for a, b in zip(starts[np.flatnonzero(edge == 1)].tolist(), ends[np.flatnonzero(edge == -1) - 1].tolist(), strict=True):
                        pieces.append(raw[last:a])
                        last = b
                    texts[k] = b"".join([*pieces, raw[last:]]).decode()
                    changed = True
            if changed:
                column = part.column(text_at)
                whole = [texts.get(k, None) if k in texts else column[k].as_py() for k in range(part.num_rows)]
                part = part.set_column(text_at, part.schema.field(text_at), pa.array(whole, column.type))
                if n_chars_at is not None:
                    counts = part.column(n_chars_at)
                    part = part.set_column(n_chars_at, part.schema.field(n_chars_at), pa.array([len(texts[k]) if k in texts else counts[k].as_py() for k in range(part.num_rows)], counts.type))
            yield part.select(columns).take(pa.array(keep, pa.int64()))

    return cut
