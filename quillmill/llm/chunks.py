"""Substring dedup by content-defined chunking with a gear rolling hash.

A byte is a cut where the gear hash of the bytes up to it is small; the hash is kept modulo 2**16, so 16 bytes decide
and a passage is cut the same way wherever it stands. A chunk goes from a strong cut, where the hash is smaller still, to
the first cut that leaves it at least LEAST_WORDS words; so chunks overlap, their sizes vary with what they hold, and
an insertion changes those around it alone. A stretch without cuts, such as a few words said over and over, is cut where
its hash is least among its neighbours.

Chunks are deduplicated by a digest of 128 bits: one that is met in two documents or more stays in the document with the
smallest id and is a copy elsewhere. As a chunk holds many words, it alone is a passage; consecutive ones that stand in
one holder, at one distance, are joined, so that each passage stands there from its first word to its last.

Digests are counted with a partial aggregate, so that a very common chunk is a row a task, and met again by a
join on the digest that Spark can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm._native import replaced
from quillmill.llm._store import written
from quillmill.llm._text import in_batches, slices, text_buffers

#: Bytes that decide a cut; of 2**16 hash values those that cut, and those that begin a chunk: every 8th and every 24th byte.
WINDOW, CUTS, STRONG = 16, (1 << 16) // 8, (1 << 16) // 24
#: Words of a chunk at least. A passage of 51 words of six bytes holds a chunk but for one in 400.
LEAST_WORDS = 20
#: Bytes without a strong cut from which on a stretch is cut by its least hashes, and how many neighbours these are least of.
STRETCH, REACH = 96, 32
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([i]), 9) & 0xFFFF for i in range(256)], dtype=np.uint16)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte, modulo 2**16: the sum over the last 16 bytes of their table values, doubled for each byte since."""
    h, reach = _GEAR[data], 1
    while reach < WINDOW:
        h[reach:] += h[:-reach] << np.uint16(reach)
        reach *= 2
    return h


def cuts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cuts in some rows' bytes, with the rows' own edges, and which of them begin a chunk; none parts a character."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none.astype(bool)
    h = gear(data)
    within = np.ones(len(data) + 1, dtype=bool)  # places at which a character starts
    within[:-1] = data & 0xC0 != 0x80
    found = np.flatnonzero((h < CUTS) & within[1:]) + 1
    # The window lies in the row, so that what precedes the row does not matter.
    found = found[found - at[np.searchsorted(at, found, side="left") - 1] >= WINDOW]
    strong = found[h[found - 1] < STRONG]
    edges = np.unique(np.concatenate((at, strong)))
    more = _least(h, within, at, edges)
    places = np.unique(np.concatenate((at, found, more)))
    begins = np.isin(places, np.concatenate((edges, more)), assume_unique=False)
    return places, begins


def _least(h: np.ndarray, within: np.ndarray, at: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """In stretches of more than STRETCH bytes between edges: places after a byte whose hash none within REACH bytes undercuts."""
    long = np.flatnonzero(np.diff(edges) > STRETCH)
    if not len(long):
        return np.zeros(0, np.int64)
    sizes = np.diff(edges)[long]
    inside = np.repeat(edges[long], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # Stretches stand side by side, so neighbours of two of them are met here, which costs a cut near an edge at most.
    own = h[inside].astype(np.int32)
    own[~within[inside + 1]] = 1 << 16
    padded = np.concatenate((np.full(REACH, 1 << 16, np.int32), own, np.full(REACH, 1 << 16, np.int32)))
    least, reach = padded, 1
    while reach < 2 * REACH + 1:
        step = min(reach, 2 * REACH + 1 - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    found = inside[(own == least) & (own < 1 << 16)] + 1
    row = at[np.searchsorted(at, found, side="left") - 1]
    return found[found - row >= WINDOW]


CHUNKS = "doc_id bigint, row int, start int, size int, word int, high bigint, low bigint"


def chunks(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Chunks of rows with id and text: row is a hash of the text; start and size are code points, word is the number of words before; two halves of the digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, at = text_buffers(part.column(1))
            places, begins = cuts(data, at)
            if not len(places):
                continue
            first = ~_SPACE[data]
            first[1:] &= _SPACE[data[:-1]]
            begin = at[:-1][at[:-1] < len(data)]
            first[begin] = ~_SPACE[data[begin]]  # whatever the row before ends with
            words, points = (np.concatenate(([0], np.cumsum(x))) for x in (first, data & 0xC0 != 0x80))
            starts = places[begins]
            to = np.searchsorted(words[places], words[starts] + least_words)
            rows = np.searchsorted(at, starts, side="right") - 1
            able = (to < len(places)) & (starts < len(data))
            able[able] = places[to[able]] <= at[rows[able] + 1]
            starts, rows, ends = starts[able], rows[able], places[to[able]]
            raw, digest = data.tobytes(), xxhash.xxh3_128_digest
            digests = np.frombuffer(b"".join([digest(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]), dtype=">i8").astype(np.int64).reshape(-1, 2)
            whole = np.array([xxhash.xxh32_intdigest(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], dtype=np.uint32).view(np.int32)
            columns = [
                part.column(0).take(pa.array(rows)), whole[rows], (points[starts] - points[at[rows]]).astype(np.int32), (points[ends] - points[starts]).astype(np.int32),
                (words[starts] - words[at[rows]]).astype(np.int32), digests[:, 0], digests[:, 1],
            ]
            yield pa.record_batch([pa.array(c) for c in columns], names=["doc_id", "row", "start", "size", "word", "high", "low"])

    return in_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("doc_id is not null and text is not null").mapInArrow(run, CHUNKS)


def passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Repeated passages: doc_id, start, end, n_words, copy, first_doc_id, first_start; documents without any have no row.

    start and end are code points. A passage stands in first_doc_id, the smallest id that has its chunks, from first_start
    on, letter by letter; copy says that this is another document. n_words counts to the least length of the last chunk,
    which may hold a few words more. Passages with different holders may overlap. Null,
    empty and short texts have no passages; rows without id are left out; repeated rows of one id are one document.
    Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    return _parts(docs, least_words).drop("row")


_PLACE = 1 << 32


def _parts(docs: DataFrame, least_words: int) -> DataFrame:
    found = chunks(docs, least_words)
    key = ["high", "low"]
    # An id and a place as one number, so that the first of them is a plain minimum.
    place = F.col("doc_id").cast("decimal(20,0)") * F.lit(_PLACE).cast("decimal(11,0)") + F.col("start").cast("decimal(11,0)")
    # A table of its own, so that the join below stands between two exchanges, where Spark splits a hot digest.
    held = found.groupBy(*key).agg(F.min(place).alias("first"), F.max("doc_id").alias("other"))
    origin = F.pmod("first", F.lit(_PLACE).cast("decimal(11,0)"))
    held = held.select(*key, ((F.col("first") - origin) / F.lit(_PLACE).cast("decimal(11,0)")).cast("bigint").alias("holder"), origin.cast("bigint").alias("origin"), "other")
    held = written(held.filter("holder < other").drop("other"), "holders")
    # Few long numbers a chunk cross the exchange.
    pair = lambda a, b: F.shiftleft(F.col(a).cast("bigint"), 32).bitwiseOR(F.col(b).cast("bigint").bitwiseAND(F.lit(_PLACE - 1)))
    one, two = (lambda c: F.shiftright(c, 32)), (lambda c: F.col(c).bitwiseAND(F.lit(_PLACE - 1)))
    met = found.select("doc_id", *key, pair("row", "start").alias("at"), pair("word", "size").alias("more")).join(held, key)
    met = met.select("doc_id", one("at").alias("row"), two("at").alias("start"), (two("at") + two("more")).alias("end"), one("more").alias("word"), "holder", "origin")
    # All that follows is within one text.
    met = met.dropDuplicates(["doc_id", "row", "start"]).withColumn("apart", F.col("start") - F.col("origin"))
    text = Window.partitionBy("doc_id", "row").orderBy("start")
    turns = F.coalesce((F.lag("end").over(text) < F.col("start")) | (F.lag("holder").over(text) != F.col("holder")) | (F.lag("apart").over(text) != F.col("apart")), F.lit(True))
    met = met.withColumn("turns", turns).withColumn("part", F.sum(F.col("turns").cast("int")).over(text))
    parts = met.groupBy("doc_id", "row", "part", "holder").agg(F.min("start").alias("start"), F.max("end").alias("end"), (F.max("word") - F.min("word") + least_words).alias("n_words"), F.min("origin").alias("first_start"))
    return parts.select("doc_id", "row", "start", "end", "n_words", (F.col("holder") != F.col("doc_id")).alias("copy"), F.col("holder").alias("first_doc_id"), "first_start")


def deduplicated(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """docs without the copies of repeated passages; columns stay as they are, n_chars is counted anew where text went.

    Rows without id and null, empty and short texts stay as they are; repeated rows of one id all stay, each without the
    same copies; an empty table stays empty.
    """
    copies = _parts(docs, least_words).filter("copy").groupBy(F.col("doc_id").alias("__of"), F.col("row").alias("__row")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__spans"))
    hashed = in_batches(docs).mapInArrow(_with_row(docs.columns.index("text")), T.StructType([*docs.schema.fields, T.StructField("__text", T.IntegerType())]))
    joined = hashed.join(copies, (F.col("doc_id").cast("bigint") == F.col("__of")) & (F.col("__text") == F.col("__row")), "left")
    some = F.col("__spans").isNotNull()
    left = replaced(F.col("text"), F.col("__spans"), "")
    out = joined.select(*(F.when(some, left).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c) for c in docs.columns), some.alias("__some"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__some"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop("__some")


def _with_row(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = np.array([xxhash.xxh32_intdigest((x or "").encode()) for x in batch.column(at).to_pylist()], dtype=np.uint32).view(np.int32)
            yield pa.record_batch([*batch.columns, pa.array(whole)], names=[*batch.schema.names, "__text"])

    return run
