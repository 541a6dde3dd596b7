"""SimHash near-dedup with anchor-point covering.

Two 23-bit blocks of a fingerprint are each covered by the perfect binary Golay code (4096 codewords, covering
radius 3). A pair of codewords is an anchor, 2**24 in all. A fingerprint's home is the anchor that it decodes
to; fingerprints that differ from it in at most 2 bits lie within the covering radius plus these 2 bits of that
anchor. So every fingerprint is copied to each anchor whose distances exceed the radii by 2 in total at most
(61 on average) and compared there, in all its 64 bits, with those at home: no pair is missed.

Equal fingerprints are one node from the start, so copies never meet in an anchor. What an anchor finds leaves
it as a spanning forest, not as pairs. Anchors are met in sorted runs; one with very many fingerprints is
searched by thirds of the bits, of which one must be equal in any linked pair.

Texts that are similar but further apart than 2 bits are found on request: texts meet where the smallest hashes of
their distinct shingles agree throughout a band, and their shingle sets decide. Those that are connected already, and
those whose bitmaps prove that they are not similar, need no such comparison; all others that meet are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm._components import components
from quillmill.llm._store import written
from quillmill.llm._text import LOWER, U64, VISIBLE, WORD_BASE, in_batches, mix, slices, span_hashes, text_buffers, word_hashes, word_spans

SHINGLE = 3
SEED = 42
#: Differing bits of linked fingerprints.
BITS = 2
#: Fixed values of the binary Golay code: length, dimension, generator polynomial.
LENGTH, DIMENSION, GENERATOR = 23, 12, 0b110001110101
#: Rows of sorted anchors, and candidate pairs, handled at once.
RUN_ROWS, RUN_PAIRS = 1 << 19, 1 << 21
#: An anchor with more pairs than this is searched by thirds.
CROWDED = 1 << 24


# --- fingerprints


def fingerprint_array(texts: list[bytes], size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """SimHash of each text as uint64: a bit is set if it is in over half of the shingles' XXH64; zero without words."""
    digest, counts, hashes = xxhash.xxh64_intdigest, [], []
    for text in texts:
        words = text.lower().split()
        if len(words) <= size:
            counts.append(min(1, len(words)))
            if words:
                hashes.append(digest(b" ".join(words), seed))
            continue
        whole, ends, at = b" ".join(words), [], -1
        for word in words:
            at += len(word) + 1
            ends.append(at)
        starts = [0, *[x + 1 for x in ends[:-size]]]
        hashes += [digest(whole[a:b], seed) for a, b in zip(starts, ends[size - 1 :], strict=True)]
        counts.append(len(words) - size + 1)
    out, n = np.zeros(len(texts), dtype=np.uint64), np.array(counts, dtype=np.int64)
    full = np.flatnonzero(n)
    out[full] = _majority(np.array(hashes, dtype=np.uint64), n[full])
    return out


#: The eight bits of each byte, lowest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _majority(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For consecutive runs of n > 0 hashes each: the bits that over half of a run's have. Bytes are counted, not bits."""
    if not len(n):
        return np.zeros(0, dtype=np.uint64)
    base = np.repeat(np.arange(len(n)) * 256, n)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    sums = np.concatenate([np.bincount(base + octets[:, k], minlength=256 * len(n)).reshape(-1, 256) @ _BITS for k in range(8)], axis=1)
    return np.packbits(2 * sums > n[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED, words: int | None = None) -> DataFrame:
    """doc_id and fingerprint (bigint, the 64 bits) of each row; null and wordless texts have fingerprint zero.

    With words, three columns more: digest of the text, node, a hash of the set of its shingles of so many words, and the
    set's bands.
    """
    more = ", digest bigint, node bigint, bands array<bigint>" if words else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            column = part.column(1)
            texts = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()
            found = fingerprint_array([x or b"" for x in texts], size, seed)
            columns = [part.column(0), pa.array(found.view(np.int64))]
            if words:
                sets = shingle_sets(column, words)
                columns += [part.column(2), pa.array(set_hashes(sets)), pa.array(band_rows(sets), pa.list_(pa.int64()))]
            yield pa.record_batch(columns, names=["doc_id", "fp", "digest", "node", "bands"][: len(columns)])

    rows = in_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *([F.xxhash64("text").alias("digest")] if words else []))
    return rows.mapInArrow(run, f"doc_id bigint, fp bigint{more}")


# --- bands of shingles

#: Words of a shingle; bands of a text, and the smallest hashes that make up one. Two texts of similarity s share no
#: band with a chance of (1 - s ** EACH) ** BANDS, whatever the corpus: 1 in 14,000 at 0.8, 1 in 15 million at 0.87.
WORDS, BANDS, EACH = 5, 24, 5
_SALTS = mix(np.arange(1, 2 * BANDS * EACH + 1, dtype=np.uint64)).reshape(2, -1)


def shingle_sets(column: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row; a text of fewer words is one shingle, a wordless one has none."""
    raw, at = text_buffers(column)
    data = LOWER[raw]
    starts, ends, rows = word_spans(data, at, VISIBLE)
    hashes, first = word_hashes(data, starts, ends), np.searchsorted(rows, np.arange(len(at)))
    found = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        begin = np.arange(max(1, b - a - words + 1) if b > a else 0)
        found.append(np.unique(span_hashes(hashes[a:b], begin, np.minimum(begin + words, b - a), WORD_BASE)))
    return found


def set_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each set, whatever the order in which it was gathered."""
    return mix(np.array([int(mix(x).sum()) + len(x) & ((1 << 64) - 1) for x in sets], dtype=np.uint64)).view(np.int64)


def band_rows(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The BANDS hashes of each set, none for an empty one; sets share a band's with a chance of their similarity ** EACH."""
    full = [x for x in sets if len(x)]
    out = np.zeros((len(full), BANDS), dtype=np.uint64)
    if full:
        flat, starts = np.concatenate(full), np.cumsum([0, *(len(x) for x in full[:-1])])
        for k in range(BANDS * EACH):
            least = np.minimum.reduceat((flat ^ _SALTS[0, k]) * (_SALTS[1, k] | U64(1)), starts)
            out[:, k // EACH] = mix(out[:, k // EACH] * U64(WORD_BASE) + least + U64(k))
    rows = iter(out.view(np.int64))
    return [next(rows) if len(x) else np.zeros(0, np.int64) for x in sets]


# --- anchors


class Golay:
    """Syndromes, coset leaders, and the error patterns of weight 4 and 5 by syndrome."""

    def __init__(self) -> None:
        checks = LENGTH - DIMENSION
        unit = []
        for i in range(LENGTH):
            rest = 1 << i
            for k in range(LENGTH - 1, checks - 1, -1):
                if rest >> k & 1:
                    rest ^= GENERATOR << (k - checks)
            unit.append(rest)
        self.low, self.high = (self._sums(x) for x in (unit[:DIMENSION], unit[DIMENSION:]))
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        for weights in ((0, 1, 2, 3), (4,), (5,)):
            errors, syndromes = [], []
            for w in weights:
                for places in combinations(range(LENGTH), w):
                    error = syndrome = 0
                    for p in places:
                        error |= 1 << p
                        syndrome ^= unit[p]
                    errors.append(error)
                    syndromes.append(syndrome)
            order = np.argsort(syndromes, kind="stable")
            starts = np.searchsorted(np.array(syndromes)[order], np.arange((1 << checks) + 1))
            self.levels.append((np.array(errors, dtype=np.int64)[order], starts))

    @staticmethod
    def _sums(units: list[int]) -> np.ndarray:
        out = np.zeros(1, dtype=np.int64)
        for u in units:
            out = np.concatenate((out, out ^ u))
        return out

    def near(self, blocks: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Indices into blocks, and the numbers of codewords at the level's distance: level 0 the one within 3, then 4, 5."""
        errors, starts = self.levels[level]
        syndrome = self.low[blocks & ((1 << DIMENSION) - 1)] ^ self.high[blocks >> DIMENSION]
        n = starts[syndrome + 1] - starts[syndrome]
        who = np.repeat(np.arange(len(blocks)), n)
        place = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[syndrome], n)
        return who, (blocks[who] ^ errors[place]) >> (LENGTH - DIMENSION)


_GOLAY: list[Golay] = []


def golay() -> Golay:
    if not _GOLAY:
        _GOLAY.append(Golay())
    return _GOLAY[0]


def anchors(fps: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(indices into fps, anchors, whether these are the homes) for every anchor to copy a fingerprint to."""
    code, mask = golay(), (1 << LENGTH) - 1
    one, two = (fps & mask).astype(np.int64), (fps >> LENGTH & mask).astype(np.int64)
    for over in range(bits + 1):
        for level in range(over + 1):
            who, first = code.near(one, level)
            then, second = code.near(two[who], over - level)
            yield who[then], first[then] << DIMENSION | second, over == 0


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges but the roots, with the root of its tree."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        x, y = parent[u], parent[v]
        if (x == y).all():
            break
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (parent != parent[parent]).any():
            parent = parent[parent]
    rest = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[rest], nodes[parent[rest]]


def _pairs(sizes: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For items with `sizes` partners each: item and partner number, in runs of about `limit`."""
    ends, i = np.cumsum(sizes), 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + limit, side="right")))
        item = np.repeat(np.arange(i, j), sizes[i:j])
        yield item, np.arange(len(item)) - np.repeat(ends[i:j] - sizes[i:j] - (ends[i - 1] if i else 0), sizes[i:j])
        i = j


def _linked(fps: np.ndarray, group: np.ndarray, home: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of a home and another of the same group; group is sorted."""
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(group)])))
    which = np.repeat(np.arange(len(starts)), sizes)
    homes = np.flatnonzero(home)
    if not len(homes):
        return
    for item, other in _pairs(sizes[which[homes]], RUN_PAIRS):
        x = fps[homes[item]]
        y = fps[starts[which[homes[item]]] + other]
        near = (x != y) & (np.bitwise_count(x ^ y) <= bits)
        yield x[near], y[near]


def _compare(anchor: np.ndarray, fps: np.ndarray, home: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The spanning forest of the links that some sorted anchors find."""
    starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(anchor)])))
    crowded = sizes * np.add.reduceat(home, starts, dtype=np.int64) > CROWDED
    a, b = np.zeros(0, fps.dtype), np.zeros(0, fps.dtype)
    easy = ~np.repeat(crowded, sizes)
    runs = [_linked(fps[easy], anchor[easy], home[easy], bits)] if easy.any() else []
    for k in np.flatnonzero(crowded):
        own, at = fps[starts[k] : starts[k] + sizes[k]], home[starts[k] : starts[k] + sizes[k]]
        edges = np.linspace(0, 64, bits + 2).astype(int)
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            part = own >> np.uint64(low) & np.uint64((1 << int(high - low)) - 1)
            order = np.argsort(part, kind="stable")
            runs.append(_linked(own[order], part[order], at[order], bits))
    for run in runs:
        for x, y in run:
            a, b = np.concatenate((a, x)), np.concatenate((b, y))
            if len(a) > RUN_PAIRS:
                a, b = _forest(a, b)
    return _forest(a, b) if len(a) else (a, b)


def links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints of column fp, with the components of all pairs at `bits` or fewer bits.

    Exact for bits of 0, 1 or 2, the distances for which the anchors' lists are built.
    """
    if not 0 <= bits <= 2:
        raise ValueError("bits must be 0, 1 or 2")

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(own), 4096):
                for who, anchor, home in anchors(own[i : i + 4096], bits):
                    yield pa.record_batch([pa.array(anchor.astype(np.int32)), pa.array(own[i : i + 4096][who].view(np.int64)), pa.array(np.full(len(who), home))], names=["anchor", "fp", "home"])

    def compare(anchor: np.ndarray, own: np.ndarray, home: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield _compare(anchor, own.view(np.uint64), home, bits)

    copies = fps.select("fp").mapInArrow(copy, "anchor int, fp bigint, home boolean")
    return copies.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_in_runs(compare), "a bigint, b bigint")


def _in_runs(compare):
    """For mapInArrow over rows sorted by their first column: what compare(columns) yields on runs of whole groups, as pairs (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows, most = 0, RUN_ROWS

        def emit(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for a, b in compare(*columns):
                yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            rows += batch.num_rows
            if rows >= most and batch.num_rows:
                whole = [np.concatenate(x) for x in zip(*held, strict=True)]
                cut = int(np.searchsorted(whole[0], whole[0][-1]))  # the last group may go on
                if cut:
                    yield from emit([x[:cut] for x in whole])
                most = RUN_ROWS if cut else 2 * rows
                held, rows = [tuple(x[cut:] for x in whole)], len(whole[0]) - cut
        if rows:
            yield from emit([np.concatenate(x) for x in zip(*held, strict=True)])

    return run


#: Least and most bits of a shingle bitmap; rows of a band that are compared as one block; bytes of bitmaps compared at once.
LEAST_BITS, MOST_BITS, BLOCK, RUN_BYTES = 128, 1 << 15, 4096, 1 << 25


def bitmap(shingles: np.ndarray) -> bytes:
    """One bit a place, one to two places a shingle (fewer for more than MOST_BITS shingles): whether an odd number of the shingles falls on it.

    Bitmaps of two sets differ in no more bits than the sets differ in shingles, so that a difference is a proven bound.
    """
    bits = min(max(LEAST_BITS, 1 << len(shingles).bit_length()), MOST_BITS)
    odd = np.bincount((shingles & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _differing(maps: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Differing bits of pairs of bitmaps, the longer folded to the length of the shorter."""
    sizes = np.array([len(m) for m in maps])
    least, out = np.minimum(sizes[left], sizes[right]), np.zeros(len(left), dtype=np.int64)
    for size in np.unique(least).tolist():
        pairs = np.flatnonzero(least == size)
        rows, place = np.unique(np.concatenate((left[pairs], right[pairs])), return_inverse=True)
        folded = np.stack([np.bitwise_xor.reduce(np.frombuffer(maps[r], dtype=np.uint64).reshape(-1, size // 8), axis=0) for r in rows.tolist()])
        step, n = max(1, RUN_BYTES // size), len(pairs)
        for at in range(0, n, step):
            x, y = folded[place[at : min(at + step, n)]], folded[place[n + at : n + min(at + step, n)]]
            out[pairs[at : at + step]] = np.bitwise_count(x ^ y).sum(axis=1)
    return out


def _in_blocks(similarity: float, every: bool):
    """For mapInArrow over rows (band, block, copy, node, root, n, bitmap), sorted by the first three, copies after those at home.

    Pairs (a, b, bits) of a row at home with another of its block that have different roots, and bitmaps that allow the
    similarity: all of them, or each row's nearest of a run of rows. What is held is the rows at home of one block.
    """
    worst = (1 - similarity) / (1 + similarity)

    def pairs(group: np.ndarray, copy: np.ndarray, node: np.ndarray, root: np.ndarray, n: np.ndarray, maps: list[bytes], known: int) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        which = np.cumsum(np.concatenate(([False], group[1:] != group[:-1])))
        homes = np.add.reduceat(~copy, starts, dtype=np.int64)
        # A row meets those at home before it; rows before `known` have met already.
        partners = np.minimum(np.arange(len(node)) - starts[which], homes[which])
        partners[:known] = 0
        for item, other in _pairs(partners, RUN_PAIRS):
            other = starts[which[item]] + other
            able = (root[item] != root[other]) & (np.minimum(n[item], n[other]) >= similarity * np.maximum(n[item], n[other]))
            item, other = item[able], other[able]
            bits, total = _differing(maps, item, other), n[item] + n[other]
            able = bits <= worst * total + 1e-9
            item, other, part = item[able], other[able], (bits[able] << 20) // total[able]
            if every:
                a, b = node[item], node[other]
            else:
                a, b, part = (np.concatenate(x) for x in ((node[item], node[other]), (node[other], node[item]), (part, part)))
                order = np.lexsort((b, part, a))
                a, b, part = a[order], b[order], part[order]
                first = np.concatenate((np.ones(min(1, len(a)), dtype=bool), a[1:] != a[:-1]))
                a, b, part = a[first], b[first], part[first]
            if len(a):
                yield pa.record_batch([pa.array(a), pa.array(b), pa.array(part)], names=["a", "b", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = ()
        for batch in batches:
            if not batch.num_rows:
                continue
            band, block, copy, node, root, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:6])
            own = [band, block.astype(np.int64), copy, node, root, n.astype(np.int64), np.array([*batch.column(6).to_pylist(), None], dtype=object)[:-1]]
            whole = [np.concatenate(x) for x in zip(held, own, strict=True)] if held else own
            change = (whole[0][1:] != whole[0][:-1]) | (whole[1][1:] != whole[1][:-1])
            group = np.concatenate(([0], np.cumsum(change)))
            yield from pairs(group, *whole[2:6], whole[6].tolist(), len(whole[0]) - batch.num_rows)
            last = (group == group[-1]) & ~whole[2]
            held = tuple(x[last] for x in whole)

    return run


def _shingles(docs: DataFrame, words: int) -> DataFrame:
    """node, fp, n, bitmap and the distinct shingle hashes of documents (node, fp, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column(2), words)
            columns = [part.column(0), part.column(1), pa.array([len(x) for x in sets], pa.int32()), pa.array([bitmap(x) for x in sets], pa.binary()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))]
            yield pa.record_batch(columns, names=["node", "fp", "n", "bitmap", "shingles"])

    return in_batches(docs).mapInArrow(run, "node bigint, fp bigint, n int, bitmap binary, shingles array<bigint>")


def _alike(sets: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) between the fingerprints of those pairs of nodes whose shingle sets have this Jaccard similarity or more."""
    side = lambda name: sets.select(F.col("node").alias(name), F.col("fp").alias(f"{name}_fp"), F.col("shingles").alias(f"{name}_set"))
    both = F.size(F.array_intersect("a_set", "b_set"))
    good = both >= similarity * (F.size("a_set") + F.size("b_set") - both)
    return pairs.join(side("a"), "a").join(side("b"), "b").filter((both > 0) & good).select(F.col("a_fp").alias("a"), F.col("b_fp").alias("b"))


def _central(members: DataFrame) -> DataFrame:
    """Pairs (a, b): each node with the most central node of those bands that it shares, of these nodes the one that it shares most bands with.

    A node is the more central the more rows its bands have. A row a node, whatever the size of a band.
    """
    rank = members.groupBy("node").agg(F.sum("rows").alias("rank"))
    heads = members.join(rank, "node").groupBy("band").agg(F.max(F.struct("rank", "node")).alias("head"))
    met = members.join(written(heads, "heads"), "band").filter(F.col("head.node") != F.col("node")).groupBy(F.col("node").alias("a"), F.col("head").alias("head")).agg(F.count("*").alias("shared"))
    return met.groupBy("a").agg(F.max(F.struct("shared", "head")).alias("best")).select("a", F.col("best.head.node").alias("b"))


def _across(members: DataFrame, sets: DataFrame, roots: DataFrame, similarity: float, every: bool) -> DataFrame | None:
    """Pairs (a, b) of nodes that share a band, have different roots, and bitmaps that allow the similarity: all, or each node's nearest; None where no band has two roots.

    A band of many rows is dealt into blocks. Rows of its most common root are in one block each; all others are at home
    in one and copied to the rest, so that every pair with different roots meets.
    """
    known = sets.select("node", "fp", "n", "bitmap").join(roots.select(F.col("node").alias("of"), "root"), F.col("fp") == F.col("of"), "left").select("node", "n", "bitmap", F.coalesce("root", "fp").alias("root"))
    rooted = members.select("band", "node").join(known.select("node", "root"), "node")
    mixed = rooted.groupBy("band", "root").agg(F.count("*").alias("rows")).groupBy("band").agg(F.count("*").alias("roots"), F.sum("rows").alias("rows"), F.max(F.struct("rows", "root")).alias("main"))
    mixed = written(mixed.filter("roots > 1").select("band", F.col("main.root").alias("main"), F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")), "mixed")
    if mixed.isEmpty():
        return None
    dealt = members.select("band", "node").join(mixed, "band").join(known, "node").withColumn("home", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    blocks = F.when(F.col("root") == F.col("main"), F.array("home")).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.select("band", F.explode(blocks).alias("block"), "home", "node", "root", "n", "bitmap").select("band", "block", (F.col("block") != F.col("home")).alias("copy"), "node", "root", "n", "bitmap")
    met = dealt.repartition("band", "block").sortWithinPartitions("band", "block", "copy", "node").mapInArrow(_in_blocks(similarity, every), "a bigint, b bigint, bits bigint")
    if every:
        return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return met.groupBy("a").agg(F.min(F.struct("bits", "b")).alias("best")).select("a", F.col("best.b").alias("b"))


def similar(docs: DataFrame, nodes: DataFrame, known: DataFrame, similarity: float, words: int = WORDS) -> DataFrame:
    """known edges (a, b) between fingerprints, and enough of those between texts whose shingles have this Jaccard similarity to connect all that are linked.

    nodes has for each shingle set (node) a document (id, digest of its text) that stands for it, its fingerprint and
    its bands. Every edge comes from a comparison of shingle sets. First each node is compared with a central one, then with the nearest
    one of another component; last, all pairs that share a band and are not connected yet, but for those that their
    bitmaps prove to be less similar. A band with a third of all rows is no single task in any of these.
    """
    every = nodes.select("node", F.explode("bands").alias("band"))
    shared = written(every.groupBy("band").agg(F.count("*").alias("rows")).filter("rows > 1"), "shared")
    members = written(every.join(shared, "band"), "members")
    # The text of each node, told by id and digest; whole texts cross one exchange.
    asked = members.select("node").distinct().join(nodes.select("node", "fp", "id", "digest"), "node")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("digest"), "text").join(asked, ["id", "digest"])
    sets = written(_shingles(texts.groupBy("id", "digest", "node", "fp").agg(F.first("text").alias("text")).select("node", "fp", "text"), words), "shingles")
    edges = known.unionByName(written(_alike(sets, _central(members), similarity), "central"))
    for last in (False, True):
        pairs = _across(members, sets, components(edges), similarity, last)
        if pairs is None:
            break
        pairs = written(pairs, "pairs")
        if not pairs.isEmpty():
            edges = edges.unionByName(written(_alike(sets, pairs, similarity), "alike"))
    return edges


def near_duplicates(docs: DataFrame, bits: int = BITS, size: int = SHINGLE, seed: int = SEED, similarity: float | None = None, words: int = WORDS) -> DataFrame:
    """Per document row: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable).

    Fingerprints at `bits` or fewer differing bits are linked. With a similarity, so are texts whose shingles of
    `words` words are that similar (see similar); documents without id have no part in that.

    Null, empty and wordless texts share fingerprint zero and are linked like any other. Repeated rows each get a
    row. A document without id counts for links but never names a component (null if none of it has an id).
    Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    own = docs.select("doc_id", "text")
    prints = written(fingerprints(own, size, seed, words if similarity else None), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    edges = links(nodes, bits)
    if similarity:
        edges = written(edges, "known")
        # Equal shingle sets are one node, for which the document with the smallest id stands; their fingerprints are linked.
        filled = prints.filter("doc_id is not null and size(bands) > 0")
        sets = filled.groupBy("node").agg(F.min(F.struct("doc_id", "digest", "fp", "bands")).alias("w"))
        sets = written(sets.select("node", F.col("w.doc_id").alias("id"), "w.digest", "w.fp", "w.bands"), "bands")
        equal = filled.select("node", F.col("fp").alias("a")).distinct().join(sets.select("node", F.col("fp").alias("b")), "node").filter("a <> b")
        edges = similar(own, sets, edges.unionByName(equal.select("a", "b")), similarity, words)
    roots = components(edges)
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id"))
    classes = named.join(smallest, F.col("root") == F.col("of")).select(F.col("fp").alias("of"), "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(classes, F.col("fp") == F.col("of")).select("doc_id", hexed.alias("fingerprint"), "component_id")
