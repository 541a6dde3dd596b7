"""Document fingerprints from closed syncmers over words, native.

A k-mer is K consecutive words, its inner substrings are its words (S = 1), ordered by hash. It is a closed
syncmer, an anchor, if its smallest word stands first or last in it; that depends on nothing around the k-mer,
so a passage has the same anchors wherever it stands. A fingerprint is the SKETCH smallest anchor hashes: the
likeness of two is an unbiased estimate of how much of their anchor sets they share. Texts of fewer than K words
are one anchor. No Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm._native import let

K = 4
SKETCH = 64
#: The most buckets of neighbouring ids, and bytes of text that a bucket should have on average.
MOST_BUCKETS, BUCKET_BYTES = 32_768, 16 << 20
#: Parts into which an id that many rows have can be dealt.
_PARTS = 1 << 20
SPACE = "[\\x20\\t\\n\\x0B\\f\\r]+"


def word_hashes(text: Column) -> Column:
    """A hash of each lower-cased word, in order; null and blank texts have none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _anchor_at(h: Column, i: Column, k: int) -> Column:
    """The hash of the k-mer from word i (from 0) on, if it is a closed syncmer, else null."""
    own = [F.get(h, i + j) for j in range(k)]
    least = F.least(*own)
    return F.when((least == own[0]) | (least == own[-1]), F.xxhash64(*own))


def anchors(text: Column, k: int = K) -> Column:
    """Anchors as (hash, word): where each stands, for positional matching; a short text has one at word 0."""

    def of(h: Column) -> Column:
        at = lambda i: F.struct(_anchor_at(h, i, k).alias("hash"), i.alias("word"))
        long = F.filter(F.transform(F.sequence(F.lit(0), F.size(h) - k), at), lambda a: a["hash"].isNotNull())
        short = F.array(F.struct(F.xxhash64(h).alias("hash"), F.lit(0).alias("word")))
        return F.when(F.size(h) >= k, long).when(F.size(h) > 0, short).otherwise(F.array().cast("array<struct<hash:bigint,word:int>>"))

    return let(word_hashes(text), of)


def sketch(text: Column, k: int = K, size: int = SKETCH) -> Column:
    """The `size` smallest distinct anchor hashes, cut to 32 bits, in order."""
    top = lambda x: F.shiftrightunsigned(x, 32)

    def of(h: Column) -> Column:
        long = F.filter(F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: top(_anchor_at(h, i, k))), lambda a: a.isNotNull())
        return F.when(F.size(h) >= k, long).when(F.size(h) > 0, F.array(top(F.xxhash64(h)))).otherwise(F.array().cast("array<bigint>"))

    return let(let(word_hashes(text), of), lambda a: F.slice(F.sort_array(F.array_distinct(a)), 1, size))


def likeness(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Dice's coefficient of the anchor sets, 2 J / (1 + J) with J estimated from the sketches; two empty ones are alike."""
    both = let(F.slice(F.sort_array(F.array_union(a, b)), 1, size), lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(let(both, lambda j: 2 * j / (1 + j)))


def hexed(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def _bucket(doc_id: Column, tie: Column, splits: list[int], nulls: int) -> Column:
    """The bucket of an id, larger for a larger id; an id that is several of the sorted splits has as many, by the tie, as has a null id, which comes last."""
    known = sorted(set(splits))
    # The place of a tie among all, which are spread evenly: a smaller one stands first, in the larger bucket.
    part = lambda n: n - 1 - F.shiftright(F.shiftrightunsigned(tie.bitwiseXOR(F.lit(-(1 << 63))), 44) * n, 20)
    last = F.lit(-_PARTS).cast("bigint") + part(F.lit(nulls).cast("bigint"))
    if not known:
        return F.when(doc_id.isNull(), last).otherwise(0)
    ids, times = (F.split(F.lit(",".join(map(str, x))), ",").cast("array<bigint>") for x in (known, [splits.count(x) for x in known]))
    steps = [1 << b for b in reversed(range(len(known).bit_length()))]
    # How many of the splits the id reaches, by halving.
    found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when((at + step <= len(known)) & (F.get(ids, at + step - 1) <= doc_id), at + step).otherwise(at))
    own = lambda at: F.when(at == 0, 0).when(F.get(ids, at - 1) == doc_id, part(F.get(times, at - 1))).otherwise(F.get(times, at - 1))
    return F.when(doc_id.isNull(), last).otherwise(let(found, lambda at: at.cast("bigint") * _PARTS + own(at)))


def with_next(docs: DataFrame, made: dict[str, Column]) -> DataFrame:
    """docs (doc_id, text) with the columns made of them, and next_text and next_<column> of the next row by descending doc_id; after the last comes the first.

    Rows are dealt into buckets of neighbouring ids, each sorted on its own: one shuffle, no task with all rows; rows of a
    common id and those without id are dealt by a hash of the text. The first row of the next bucket stands in each
    bucket as a sentinel. Equal ids are ordered by that hash; rows without id come last.
    """
    spark = docs.sparkSession
    known = docs.withColumn("tie", F.xxhash64("text"))
    rows, nulls, size = known.agg(F.count("*"), F.count_if(F.col("doc_id").isNull()), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = min(MOST_BUCKETS, max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES)), max(1, rows))
    splits = docs.filter("doc_id is not null").approxQuantile("doc_id", [k / n for k in range(1, n)], 1 / (4 * n)) if n > 1 else []
    dealt = known.withColumn("bucket", _bucket(F.col("doc_id"), F.col("tie"), sorted(int(x) for x in splits), max(1, -(-n * nulls // max(1, rows)))))
    # A row a bucket, so that windows and broadcasts over them are bounded.
    heads = dealt.groupBy("bucket").agg(F.max("doc_id").alias("id"))
    whole = Window.partitionBy(F.lit(0)).orderBy(F.desc("bucket"))
    above = heads.select(F.col("bucket").alias("head_bucket"), F.col("id"), F.coalesce(F.lag("bucket").over(whole), F.first("bucket").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.asc("bucket")))).alias("to"))
    first = dealt.join(F.broadcast(above), (F.col("bucket") == F.col("head_bucket")) & F.col("doc_id").eqNullSafe(F.col("id")))
    first = first.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy("tie", "text"))).filter("place = 1")
    sentinels = first.select("doc_id", "text", F.col("to").alias("bucket"), "tie", F.lit(1).alias("sentinel"))
    # What is made of a row is made once, before the exchange.
    every = dealt.select("doc_id", "text", "bucket", "tie", F.lit(0).alias("sentinel")).unionByName(sentinels).select("*", *(c.alias(k) for k, c in made.items()))
    follow = Window.partitionBy("bucket").orderBy("sentinel", F.desc_nulls_last("doc_id"), F.asc("tie"), F.asc("text"))
    return every.select("doc_id", "text", *made, "sentinel", *(F.lead(c).over(follow).alias(f"next_{c}") for c in ("text", *made))).filter("sentinel = 0").drop("sentinel")


def fingerprints(docs: DataFrame, k: int = K, size: int = SKETCH) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null texts count as empty; blank texts have the empty fingerprint, alike to each other and to nothing else.
    Repeated rows each get a row; a single row is its own next. Other columns are ignored, whatever their names; an
    empty table gives no rows.
    """
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    pairs = with_next(own, {"prints": sketch(F.col("text"), k, size)})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - half).cast("int")), F.substring("next_text", F.lit(1), half))
    made = pairs.select("doc_id", n.cast("bigint").alias("n_chars"), "prints", "next_prints", edited.alias("edited")).withColumn("edited_prints", sketch(F.col("edited"), k, size))
    return made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), hexed(F.col("prints")).alias("fingerprint"), hexed(F.col("edited_prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("edited_prints"), size).alias("near_edited"), likeness(F.col("prints"), F.col("next_prints"), size).alias("near_next"),
    )
