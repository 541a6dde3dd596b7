"""The bounded, documented sample of labelled rows that a classifier is fitted on, and the split by crc32."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
_STEPS = 1 << 30


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, y) of labelled ids outside the held-out fold, `most` of them or a few more, chosen by a hash of the id.

    Labels other than 0 and 1, and ids that are null or have both, are left out; repeated equal labels count once, and of the
    rows of one id the least text does, so that rows are bounded as ids are. The ids are a broadcast whose size `most` bounds; texts stay where they are read.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col(label).cast("double").alias("y")).filter("id is not null and y in (0, 1)")
    known = known.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("also")).filter("y = also").filter(fold(F.col("id")) != 0)
    n = known.count()
    if n > most:
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(_STEPS)) < int(_STEPS * most / n))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(known.select("id", "y")), F.col("doc_id") == F.col("id")).groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")
