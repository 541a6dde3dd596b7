"""The landing zone: append-only, one row per content, objects written once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Content identity: the same content of an identifier is stored once, whatever its URL.
CONTENT_KEY = ("source", "identifier", "file_hash")


#: Parts in which the rows of one key are looked at before they meet.
SALTS = 32


def first_of(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; Spark keeps one candidate a task before it shuffles."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("__place", place).filter("__place = 1").drop("__place")


def with_first(rows: DataFrame, key: list[str], order: list[str], name: str) -> DataFrame:
    """rows with a flag: whether it is the first of its key. All rows stay, so a key with very many is dealt by salt.

    The first of each salt are told first; only these meet in one group, the others stay in those of their salts.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    local = F.row_number().over(Window.partitionBy(*key, "__salt").orderBy(*order)) == 1
    group = F.when(F.col("__local"), -1).otherwise(F.col("__salt"))
    told = salted.withColumn("__local", local).withColumn("__group", group)
    first = F.col("__local") & (F.row_number().over(Window.partitionBy(*key, "__group").orderBy(*order)) == 1)
    return told.withColumn(name, first).drop("__salt", "__local", "__group")


def unseen(rows: DataFrame, store: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key the store does not have."""
    return rows.join(store.select(*key).distinct(), key, "left_anti")


def seen(rows: DataFrame, store: DataFrame, key: list[str]) -> DataFrame:
    return rows.join(store.select(*key).distinct(), key, "left_semi")


def outcomes(rows: DataFrame, store: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """rows with outcome: stored if it is the first of its key and the store has none, else unchanged."""
    known = store.select(*key, F.lit(True).alias("__known")).distinct()
    new = F.col("__known").isNull() & F.col("__first")
    return with_first(rows, key, order, "__first").join(known, key, "left").withColumn("outcome", F.when(new, "stored").otherwise("unchanged")).drop("__first", "__known")


def objects(rows: DataFrame, store: DataFrame, order: list[str]) -> DataFrame:
    """Objects to put: the first row of each object key with content; written tells those the store lacks."""
    usable = rows.filter(F.col("object_key").isNotNull() & F.col("content").isNotNull())
    return outcomes(usable, store, ["object_key"], order).withColumn("written", F.col("outcome") == "stored").drop("outcome")


def first_sightings(rows: DataFrame) -> DataFrame:
    """Rows (facet_id, partition_key, page, row_pos, doc_url, …) with first: whether the URL is met for the first time in its partition."""
    return with_first(rows, ["facet_id", "partition_key", "doc_url"], ["page", "row_pos"], "first")


def reuse_flags(rows: DataFrame) -> DataFrame:
    """First sightings with reused: whether an earlier row of the partition has the identifier with another URL."""
    first = first_of(rows, ["facet_id", "partition_key", "doc_url"], ["page", "row_pos"])
    told = with_first(first, ["facet_id", "partition_key", "identifier"], ["page", "row_pos"], "__first")
    return told.withColumn("reused", ~F.col("__first")).drop("__first")


def append(rows: DataFrame, path: str) -> None:
    """Append landing rows, laid out by source and partition so that readers prune."""
    rows.write.mode("append").partitionBy("source", "partition_key").parquet(path)


def layout_matches(found: list[str], expected: list[str], derived: bool) -> bool:
    """Whether a table's layout is the expected one; for the landing zone another one is an error, a derived zone is rebuilt."""
    if found == expected:
        return True
    if not derived:
        raise ValueError(f"landing layout is {found}, not {expected}; it is never mended by itself")
    return False
