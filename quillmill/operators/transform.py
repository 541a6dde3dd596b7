"""The transformed zone: one current, clean row per document, derived from the landing zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions import html, text

IDENTITY = ("source", "identifier", "doc_url")


def latest(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The newest row of each key; Spark keeps one candidate a task before it shuffles."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("__place", place).filter("__place = 1").drop("__place")


def candidates(landing: DataFrame, source: str, partition_dates: list) -> DataFrame:
    """Fetched landing rows of some partitions, the latest per identifier and URL, ties by hash."""
    fetched = landing.filter((F.col("source") == source) & F.col("partition_date").isin(partition_dates) & F.col("file_hash").isNotNull())
    return latest(fetched, ["identifier", "doc_url"], [F.desc("scraped_at"), F.asc("file_hash")])


def file_names(rows: DataFrame) -> DataFrame:
    """rows with file_name: the slug and extension, with a mark of the URL where an identifier has several URLs.

    Of an identifier's rows the least and greatest URL differ then: a plain aggregate, joined to the rows by a join that
    splits an identifier with very many. A row without identifier has no mark.
    """
    several = rows.groupBy(F.col("identifier").alias("__of")).agg(F.min("doc_url").alias("__least"), F.max("doc_url").alias("__most")).filter("__least <> __most").select("__of")
    joined = rows.join(several, F.col("identifier") == F.col("__of"), "left")
    shared = F.col("__of").isNotNull()
    stem = F.concat(F.col("identifier_slug"), F.when(shared, text.url_suffix(F.col("doc_url"))).otherwise(""))
    return joined.select(*rows.columns, F.concat(stem, F.lit("."), F.col("extension")).alias("file_name"), shared.alias("shared_identifier"))


def compared(rows: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """rows with outcome against the current table: unchanged (same hash and path), else transformed or passthrough; old_path beside it.

    The split comes before anything reads a document's bytes.
    """
    old = existing.select(*key, F.col("source_file_hash").alias("__hash"), F.col("file_path").alias("old_path"))
    same = F.col("__hash").eqNullSafe(F.col("file_hash")) & F.col("old_path").eqNullSafe(F.col("file_path")) & F.col("__hash").isNotNull()
    outcome = F.when(same, "unchanged").when(F.col("extension") == "html", "transformed").otherwise("passthrough")
    return rows.join(old, key, "left").withColumn("outcome", outcome).drop("__hash")


def with_bodies(rows: DataFrame, objects: DataFrame) -> DataFrame:
    """rows with the bytes of their objects; a lost object leaves null, so that it is a failure of its row alone."""
    return rows.join(objects.select("object_key", F.col("body").alias("bytes")), "object_key", "left")


def stale_paths(rows: DataFrame) -> DataFrame:
    """Paths of renamed documents, whose old objects go."""
    return rows.filter(F.col("old_path").isNotNull() & (F.col("old_path") != F.col("file_path"))).select("old_path", "file_path", text.key_of_path(F.col("old_path")).alias("stale_key"))


def extracted(rows: DataFrame, content: str, title: str | None) -> DataFrame:
    """HTML rows (body string, language, quality_flags) with output, title, text_chars, extracted_with and their flags joined; others pass as they are."""
    is_html = F.col("extension") == "html"
    made = html.extraction(F.when(is_html, F.col("body")), content, title, F.coalesce("language", F.lit("en")))
    rows = rows.withColumn("__made", F.when(is_html, made))
    output = F.coalesce(F.col("__made")["html"], F.encode("body", "UTF-8"))
    flags = F.array_distinct(F.concat(F.coalesce("quality_flags", F.array().cast("array<string>")), F.coalesce(F.col("__made")["quality_flags"], F.array().cast("array<string>"))))
    return rows.select(
        *(c for c in rows.columns if c not in ("body", "quality_flags", "__made")), output.alias("output"), F.col("__made")["title"].alias("title"), F.col("__made")["text_chars"].alias("text_chars"),
        F.col("__made")["extracted_with"].alias("extracted_with"), flags.alias("quality_flags"), F.sha2(output, 256).alias("output_hash"), F.octet_length(output).cast("bigint").alias("file_size"),
    )


def upserted(current: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """The current table with the changes in place of rows of their keys; changes have one row a key."""
    return current.join(changes.select(*key), key, "left_anti").unionByName(changes)


def overwrite(table: DataFrame, path: str) -> None:
    """Replace the partitions that the table has rows of; others stay."""
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "partition_key").parquet(path)


def summary(rows: DataFrame) -> DataFrame:
    """One row: candidates, outcomes, failure reasons, flags of rows that were processed, and whether it is complete."""
    outcome = F.col("outcome")
    counts = rows.agg(F.count("*").alias("candidates"), *(F.count_if(outcome == x).alias(x) for x in ("transformed", "passthrough", "unchanged", "failed")))
    reasons = rows.filter(outcome == "failed").groupBy("reason").count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "count")))).alias("failure_reasons"))
    flags = rows.filter(outcome.isin("transformed", "passthrough")).select(F.explode("quality_flags").alias("flag")).groupBy("flag").count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("flag", "count")))).alias("flags"))
    complete = (F.col("failed") == 0) & (F.col("transformed") + F.col("passthrough") + F.col("unchanged") == F.col("candidates"))
    return counts.join(F.broadcast(reasons), F.lit(True)).join(F.broadcast(flags), F.lit(True)).withColumn("complete", complete)
