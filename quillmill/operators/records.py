"""Records of the two zones: listing rows made landing records, enriched by their fetched documents, carried over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill import schemas
from quillmill.functions import html, text
from quillmill.plans.spec import Spec


def from_listing(rows: DataFrame, spec: Spec, scraped_at: Column | None = None) -> DataFrame:
    """Landing records of usable listing rows (with facet_id, facet_name, partition_key, partition_date, url, flags, reused)."""
    flags = F.concat("flags", F.when(F.col("reused"), F.array(F.lit("identifier_reused"))).otherwise(F.array().cast("array<string>")))
    return rows.select(
        "identifier", F.lit(spec.name).alias("source"), F.lit(spec.jurisdiction).alias("jurisdiction"), F.lit(spec.language).alias("language"), F.col("facet_name").alias("issuing_authority"),
        F.col("facet_id").alias("issuing_authority_id"), "description", "published_date", "doc_url", "partition_key", "partition_date", F.col("url").alias("listing_url"),
        (F.current_timestamp() if scraped_at is None else scraped_at).alias("scraped_at"), "source_metadata", flags.alias("quality_flags"),
    )


def enriched(records: DataFrame, content: str, title: str | None, fetched_at: Column | None = None) -> DataFrame:
    """Records (with body binary and header, of which rows without a body stay bare) with slug, type, size, hashes, key and flags."""
    page = F.make_valid_utf8(F.col("body").cast("string"))
    ext = text.extension(F.col("header"), F.col("doc_url"))
    print_ = html.fingerprint(page, ext["extension"], content, title)
    raw = text.raw_hash(F.col("body"))
    # Bytes that are no HTML, and HTML without its region, are hashed as they came.
    file_hash = F.when(print_["basis"] == "content_text", print_["file_hash"]).when(print_["basis"] == "raw_bytes", raw).otherwise(text.raw_hash(text.strip_comments(F.col("body"))))
    more = text.flags((~ext["recognised"], "unknown_content_type"), (print_["basis"] == "document_minus_comments", "content_region_missing"))
    have = F.col("body").isNotNull()
    made = records.withColumns({
        "identifier_slug": text.slug(F.col("identifier")), "content_type": F.nullif(F.col("header"), F.lit("")), "extension": ext["extension"], "file_size": F.octet_length("body").cast("bigint"), "file_hash": file_hash,
        "file_hash_basis": print_["basis"], "raw_sha256": raw, "fetched_at": F.current_timestamp() if fetched_at is None else fetched_at, "quality_flags": F.array_distinct(F.concat("quality_flags", more)), "content": F.col("body"),
    })
    made = made.withColumn("object_key", text.object_key(*(F.col(c) for c in ("source", "issuing_authority_id", "partition_key", "identifier_slug", "file_hash", "extension"))))
    new = [f.name for f in schemas.DOCUMENT.fields if f.name not in records.columns and f.name not in ("file_path", "stored_at")]
    kept = {"quality_flags": F.when(have, F.col("quality_flags")).otherwise(F.array().cast("array<string>"))}
    return made.select(*(c for c in records.columns if c not in ("body", "header", "quality_flags")), kept["quality_flags"].alias("quality_flags"), *(F.when(have, F.col(c)).alias(c) for c in new))


def stored(records: DataFrame, bucket: str, stored_at: Column | None = None) -> DataFrame:
    """Records with the path of their object and the time it was stored."""
    have = F.col("object_key").isNotNull()
    return records.withColumn("file_path", F.when(have, text.file_path(bucket, F.col("object_key")))).withColumn("stored_at", F.when(have, F.current_timestamp() if stored_at is None else stored_at))


def persisted(records: DataFrame) -> DataFrame:
    """The columns that are written, in their order."""
    return records.select(*schemas.persisted())


def widened(records: DataFrame) -> DataFrame:
    """Dates as timestamps at midnight UTC, for readers that have no dates."""
    return records.select(*(F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "date" else F.col(f.name) for f in records.schema.fields))


def landing_id(*key: Column) -> Column:
    """A surrogate key of a landing row: a hash of its content identity."""
    return F.sha2(F.concat_ws("\n", *key), 256)


def transformed(rows: DataFrame, transformed_at: Column | None = None) -> DataFrame:
    """Rows of the transformed zone, of landing rows with their extraction (output_hash, …) and new path."""
    return rows.select(
        *schemas.CARRIED, landing_id(F.col("source"), F.col("identifier"), F.col("source_file_hash")).alias("landing_id"), "source_file_hash", "source_file_path", F.col("output_hash").alias("file_hash"), "file_path", "file_size",
        "title", "text_chars", "extracted_with", "quality_flags", (F.current_timestamp() if transformed_at is None else transformed_at).alias("transformed_at"),
    )
