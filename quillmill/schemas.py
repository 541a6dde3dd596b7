"""Table schemas of the landing and transformed zones, and of what a run reports."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _LONG, _DATE, _TIME = T.StringType(), T.LongType(), T.DateType(), T.TimestampType()


def _struct(fields: list[tuple[str, T.DataType, bool]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, null) for name, kind, null in fields])


_LISTED = [
    ("identifier", _TEXT, False), ("source", _TEXT, False), ("jurisdiction", _TEXT, False), ("language", _TEXT, False), ("issuing_authority", _TEXT, True),
    ("issuing_authority_id", _TEXT, True), ("description", _TEXT, False), ("published_date", _DATE, True), ("doc_url", _TEXT, False), ("partition_key", _TEXT, False),
    ("partition_date", _DATE, False), ("listing_url", _TEXT, False), ("scraped_at", _TIME, False), ("source_metadata", T.MapType(_TEXT, _TEXT), False), ("quality_flags", T.ArrayType(_TEXT), False),
]
_FETCHED = [
    ("identifier_slug", _TEXT, True), ("content_type", _TEXT, True), ("extension", _TEXT, True), ("file_size", _LONG, True), ("file_hash", _TEXT, True), ("file_hash_basis", _TEXT, True),
    ("raw_sha256", _TEXT, True), ("object_key", _TEXT, True), ("fetched_at", _TIME, True), ("file_path", _TEXT, True), ("stored_at", _TIME, True),
]
#: A landing row; the bytes travel with it and are never written with it.
LANDING = _struct(_LISTED + _FETCHED)
DOCUMENT = T.StructType([*LANDING.fields, T.StructField("content", T.BinaryType(), True)])
#: Columns that the transformed zone carries over from the landing zone.
CARRIED = (
    "identifier", "source", "jurisdiction", "language", "issuing_authority", "issuing_authority_id", "description", "published_date", "doc_url", "partition_key", "partition_date",
    "source_metadata", "identifier_slug", "extension", "scraped_at",
)
TRANSFORMED = T.StructType(
    [LANDING[c] for c in CARRIED]
    + _struct([
        ("landing_id", _TEXT, False), ("source_file_hash", _TEXT, False), ("source_file_path", _TEXT, True), ("file_hash", _TEXT, False), ("file_path", _TEXT, False), ("file_size", _LONG, False),
        ("title", _TEXT, True), ("text_chars", _LONG, True), ("extracted_with", _TEXT, True), ("quality_flags", T.ArrayType(_TEXT), False), ("transformed_at", _TIME, False),
    ]).fields
)
LANDING_OBJECT = _struct([("object_key", _TEXT, False), ("body", T.BinaryType(), False), ("content_type", _TEXT, True), ("raw_sha256", _TEXT, False), ("source", _TEXT, False)])
OUTCOME = _struct([
    ("facet_id", _TEXT, False), ("partition_key", _TEXT, False), ("page", T.IntegerType(), True), ("row_pos", T.IntegerType(), True), ("doc_url", _TEXT, True), ("identifier", _TEXT, True),
    ("outcome", _TEXT, False), ("reason", _TEXT, True),
])
DECLARED = _struct([("facet_id", _TEXT, False), ("partition_key", _TEXT, False), ("declared", _LONG, True), ("pages_expected", _LONG, True), ("pages_parsed", _LONG, False)])
PAGES = _struct([("url", _TEXT, False), ("facet_id", _TEXT, False), ("partition_key", _TEXT, False), ("page", T.IntegerType(), False), ("html", _TEXT, True)])


def persisted(schema: T.StructType = DOCUMENT) -> list[str]:
    """Columns that are written: all but the bytes."""
    return [f.name for f in schema.fields if f.name != "content"]
