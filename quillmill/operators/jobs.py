"""The two jobs: listing pages to landing zone, landing zone to transformed zone. Tables are folders of Parquet.

Each job writes what it derives before it reports, so a report describes what is there. Objects are written before
the rows that name them, and go after the rows that named them, so that a run that ends between loses nothing. Running a
job again changes nothing; a run writes the partitions alone in which something changed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill import schemas
from quillmill.functions import calendar, text
from quillmill.operators import landing, reconcile, records, transform
from quillmill.plans.spec import Spec
from quillmill.sources import pages
from quillmill.sources.retry import Patience
from quillmill.store import path_and_system


@dataclass(frozen=True)
class Zones:
    """Folders of the four tables and of runs' working tables."""

    landing: str
    landing_objects: str
    transformed: str
    transformed_objects: str
    work: str
    bucket: str = "transformed"


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table, or no rows if nothing was written to it yet."""
    where, system = path_and_system(spark, path)
    if not system.exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*(f.name for f in schema.fields))


def _held(df: DataFrame, path: str) -> DataFrame:
    """df as a working table that replaces an earlier run's."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


PARTITION = ["source", "partition_key"]
OBJECTS = T.StructType([T.StructField(n, T.BinaryType() if n == "body" else T.StringType()) for n in ("file_path", "body", "source_file_hash", "object_key", *PARTITION)])


def _replaced(table: DataFrame, touched: DataFrame, path: str, work: str) -> None:
    """Write the touched partitions of a table anew, the others stay; a partition without rows goes. The rows are written aside first, as they are read from there."""
    spark = table.sparkSession
    transform.overwrite(_held(table, work), path)
    empty = touched.join(spark.read.schema(table.schema).parquet(work).select(*PARTITION).distinct(), PARTITION, "left_anti")
    for row in empty.toLocalIterator():  # as a rule none; a partition is a period of a source
        names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        where, system = path_and_system(spark, "/".join([path, *(f"{names.escapePathName(c)}={names.escapePathName(row[c])}" for c in PARTITION)]))
        system.delete(where, True)


def ingest(spark: SparkSession, spec: Spec, listing: DataFrame, bodies: DataFrame | Callable[[str], tuple[bytes, str]], zones: Zones, size: str = "month", patience: Patience = Patience()) -> DataFrame:  # noqa: B008
    """Listing pages (schemas.PAGES) and documents into the landing zone; the report by facet and partition.

    Documents are a table (doc_url, body, header) of fetched ones, or a function url -> (body, header), which is called
    on executors for each URL listed, with patience.

    A page whose declared count cannot be read is a failure and gives no records.
    """
    declared_kind = spec.pagination == "declared_total"
    parsed = _held(pages.parsed(listing, spec.contract), f"{zones.work}/parsed")  # each page is walked once
    total = text.parse_total(F.col("count_text"), spec.contract.patterns["total"], "(?i)" + spec.contract.patterns["no_results"]) if declared_kind else F.lit(None).cast("bigint")
    told = _held(parsed.select("url", "facet_id", "partition_key", "page", total.alias("total")), f"{zones.work}/pages")
    readable = F.col("total").isNotNull() if declared_kind else F.lit(True)
    good = told.filter(readable).select("url").distinct()
    rows = pages.record_rows(parsed.join(good, "url", "left_semi"), spec.contract).withColumn("source_row", F.col("row_pos"))
    rows = _held(rows, f"{zones.work}/rows")
    usable = landing.first_sightings(rows.filter("reason is null"))
    reused = landing.reuse_flags(rows.filter("reason is null")).join(F.broadcast(spec.facet_table(spark)), "facet_id")
    month = F.to_date("partition_key", "yyyy-MM") if size == "month" else F.to_date(F.regexp_extract("partition_key", r"^\d{4}", 0), "yyyy")
    recorded = records.from_listing(reused.withColumn("partition_date", month), spec)
    if callable(bodies):
        recorded = _held(recorded, f"{zones.work}/recorded")
        bodies = _held(pages.live(recorded, bodies, patience), f"{zones.work}/bodies").drop("error")
    fetched = pages.documents(recorded, bodies)
    made = _held(records.stored(records.enriched(fetched, spec.content, spec.title), "landing"), f"{zones.work}/records")

    store = read(spark, zones.landing, schemas.LANDING)
    known = read(spark, zones.landing_objects, schemas.LANDING_OBJECT)
    done = made.filter("outcome = 'downloaded'")
    order = ["partition_key", "doc_url"]
    put = landing.objects(done, known, order).filter("written")
    put.select("object_key", F.col("content").alias("body"), "content_type", "raw_sha256", "source").write.mode("append").parquet(zones.landing_objects)
    labelled = _held(landing.outcomes(done.drop("outcome", "content"), store, list(landing.CONTENT_KEY), order), f"{zones.work}/outcomes")
    landing.append(records.persisted(labelled.filter("outcome = 'stored'")), zones.landing)

    key = ["facet_id", "partition_key"]
    event = lambda df, outcome, *where: df.filter(where[0]).select(*key, F.lit(outcome).alias("outcome")) if where else df.select(*key, F.lit(outcome).alias("outcome"))
    by_facet = lambda df: df.withColumnRenamed("issuing_authority_id", "facet_id")
    fetched_rows, stored_rows = by_facet(made), by_facet(labelled)
    events = [
        event(told, "failure", ~readable), event(rows, "skipped", "reason is not null"), event(usable, "duplicate", "not first"), event(fetched_rows, "scraped"),
        event(reused, "degraded", (F.size("flags") > 0) | F.col("reused")), event(reused, "reused", "reused"),
        event(fetched_rows, "downloaded", "outcome = 'downloaded'"), event(fetched_rows, "download_failed", "outcome <> 'downloaded'"), event(stored_rows, "stored", "outcome = 'stored'"), event(stored_rows, "unchanged", "outcome <> 'stored'"),
    ]
    outcomes = events[0]
    for more in events[1:]:
        outcomes = outcomes.unionByName(more)
    first = F.when(F.col("page") == 1, F.col("total"))
    declared = told.groupBy(*key).agg(F.max(first).alias("declared"), F.max(F.ceil(first / spec.page_size)).cast("bigint").alias("pages_expected"), F.count_if(readable).alias("pages_parsed"))
    return _held(reconcile.partitions(outcomes, declared), f"{zones.work}/report")


def derive(spark: SparkSession, spec: Spec, zones: Zones, start: date, end: date, size: str = "month") -> DataFrame:
    """Current clean rows of the partitions of a range; one row that sums up the run."""
    dates = [r[0] for r in calendar.partitions(spark, start, end, size).select("partition_date").collect()]  # a date a period
    latest = transform.file_names(transform.candidates(read(spark, zones.landing, schemas.LANDING), spec.name, dates))
    source = latest.withColumns({"source_file_path": F.col("file_path"), "source_file_hash": F.col("file_hash"), "file_path": text.file_path(zones.bucket, F.concat_ws("/", "source", "file_name"))})
    current = read(spark, zones.transformed, schemas.TRANSFORMED)
    compared = transform.compared(source, current, list(transform.IDENTITY))
    # Only changed documents meet their bytes.
    objects = read(spark, zones.landing_objects, schemas.LANDING_OBJECT)
    changed = transform.with_bodies(compared.filter("outcome <> 'unchanged'"), objects).withColumn("body", F.make_valid_utf8(F.col("bytes").cast("string")))
    missing = F.col("bytes").isNull()
    flagged = changed.withColumn("outcome", F.when(missing, "failed").otherwise(F.col("outcome"))).withColumn("reason", F.when(missing, "NoSuchKey"))
    made = transform.extracted(flagged.drop("file_size"), spec.content, spec.title)
    is_html = F.col("extension") == "html"
    output = F.when(is_html, F.col("output")).otherwise(F.col("bytes"))
    shared = F.when(F.col("shared_identifier"), F.array(F.lit("identifier_reused"))).otherwise(F.array().cast("array<string>"))
    made = made.withColumns({"output": output, "output_hash": F.sha2(output, 256), "file_size": F.octet_length(output).cast("bigint"), "quality_flags": F.array_distinct(F.concat("quality_flags", shared))}).drop("bytes")
    made = _held(made, f"{zones.work}/transformed")
    good = made.filter("outcome <> 'failed'")

    # Partitions of what changed, where it is and where it was.
    key = list(transform.IDENTITY)
    moved = current.join(good.select(*key), key, "left_semi").select(*PARTITION)
    touched = _held(good.select(*PARTITION).unionByName(moved).distinct(), f"{zones.work}/touched")
    within = lambda df: df.join(F.broadcast(touched), PARTITION, "left_semi").select(*df.columns)  # noqa: E731  a row a period
    before = within(read(spark, zones.transformed_objects, OBJECTS))
    new = good.select("file_path", F.col("output").alias("body"), "source_file_hash", "object_key", *PARTITION)
    with_new = before.join(new.select("file_path"), "file_path", "left_anti").select(*new.columns).unionByName(new)
    rows = transform.upserted(within(current), records.transformed(good).select(*(f.name for f in schemas.TRANSFORMED.fields)), key)
    outcomes = compared.filter("outcome = 'unchanged'").select("outcome", F.lit(None).cast("string").alias("reason"), "quality_flags").unionByName(made.select("outcome", "reason", "quality_flags"))
    report = _held(transform.summary(outcomes), f"{zones.work}/summary")
    if touched.isEmpty():
        return report
    _replaced(with_new, touched, zones.transformed_objects, f"{zones.work}/next_objects")
    _replaced(rows, touched, zones.transformed, f"{zones.work}/next_rows")
    # Objects that no row names any more go last.
    named = read(spark, zones.transformed, schemas.TRANSFORMED).select("file_path")
    _replaced(within(read(spark, zones.transformed_objects, OBJECTS)).join(named, "file_path", "left_semi").select(*new.columns), touched, zones.transformed_objects, f"{zones.work}/last_objects")
    return report
