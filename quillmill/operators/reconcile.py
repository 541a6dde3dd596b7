"""Reconciling what a source declared with what was listed, fetched and stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Outcomes that are counted, with the report's column for each.
COUNTED = {
    "scraped": "records_scraped", "skipped": "records_skipped", "degraded": "records_degraded", "duplicate": "records_duplicate", "reused": "identifiers_reused", "downloaded": "documents_downloaded",
    "download_failed": "downloads_failed", "stored": "documents_stored", "unchanged": "documents_unchanged", "store_failed": "stores_failed", "failure": "failures",
}
KEY = ["facet_id", "partition_key"]


def counters(outcomes: DataFrame) -> DataFrame:
    """Counts of each outcome by facet and partition, in one aggregate."""
    return outcomes.groupBy(*KEY).agg(*(F.count_if(F.col("outcome") == k).alias(v) for k, v in COUNTED.items()))


def partitions(outcomes: DataFrame, declared: DataFrame) -> DataFrame:
    """A report row for each facet and partition met in either table."""
    joined = declared.join(counters(outcomes), KEY, "full")
    counts = joined.select(*KEY, "declared", "pages_expected", F.coalesce("pages_parsed", F.lit(0)).cast("bigint").alias("pages_parsed"), *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTED.values()))
    return reported(counts)


def reported(counts: DataFrame) -> DataFrame:
    """Counts with the figures derived from them: found, its source, unaccounted, listing_complete, complete."""
    c = F.col
    listed = c("records_scraped") + c("records_skipped")
    listing = (c("failures") == 0) & (c("downloads_failed") == 0) & (c("pages_parsed") > 0) & (c("declared").isNull() | (listed == c("declared")))
    fetched = (c("documents_downloaded") == c("records_scraped")) & (c("stores_failed") == 0) & (c("documents_stored") + c("documents_unchanged") == c("documents_downloaded"))
    return counts.withColumns({
        "records_found": F.coalesce("declared", listed), "records_found_source": F.when(c("declared").isNotNull(), "declared").otherwise("observed"),
        "records_unaccounted": c("declared") - listed, "complete": listing & fetched,
    })


def run_summary(report: DataFrame, skips: DataFrame | None = None) -> DataFrame:
    """One row over all partitions; without any partition the run counts as declared and complete. Skip reasons are a map."""
    sums = ["records_found", *(c for c in COUNTED.values() if c != "failures")]
    incomplete = F.array_sort(F.collect_list(F.when(~F.col("complete"), F.struct(*KEY))))
    total = report.agg(
        F.count("*").alias("partitions_processed"), *(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in sums),
        F.coalesce(F.bool_and(F.col("records_found_source") == "declared"), F.lit(True)).alias("found_is_declared"), incomplete.alias("incomplete_partitions"),
        F.coalesce(F.bool_and("complete"), F.lit(True)).alias("complete"),
    )
    total = total.withColumn("records_unaccounted", F.col("records_found") - F.col("records_scraped") - F.col("records_skipped"))
    if skips is None:
        return total
    reasons = skips.groupBy("reason").count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "count")))).alias("skip_reasons"))
    return total.join(F.broadcast(reasons), F.lit(True))


def row_quality(identifier: Column, doc_path: Column, published: Column) -> Column:
    """struct(fatal reason or null, flags): a row without identifier or path is skipped, one without a date is degraded."""
    absent = lambda c: c.isNull() | (c == "")
    names = F.array_compact(F.array(F.when(absent(identifier), F.lit("identifier")), F.when(absent(doc_path), F.lit("doc_path"))))
    reason = F.when(F.size(names) > 0, F.concat(F.lit("missing:"), F.array_join(names, ",")))
    return F.struct(reason.alias("reason"), F.array_compact(F.array(F.when(published.isNull(), F.lit("missing:published_date")))).alias("flags"))


def require_complete(summary: DataFrame, planned: int | None = None) -> dict:
    """The summary row as a dict; an incomplete run or an empty plan is an error."""
    row = summary.first()
    if row is None or planned == 0:
        raise RuntimeError("nothing was planned" if planned == 0 else "no summary")
    if not row["complete"]:
        raise RuntimeError(f"incomplete: {row['incomplete_partitions'] if 'incomplete_partitions' in row else row}")
    return row.asDict(recursive=True)


def kept(summary: dict, names: list[str]) -> dict:
    """The named entries that a summary has."""
    return {k: summary[k] for k in names if k in summary}
