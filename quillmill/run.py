"""Running a job for calendar months with a completeness gate: the exit code tells whether it was complete."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from quillmill.operators.reconcile import kept, require_complete

#: Entries of a summary that a materialisation keeps.
METADATA = ["partitions_processed", "records_found", "records_scraped", "documents_stored", "documents_unchanged", "complete"]


def months(start: str, end: str) -> list[tuple[str, date, date]]:
    """Month keys from start to end (yyyy-mm), with their first and last days."""
    y, m = map(int, start.split("-"))
    out = []
    while f"{y}-{m:02}" <= end:
        ny, nm = (y + 1, 1) if m == 12 else (y, m + 1)
        out.append((f"{y}-{m:02}", date(y, m, 1), date.fromordinal(date(ny, nm, 1).toordinal() - 1)))
        y, m = ny, nm
    return out


def run(spark: SparkSession, assets: dict[str, Callable[[SparkSession, date, date], DataFrame]], start: str, end: str) -> dict[tuple[str, str], dict]:
    """Each month's assets in order; an incomplete one stops its month's later ones with an error."""
    done = {}
    for key, first, last in months(start, end):
        for name, asset in assets.items():
            done[name, key] = kept(require_complete(asset(spark, first, last)), METADATA)
    return done


def main(job: Callable[[], DataFrame]) -> int:
    """0 for a complete run, 1 for another."""
    try:
        require_complete(job())
    except RuntimeError:
        return 1
    return 0
