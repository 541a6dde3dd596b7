"""JSON event lines within mixed text: written, found and summarised."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lines(events: DataFrame) -> DataFrame:
    """Each row as one line of JSON, dates in ISO form, nulls left out."""
    return events.select(F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS"}).alias("line"))


def write_lines(events: DataFrame, path: str) -> None:
    lines(events).select(F.col("line").alias("value")).write.mode("append").text(path)


def find_first(log: DataFrame, event: str) -> DataFrame:
    """The first line (line_no, line) that is a JSON object with this event; no row if there is none. Other lines are passed over."""
    text = F.trim("line")
    found = log.select("line_no", text.alias("line")).filter(F.startswith(F.col("line"), F.lit("{")) & F.try_parse_json("line").isNotNull())
    return found.filter(F.get_json_object("line", "$.event") == event).orderBy("line_no").limit(1)
