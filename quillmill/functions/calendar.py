"""Calendar partitions as native columns and generated tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZES = ("day", "week", "month", "quarter", "year")
_STEP = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAYS", "month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTHS", "year": "INTERVAL 1 YEAR"}


def _known(size: str) -> str:
    if size not in SIZES:
        raise ValueError(f"unsupported partition size: {size}")
    return size


def period_start(day: Column, size: str) -> Column:
    return day.cast("date") if _known(size) == "day" else F.trunc(day.cast("date"), size)


def period_end(day: Column, size: str) -> Column:
    start = period_start(day, size)
    if size == "day":
        return start
    if size == "week":
        return F.date_add(start, 6)
    return F.last_day(F.add_months(start, {"month": 0, "quarter": 2, "year": 11}[size]))


def period_key(day: Column, size: str) -> Column:
    """2024-03-05, 2024-W10 (ISO week and its year), 2024-03, 2024-Q1 or 2024."""
    start = period_start(day, size)
    if size == "day":
        return F.date_format(start, "yyyy-MM-dd")
    if size == "week":
        return F.concat(F.extract(F.lit("YEAROFWEEK"), start).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(start).cast("string"), 2, "0"))
    if size == "month":
        return F.date_format(start, "yyyy-MM")
    if size == "quarter":
        return F.concat(F.year(start).cast("string"), F.lit("-Q"), F.quarter(start).cast("string"))
    return F.year(start).cast("string")


def partitions(spark: SparkSession, start: date, end: date, size: str) -> DataFrame:
    """Partitions (key, partition_date, start, end, truncated, days) that tile [start, end], each clamped to it."""
    if end < start:
        raise ValueError(f"end date {end} precedes start date {start}")
    bounds = spark.range(1).select(F.lit(start).alias("a"), F.lit(end).alias("b"))
    return windows(bounds.select("a", "b", F.explode(F.sequence(period_start(F.col("a"), size), F.col("b"), F.expr(_STEP[_known(size)]))).alias("day")), size)


def windows(periods: DataFrame, size: str) -> DataFrame:
    """Partitions of rows (a, b, day): the period of each day, clamped to [a, b]."""
    first, last = period_start(F.col("day"), size), period_end(F.col("day"), size)
    low, high = F.greatest(first, F.col("a")), F.least(last, F.col("b"))
    return periods.select(
        period_key(F.col("day"), size).alias("key"), first.alias("partition_date"), low.alias("start"), high.alias("end"),
        ((low != first) | (high != last)).alias("truncated"), (F.datediff(high, low) + 1).cast("bigint").alias("days"),
    )


def month_window(key: Column) -> Column:
    """struct(start, end) of a month key, the end inclusive."""
    start = F.to_date(key, "yyyy-MM")
    return F.struct(start.alias("start"), F.last_day(start).alias("end"))

