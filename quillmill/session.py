"""A session with the settings that the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.python.filterPushdown.enabled": "true",
}


def session(name: str = "quillmill", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
