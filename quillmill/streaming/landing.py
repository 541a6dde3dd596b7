"""The landing append as a stream: files in, new content out, each content once across restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quillmill.operators.landing import first_of, unseen


def incoming(spark: SparkSession, folder: str, schema: T.StructType, most_files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(folder)


def land(rows: DataFrame, table: str, checkpoint: str, key: list[str], order: list[str]) -> StreamingQuery:
    """Append rows whose key the table lacks, the first of each key in a batch; stops when the input is read.

    Uniqueness is against the whole table, which watermarked state could not give. A batch that is run again after a
    failure finds its rows there and adds nothing.
    """

    def append(batch: DataFrame, _: int) -> None:
        new = first_of(batch, key, order)
        try:
            new = unseen(new, batch.sparkSession.read.schema(new.schema).parquet(table), key)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
        new.write.mode("append").parquet(table)

    return rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, size: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts of outcomes by window, late rows allowed for `late`."""
    at = F.col(time).cast("timestamp")
    return events.withColumn("__at", at).withWatermark("__at", late).groupBy(F.window("__at", size), "outcome").agg(F.count("*").alias("n"))
