"""The folder that driver and executors share, for tables that end a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset: on one machine (tests) a folder made here, on a cluster an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = held.get() if held.isDefined() else None
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir is unset: it names the folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="quillmill-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def path_and_system(spark: SparkSession, path: str) -> tuple:
    """A path and the file system that has it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: later stages read it, whichever executors are lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/quillmill-{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    where, system = path_and_system(spark, path)
    system.deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Remove the files of a written table that nothing reads any more."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        where, system = path_and_system(df.sparkSession, folder)
        system.delete(where, True)
