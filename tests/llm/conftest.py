from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
#: Names that operators use within.
CLASHING = ["fp", "anchor", "bucket", "row", "place", "id", "y", "node", "root", "words", "length", "start", "digest", "prints", "tie", "sentinel", "held_out", "score", "label", "order", "component_id"]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "é"), (5, "same text of a few words here"), (5, "same text of a few words here"), (6, "same text of a few words here"), (None, "no id at all, but some words"),
    (7, "\x00\x01\x02 control \x7f signs"), (8, "😀 emoji and ﬀ ligature é"), (9, "word " * 30_000), (10, "x" * 200_000), (11, "!!! ??? ---"), (12, None), (13, "1.2.3.4 a@b.c +123456789 4111 1111 1111 1111"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Rows that are null, empty, odd, long or repeated, with columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD, "doc_id bigint, text string")
    return rows.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("bigint").alias("n_chars"), *(F.lit(k).alias(c) for k, c in enumerate(CLASHING)))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
