"""The corpus pipeline: five stages over documents, each written as Parquet and read again for the next.

Toxic documents go; of each group of near copies the document with the smallest id stays; documents contaminated
with the benchmark go and lesser passages of it are cut out; secrets are replaced by a mark; what is left is packed
into sequences. Clean documents pass every stage as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm import decontaminate, packing, secret_scan, simhash, toxicity
from quillmill.llm._store import written

#: Jaccard similarity of five-word shingles from which on texts are near copies, beside those at two bits or fewer.
SIMILARITY = 0.8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, by a model of the labels of documents outside the held-out fold."""
    return toxicity.keep(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest id. Rows without id stay; of rows with one id the least by all columns stays."""
    known = docs.filter("doc_id is not null")
    classes = simhash.near_duplicates(known, similarity=SIMILARITY)
    ids = classes.filter("doc_id = component_id").groupBy(F.col("doc_id").alias("__kept")).agg(F.count("*").alias("n"))
    ids = written(ids, "kept")
    single = known.join(ids.filter("n = 1"), F.col("doc_id") == F.col("__kept"), "left_semi")
    # Ids that several rows have: none as a rule, so that this branch reads no texts.
    several = known.join(ids.filter("n > 1"), F.col("doc_id") == F.col("__kept"), "left_semi").groupBy("doc_id").agg(F.min(F.struct(*(c for c in docs.columns if c != "doc_id"))).alias("__row"))
    several = several.select(*(F.col("doc_id") if c == "doc_id" else F.col("__row")[c].alias(c) for c in docs.columns))
    return single.unionByName(several).unionByName(docs.filter("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark contamination; lesser passages are cut out of the others."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: Hashes, models and tokens of the stages are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are a table in the shared folder for the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
