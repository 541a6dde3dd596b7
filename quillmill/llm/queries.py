"""The registered queries of this subpackage and, where SQL can say the same, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmill.llm import chunks, decontaminate, licenses, packing, pii, quality, secret_scan, simhash, syncmers, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op7_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.passages(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op8_simhash": op8_simhash,
    "op9_pack": op9_pack,
    "op2_quality": op2_quality,
    "op3_toxicity": op3_toxicity,
    "op6_secrets": op6_secrets,
    "op4_licenses": op4_licenses,
    "op10_syncmers": op10_syncmers,
    "op7_chunks": op7_chunks,
    "op5_pii": op5_pii,
}

#: A-Z lower-cased, all else as it is; then the words.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS win
  FROM (SELECT item, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS win
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hits AS (SELECT dw.r, dw.i, dw.k, bw.item FROM dw JOIN bw USING (k, win)),
places AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hits)) GROUP BY r),
found AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(places.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(found.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(places.n, 0) > 0 AND 20 * coalesce(places.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN found USING (r)""",
}
