"""Registered queries of the library, each with DuckDB SQL that returns the same rows.

The driver's tables stand in for a source's: pages for fetched documents and listing pages, documents for landing
rows with real copies, events for outcomes and versions, orders and lineitem for declared and observed counts.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill import run
from quillmill.functions import calendar as C
from quillmill.functions import html as H
from quillmill.functions import text as X
from quillmill.functions import urls as U
from quillmill.operators import checks, landing, reconcile, records, transform
from quillmill.plans import planner, spec
from quillmill.sources import logs, pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL."""

    def register(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- parts of the SQL

_WHITE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _flat(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{_WHITE}', ' ', 'g'))"


def _bare(x: str, tags: tuple[str, ...] = H.HIDDEN) -> str:
    elements = "|".join(rf"<{t}\b[^>]*>.*?</{t}\s*>" for t in tags)
    return rf"regexp_replace(regexp_replace({x}, '(?s)<!--.*?-->', '', 'g'), '(?is){elements}', '', 'g')"


def _inner(x: str, tag: str) -> str:
    pattern = rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"
    return f"CASE WHEN regexp_matches({x}, '{pattern}') THEN regexp_extract({x}, '{pattern}', 1) END"


def _decoded(x: str) -> str:
    for entity, plain in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{plain}')"
    return x


def _visible(x: str) -> str:
    return _flat(_decoded(f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"))


def _region(x: str, tag: str, tags: tuple[str, ...] = H.HIDDEN) -> str:
    """Text of a region, null without one (normalising turns null into the empty text)."""
    own = _inner(_bare(x, tags), tag)
    return f"CASE WHEN ({own}) IS NOT NULL THEN {_visible(own)} END"


def _slug(x: str) -> str:
    return rf"upper(regexp_replace(regexp_replace(regexp_replace({_flat(x)}, '[^A-Za-z0-9._-]+', '-', 'g'), '-{{2,}}', '-', 'g'), '^-+|-+$', '', 'g'))"


def _sha(x: str) -> str:
    return f"sha256({x})"


_NO_COMMENTS = "regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')"
_URL_PATH = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
_KEY = {
    "day": "strftime({d}, '%Y-%m-%d')", "week": "strftime(date_trunc('week', {d}), '%G-W%V')", "month": "strftime({d}, '%Y-%m')",
    "quarter": "CAST(year({d}) AS VARCHAR) || '-Q' || CAST(quarter({d}) AS VARCHAR)", "year": "CAST(year({d}) AS VARCHAR)",
}

# --- documents and fingerprints

#: What pages keep their content and title in; the title stands inside the content here.
CONTENT, TITLE = "article", "h1"


def _with_basis(df: DataFrame) -> DataFrame:
    """pages with an extension and a body of all three kinds: every fifth a pdf, every seventh without its region."""
    ext = F.when(F.col("page_id") % 5 == 0, "pdf").otherwise("html")
    body = F.when(F.col("page_id") % 7 == 0, F.regexp_replace("html", "(?i)<(/?)article", "<$1section")).otherwise(F.col("html"))
    return df.select("page_id", ext.alias("ext"), body.alias("html"))


@query(f"""WITH p AS (SELECT page_id, url, {_region('html', CONTENT)} AS t, {_region('html', TITLE)} AS h FROM pages)
SELECT page_id, url, CASE WHEN t <> '' THEN sha256(CASE WHEN coalesce(h, '') <> '' THEN h || chr(10) || t ELSE t END) END AS file_hash, 'content_text' AS basis,
  row_number() OVER (PARTITION BY CASE WHEN t <> '' THEN sha256(CASE WHEN coalesce(h, '') <> '' THEN h || chr(10) || t ELSE t END) END ORDER BY page_id) = 1 AS first_of_content FROM p""")
def fingerprint_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: each page's content fingerprint, and which page is the first with it."""
    made = table(spark, sf_dir, "pages").select("page_id", "url", H.fingerprint(F.col("html"), F.lit("html"), CONTENT, TITLE).alias("f")).select("page_id", "url", "f.file_hash", "f.basis")
    return landing.with_first(made, ["file_hash"], ["page_id"], "first_of_content")


@query(f"""WITH b AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'pdf' ELSE 'html' END AS ext, CASE WHEN page_id % 7 = 0 THEN regexp_replace(html, '(?i)<(/?)article', '<\\1section', 'g') ELSE html END AS html FROM pages),
r AS (SELECT *, nullif({_region('html', CONTENT)}, '') AS t FROM b),
f AS (SELECT CASE WHEN ext <> 'html' THEN 'raw_bytes' WHEN t IS NOT NULL THEN 'content_text' ELSE 'document_minus_comments' END AS basis,
  CASE WHEN ext <> 'html' THEN sha256(html) WHEN t IS NOT NULL THEN sha256(t) ELSE sha256({_NO_COMMENTS.format(x='html')}) END AS h FROM r)
SELECT basis, count(*) AS n, count(DISTINCT h) AS n_distinct, min(h) AS least FROM f GROUP BY basis""")
def fingerprint_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _with_basis(table(spark, sf_dir, "pages")).select(H.fingerprint(F.col("html"), F.col("ext"), CONTENT).alias("f"))
    return made.groupBy("f.basis").agg(F.count("*").alias("n"), F.count_distinct("f.file_hash").alias("n_distinct"), F.min("f.file_hash").alias("least"))


@query(f"SELECT page_id, {_region('html', CONTENT)} AS text FROM pages")
def region_text_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", H.region_text_dom(CONTENT)("html").alias("text"))


@query(f"SELECT page_id, {_region('html', CONTENT)} AS text FROM pages")
def region_text_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", H.region_text(F.col("html"), CONTENT).alias("text"))


_KEPT = _bare("html", H.DISCARDED)


@query(f"""WITH b AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN regexp_replace(html, '(?i)<(/?)article', '<\\1section', 'g') ELSE html END AS html FROM pages),
k AS (SELECT page_id, {_KEPT} AS kept, {_region('html', TITLE, H.DISCARDED)} AS title FROM b),
i AS (SELECT page_id, title, {_inner('kept', CONTENT)} AS own, regexp_extract(kept, '(?is)<body\\b[^>]*>(.*)$', 1) AS fallback FROM k)
SELECT page_id, title, CAST(length({_visible('coalesce(own, fallback)')}) AS BIGINT) AS text_chars, CASE WHEN own IS NULL THEN 'body' ELSE 'content' END AS extracted_with,
  concat_ws(',', CASE WHEN own IS NULL THEN 'extraction_fallback' END, CASE WHEN {_visible('coalesce(own, fallback)')} = '' THEN 'extraction_failed' END) AS quality_flags FROM i""")
def extract_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.col("page_id") % 7 == 0, F.regexp_replace("html", "(?i)<(/?)article", "<$1section")).otherwise(F.col("html"))
    made = table(spark, sf_dir, "pages").select("page_id", H.extraction(body, CONTENT, TITLE, F.lit("en")).alias("e"))
    return made.select("page_id", "e.title", "e.text_chars", "e.extracted_with", F.array_join("e.quality_flags", ",").alias("quality_flags"))


@query(f"SELECT page_id, {_region('html', TITLE)} AS title FROM pages")
def title_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", H.region_text(F.col("html"), TITLE).alias("title"))


def _escaped(x: str) -> str:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        x = f"replace({x}, '{plain}', '{entity}')"
    return x


@query("SELECT page_id, sha256(html) AS raw_sha256, CAST(strlen(html) AS BIGINT) AS file_size FROM pages")
def raw_hash_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.encode("html", "UTF-8")
    return table(spark, sf_dir, "pages").select("page_id", X.raw_hash(body).alias("raw_sha256"), F.octet_length(body).cast("bigint").alias("file_size"))


@query("SELECT doc_id, sha256(text) AS raw_sha256 FROM documents")
def raw_hash_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.raw_hash(F.encode("text", "UTF-8")).alias("raw_sha256"))


@query("SELECT page_id, sha256(regexp_replace(html, '(?s)<!--.*?-->', '', 'g')) AS bare_sha256 FROM pages")
def comment_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.raw_hash(X.strip_comments(F.encode("html", "UTF-8"))).alias("bare_sha256"))


@query("""SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'Elapsed time: 0.5' WHEN 1 THEN 'cached at 12:00' END AS marker FROM pages""")
def timing_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.when(F.col("page_id") % 3 == 0, "<!-- Elapsed time: 0.5 -->").when(F.col("page_id") % 3 == 1, "<!-- cached at 12:00 -->").otherwise("<!-- other -->")
    return table(spark, sf_dir, "pages").select("page_id", H.marker(F.concat("html", note)).alias("marker"))


# --- landing


@query("SELECT sha256(text) AS file_hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def content_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document of each content. Both figures are aggregates, so copies of a text meet as partial sums."""
    hashed = table(spark, sf_dir, "documents").select("doc_id", X.raw_hash(F.encode("text", "UTF-8")).alias("file_hash"))
    return hashed.groupBy("file_hash").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("SELECT sha256(text) AS file_hash, count(*) AS copies, min(doc_id) AS first_doc, max(doc_id) AS last_doc, count(DISTINCT source) AS sources FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = table(spark, sf_dir, "documents").select("doc_id", "source", X.raw_hash(F.encode("text", "UTF-8")).alias("file_hash"))
    found = hashed.groupBy("file_hash").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.count_distinct("source").alias("sources"))
    return found.filter("copies > 1")


@query("SELECT user_id, event_type, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return transform.latest(rows, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """documents as landing rows in an earlier batch (every third) and the one at hand."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("lang").alias("identifier"), X.raw_hash(F.encode("text", "UTF-8")).alias("file_hash"))
    return rows.filter("doc_id % 3 = 0"), rows.filter("doc_id % 3 <> 0")


_BATCHES = "WITH a AS (SELECT doc_id, source, lang AS identifier, sha256(text) AS file_hash FROM documents), old AS (SELECT * FROM a WHERE doc_id % 3 = 0), new AS (SELECT * FROM a WHERE doc_id % 3 <> 0)"


@query(f"""{_BATCHES}, k AS (SELECT doc_id, source || '/' || file_hash || '.txt' AS object_key, row_number() OVER (PARTITION BY source, file_hash ORDER BY doc_id) AS k FROM new)
SELECT doc_id, object_key, k = 1 AND object_key NOT IN (SELECT source || '/' || file_hash || '.txt' FROM old) AS written FROM k""")
def landing_put_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat("source", F.lit("/"), "file_hash", F.lit(".txt"))
    old, new = (b.select("doc_id", key.alias("object_key"), F.lit("").alias("content")) for b in _batches(spark, sf_dir))
    return landing.objects(new, old, ["doc_id"]).select("doc_id", "object_key", "written")


@query(f"""{_BATCHES}, k AS (SELECT *, row_number() OVER (PARTITION BY source, identifier, file_hash ORDER BY doc_id) AS k FROM new)
SELECT doc_id, CASE WHEN k = 1 AND NOT EXISTS (SELECT 1 FROM old WHERE old.source = k.source AND old.identifier = k.identifier AND old.file_hash = k.file_hash) THEN 'stored' ELSE 'unchanged' END AS outcome FROM k""")
def landing_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _batches(spark, sf_dir)
    return landing.outcomes(new, old, list(landing.CONTENT_KEY), ["doc_id"]).select("doc_id", "outcome")


@query(f"{_BATCHES} SELECT doc_id, file_hash FROM new WHERE file_hash NOT IN (SELECT file_hash FROM old)")
def landing_new_rows_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _batches(spark, sf_dir)
    return landing.unseen(new, old, ["file_hash"]).select("doc_id", "file_hash")


@query(f"{_BATCHES} SELECT doc_id, file_hash FROM new WHERE file_hash IN (SELECT file_hash FROM old)")
def landing_seen_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _batches(spark, sf_dir)
    return landing.seen(new, old, ["file_hash"]).select("doc_id", "file_hash")


def _sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as listing rows: the day is the partition, a row's place its page, the user its identifier, user and type its URL."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("facet_id"), F.date_format("ts", "yyyy-MM").alias("partition_key"), F.floor(F.col("event_id") / 10).alias("page"), F.pmod("event_id", F.lit(10)).alias("row_pos"),
        F.concat_ws("/", F.col("user_id").cast("string"), F.pmod("event_id", F.lit(3)).cast("string")).alias("doc_url"), F.col("user_id").cast("string").alias("identifier"), "event_id",
    )


_SIGHTINGS = "WITH s AS (SELECT event_type AS facet_id, strftime(ts, '%Y-%m') AS partition_key, event_id // 10 AS page, event_id % 10 AS row_pos, CAST(user_id AS VARCHAR) || '/' || CAST(event_id % 3 AS VARCHAR) AS doc_url, CAST(user_id AS VARCHAR) AS identifier, event_id FROM events)"


@query(f"{_SIGHTINGS} SELECT event_id, row_number() OVER (PARTITION BY facet_id, partition_key, doc_url ORDER BY page, row_pos) = 1 AS first FROM s")
def first_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.first_sightings(_sightings(spark, sf_dir)).select("event_id", "first")


@query(f"""{_SIGHTINGS}, f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY facet_id, partition_key, doc_url ORDER BY page, row_pos) AS k FROM s) WHERE k = 1)
SELECT event_id, row_number() OVER (PARTITION BY facet_id, partition_key, identifier ORDER BY page, row_pos) > 1 AS reused FROM f""")
def identifier_reuse_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.reuse_flags(_sightings(spark, sf_dir)).select("event_id", "reused")


@query(f"""{_SIGHTINGS} SELECT facet_id, partition_key, count(DISTINCT doc_url) AS documents, count(DISTINCT doc_url) - count(DISTINCT identifier) AS identifiers_reused FROM s GROUP BY 1, 2""")
def distinct_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a partition, and the URLs by which its identifiers are reused: every one beyond an identifier's first."""
    by_url = _sightings(spark, sf_dir).groupBy("facet_id", "partition_key", "identifier", "doc_url").count()
    by_name = by_url.groupBy("facet_id", "partition_key", "identifier").agg(F.count("*").alias("urls"))
    return by_name.groupBy("facet_id", "partition_key").agg(F.sum("urls").alias("documents"), F.sum(F.col("urls") - 1).alias("identifiers_reused"))


@query(f"""{_SIGHTINGS}, f AS (SELECT *, row_number() OVER (PARTITION BY facet_id, partition_key, doc_url ORDER BY page, row_pos) = 1 AS first FROM s)
SELECT facet_id, partition_key, page, CAST(count(*) FILTER (WHERE first) AS BIGINT) AS new_records, row_number() OVER (PARTITION BY facet_id, partition_key ORDER BY page) > 1 AND count(*) FILTER (WHERE first) = 0 AS no_progress FROM f GROUP BY 1, 2, 3""")
def page_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = landing.first_sightings(_sightings(spark, sf_dir)).groupBy("facet_id", "partition_key", "page").agg(F.count_if("first").alias("new_records"))
    later = F.row_number().over(Window.partitionBy("facet_id", "partition_key").orderBy("page")) > 1
    return counted.withColumn("no_progress", later & (F.col("new_records") == 0))


@query(f"""{_BATCHES} SELECT new.doc_id, old.doc_id AS earlier_doc, CAST(strlen(d.text) AS BIGINT) AS body_bytes FROM new JOIN (SELECT file_hash, min(doc_id) AS doc_id FROM old GROUP BY 1) old USING (file_hash) JOIN documents d ON d.doc_id = old.doc_id""")
def object_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the bytes of the object that an earlier batch stored under their key."""
    old, new = (b.withColumnRenamed("file_hash", "object_key") for b in _batches(spark, sf_dir))
    first = old.groupBy("object_key").agg(F.min("doc_id").alias("earlier_doc"))
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("earlier_doc"), F.encode("text", "UTF-8").alias("body"))
    found = transform.with_bodies(new, first.join(texts, "earlier_doc")).filter("bytes is not null").join(first, "object_key")
    return found.select("doc_id", "earlier_doc", F.octet_length("bytes").cast("bigint").alias("body_bytes"))


@query("""WITH v AS (SELECT user_id, event_type AS url, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, url, n FROM v WHERE n > 1""")
def visited_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that a walk met more than once: what a loop guard would have stopped at."""
    return table(spark, sf_dir, "events").groupBy("user_id", F.col("event_type").alias("url")).agg(F.count("*").alias("n")).filter("n > 1")


# --- transform


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """pages as landing rows, every tenth with a second version; and the current rows of the first versions."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    changed = F.when(F.col("page_id") % 10 == 0, F.concat("html", F.lit("<p>more</p>"))).otherwise(F.col("html"))
    name = lambda: F.concat(F.lit("s3://transformed/"), F.col("page_id").cast("string"))
    moved = F.when(F.col("page_id") % 15 == 0, F.concat(name(), F.lit("~0"))).otherwise(name())
    ext = F.when(F.col("page_id") % 5 == 0, "pdf").otherwise("html")
    new = p.select("page_id", X.raw_hash(F.encode(changed, "UTF-8")).alias("file_hash"), moved.alias("file_path"), ext.alias("extension"))
    old = p.filter("page_id % 4 <> 1").select("page_id", X.raw_hash(F.encode("html", "UTF-8")).alias("source_file_hash"), name().alias("file_path"))
    return new, old


_VERSIONS = """WITH new AS (SELECT page_id, sha256(CASE WHEN page_id % 10 = 0 THEN html || '<p>more</p>' ELSE html END) AS file_hash, 's3://transformed/' || CAST(page_id AS VARCHAR) || CASE WHEN page_id % 15 = 0 THEN '~0' ELSE '' END AS file_path,
  CASE WHEN page_id % 5 = 0 THEN 'pdf' ELSE 'html' END AS extension FROM pages), old AS (SELECT page_id, sha256(html) AS source_file_hash, 's3://transformed/' || CAST(page_id AS VARCHAR) AS old_path FROM pages WHERE page_id % 4 <> 1)"""


@query(f"""{_VERSIONS} SELECT page_id, CASE WHEN source_file_hash = file_hash AND old_path = file_path THEN 'unchanged' WHEN extension = 'html' THEN 'transformed' ELSE 'passthrough' END AS outcome FROM new LEFT JOIN old USING (page_id)""")
def transform_skip_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.compared(*_versions(spark, sf_dir), ["page_id"]).select("page_id", "outcome")


@query(f"""{_VERSIONS} SELECT old_path, file_path, regexp_extract(old_path, '^[^/]*//[^/]*/(.*)$', 1) AS stale_key FROM new JOIN old USING (page_id) WHERE old_path <> file_path""")
def stale_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.stale_paths(transform.compared(*_versions(spark, sf_dir), ["page_id"]))


@query(f"""{_VERSIONS}, o AS (SELECT CASE WHEN source_file_hash = file_hash AND old_path = file_path THEN 'unchanged' WHEN page_id % 50 = 3 THEN 'failed' WHEN extension = 'html' THEN 'transformed' ELSE 'passthrough' END AS outcome FROM new LEFT JOIN old USING (page_id))
SELECT count(*) AS candidates, count(*) FILTER (WHERE outcome = 'transformed') AS transformed, count(*) FILTER (WHERE outcome = 'passthrough') AS passthrough, count(*) FILTER (WHERE outcome = 'unchanged') AS unchanged,
  count(*) FILTER (WHERE outcome = 'failed') AS failed, count(*) FILTER (WHERE outcome = 'failed') = 0 AS complete FROM o""")
def transform_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transform.compared(*_versions(spark, sf_dir), ["page_id"])
    failed = (F.col("outcome") != "unchanged") & (F.col("page_id") % 50 == 3)
    rows = rows.withColumn("outcome", F.when(failed, "failed").otherwise(F.col("outcome"))).withColumn("reason", F.when(failed, "OSError")).withColumn("quality_flags", F.array(F.lit("x")))
    return transform.summary(rows).select("candidates", "transformed", "passthrough", "unchanged", "failed", "complete")


@query("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, event_id % 2 ORDER BY ts DESC, event_id DESC) AS k FROM events), old AS (SELECT * FROM l WHERE k = 1 AND event_id % 2 = 0), new AS (SELECT * FROM l WHERE k = 1 AND event_id % 2 = 1)
SELECT coalesce(new.user_id, old.user_id) AS user_id, coalesce(new.event_type, old.event_type) AS event_type, coalesce(new.event_id, old.event_id) AS event_id, CASE WHEN new.user_id IS NOT NULL THEN new.value ELSE old.value END AS value
FROM new FULL JOIN old ON new.user_id = old.user_id AND new.event_type = old.event_type""")
def upsert_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, key = table(spark, sf_dir, "events"), ["user_id", "event_type"]
    order = [F.desc("ts"), F.desc("event_id")]
    old, new = (transform.latest(rows.filter(F.col("event_id") % 2 == k), key, order).select(*key, "event_id", "value") for k in (0, 1))
    return transform.upserted(old, new, key)


@query(f"""WITH p AS (SELECT page_id, url, {_flat('regexp_extract(url, ' + repr('^https?://([^/]*)') + ', 1)')} AS identifier FROM pages),
n AS (SELECT *, {_slug('identifier')} AS s, min(url) OVER (PARTITION BY identifier) <> max(url) OVER (PARTITION BY identifier) AS shared FROM p)
SELECT page_id, s || CASE WHEN shared THEN '~' || substr(sha256(url), 1, 8) ELSE '' END || '.html' AS file_name, shared AS shared_identifier FROM n""")
def file_names_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = X.normalise(F.regexp_extract("url", "^https?://([^/]*)", 1))
    rows = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("doc_url"), host.alias("identifier"), X.slug(host).alias("identifier_slug"), F.lit("html").alias("extension"))
    return transform.file_names(rows).select("page_id", "file_name", "shared_identifier")


# --- scalars


@query(f"SELECT p_partkey, {_slug('p_name')} AS slug FROM part")
def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", X.slug(F.col("p_name")).alias("slug"))


@query(f"SELECT page_id, {_slug('url')} AS slug FROM pages")
def slugify_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.slug(F.col("url")).alias("slug"))


@query(f"SELECT doc_id, sha256({_flat('text')}) AS flat_sha256, CAST(length({_flat('text')}) AS BIGINT) AS chars FROM documents")
def normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = X.normalise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(flat, 256).alias("flat_sha256"), F.length(flat).cast("bigint").alias("chars"))


_HEADER = {0: "text/html; charset=utf-8", 1: " Application/PDF ", 2: "application/msword", 3: ";", 4: "image/png", 5: "text/plain;x=1"}


def _header() -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in _HEADER.items() for x in pair)), F.pmod("page_id", F.lit(7)).cast("int"))


_SQL_HEADER = "CASE page_id % 7 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _HEADER.items()) + " END"
_SQL_MEDIA = f"nullif(lower({_flat('split_part(header, ' + repr(';') + ', 1)')}), '')"


@query(f"SELECT page_id, {_SQL_MEDIA} AS media_type FROM (SELECT page_id, {_SQL_HEADER} AS header FROM pages)")
def media_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.media_type(_header()).alias("media_type"))


_SQL_EXT = "CASE m " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.EXTENSIONS.items()) + " END"
_SUFFIXED = "url || CASE page_id % 3 WHEN 0 THEN '.PDF' WHEN 1 THEN '.xyz' ELSE '' END"


@query(f"""WITH h AS (SELECT page_id, header, regexp_replace(url, '[?#].*$', '') || CASE page_id % 3 WHEN 0 THEN '.PDF' WHEN 1 THEN '.xyz' ELSE '' END AS url FROM (SELECT page_id, url, {_SQL_HEADER} AS header FROM pages)),
e AS (SELECT page_id, {_SQL_MEDIA} AS m, lower(regexp_extract({_URL_PATH}, '\\.([^.]*)$', 1)) AS suffix FROM h),
f AS (SELECT page_id, coalesce({_SQL_EXT}, CASE WHEN suffix IN ('doc', 'docx', 'html', 'pdf', 'rtf', 'txt') THEN suffix END) AS x FROM e)
SELECT page_id, coalesce(x, 'bin') AS extension, x IS NOT NULL AS recognised FROM f""")
def extension_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = F.when(F.col("page_id") % 3 == 0, ".PDF").when(F.col("page_id") % 3 == 1, ".xyz").otherwise("")
    url = F.concat(F.regexp_replace("url", "[?#].*$", ""), tail)
    return table(spark, sf_dir, "pages").select("page_id", X.extension(_header(), url).alias("e")).select("page_id", "e.*")


@query("""WITH e AS (SELECT regexp_extract(url, '^https?://([^/]*)', 1) AS host, CASE WHEN contains(url, '.') THEN lower(regexp_extract(url, '\\.([^.]*)$', 1)) ELSE '(none)' END AS ext FROM pages)
SELECT host, ext, count(*) AS n, CAST(grouping(host) AS BIGINT) * 2 + CAST(grouping(ext) AS BIGINT) AS level FROM e GROUP BY GROUPING SETS ((host, ext), (ext))""")
def url_extension_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^https?://([^/]*)", 1).alias("host"), F.col("url").alias("doc_path"))
    return checks.document_formats(rows, ["host"]).withColumn("level", F.col("level").cast("bigint"))


_LINKS = ["/a/b.html", "c/d", "//cdn.example.org/x", "https://other.example/z?q=1", "?page=3", "#top", "../up/./e"]


@query("""WITH p AS (SELECT page_id, regexp_extract(url, '^([a-z]+:)//', 1) AS scheme, regexp_extract(url, '^[a-z]+:(//[^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[a-z]+://[^/?#]*[^?#]*(\\?[^#]*)?', 1) AS q FROM pages),
r AS (SELECT *, regexp_replace(CASE WHEN path = '' THEN '/' ELSE path END, '[^/]*$', '') AS folder FROM p)
SELECT page_id, CASE page_id % 7 WHEN 0 THEN scheme || host || '/a/b.html' WHEN 1 THEN scheme || host || folder || 'c/d' WHEN 2 THEN scheme || '//cdn.example.org/x' WHEN 3 THEN 'https://other.example/z?q=1' WHEN 4 THEN scheme || host || path || '?page=3'
  WHEN 5 THEN scheme || host || path || q || '#top' ELSE scheme || host || regexp_replace(CASE WHEN folder = '/' THEN '/x/' ELSE folder END, '[^/]*/$', '') || 'up/e' END AS doc_url FROM r""")
def url_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = F.element_at(F.array(*map(F.lit, _LINKS)), (F.pmod("page_id", F.lit(7)) + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", U.resolve(F.col("url"), link).alias("doc_url"))


@query("""WITH p AS (SELECT page_id, replace('/en/a b–' || CAST(page_id AS VARCHAR), ' ', '%20') AS one, CASE WHEN page_id % 4 = 0 THEN '/en/a b–' || CAST(page_id AS VARCHAR) WHEN page_id % 4 = 1 THEN '/en/other+' || CAST(page_id AS VARCHAR) WHEN page_id % 4 = 2 THEN '' END AS two FROM pages)
SELECT page_id, one AS doc_path, coalesce(two, '') <> '' AND url_decode(one) <> url_decode(two) AS path_conflict FROM p""")
def url_decode_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.concat(F.lit("/en/a b–"), F.col("page_id").cast("string"))
    k = F.col("page_id") % 4
    one, two = F.replace(plain, F.lit(" "), F.lit("%20")), F.when(k == 0, plain).when(k == 1, F.concat(F.lit("/en/other+"), F.col("page_id").cast("string"))).when(k == 2, F.lit(""))
    return table(spark, sf_dir, "pages").select("page_id", X.first_present(one, two).alias("doc_path"), X.conflicting(one, two).alias("path_conflict"))


_SQL_KEY = "'web/' || source || '/2024-01/' || upper(lang) || '/' || sha256(text) || '.txt'"


@query(f"SELECT doc_id, {_SQL_KEY} AS object_key FROM documents")
def object_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", _object_key().alias("object_key"))


def _object_key() -> Column:
    return X.object_key(F.lit("web"), F.col("source"), F.lit("2024-01"), X.slug(F.col("lang")), X.raw_hash(F.encode("text", "UTF-8")), F.lit("txt"))


@query(f"SELECT doc_id, 's3://landing/' || {_SQL_KEY} AS file_path, {_SQL_KEY} AS key_again FROM documents")
def file_path_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = X.file_path("landing", _object_key())
    return table(spark, sf_dir, "documents").select("doc_id", path.alias("file_path"), X.key_of_path(path).alias("key_again"))


@query("SELECT page_id, '~' || substr(sha256(url), 1, 8) AS suffix FROM pages")
def url_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.url_suffix(F.col("url")).alias("suffix"))


@query(f"SELECT page_id, {_escaped('html')} AS escaped FROM pages")
def html_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.escape(F.col("html")).alias("escaped"))


_BANNER = {0: "Shows 1 to 10 of {n} results", 1: "Shows  1\n to 10   of\n{n} \tresults", 2: "There are NO search  Results fitting your keywords", 3: "of many results", 4: ""}


@query("""WITH b AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN CAST(o_orderkey AS BIGINT) WHEN 1 THEN CAST(o_orderkey AS BIGINT) WHEN 2 THEN 0 END AS declared FROM orders) SELECT o_orderkey, declared FROM b""")
def declared_total_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    text = F.element_at(F.create_map(*(F.lit(x) for pair in _BANNER.items() for x in pair)), F.pmod(key, F.lit(6)).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.parse_total(F.replace(text, F.lit("{n}"), key.cast("string"))).alias("declared"))


@query("""WITH t AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, ' %-d/%-m/%Y ') WHEN 2 THEN '31/02/2024' WHEN 3 THEN '1/2/24' ELSE '' END AS s FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 2 THEN CAST(try_strptime(trim(s), '%d/%m/%Y') AS DATE) END AS published_date FROM t""")
def published_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, day = F.col("o_orderkey") % 5, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(day, "dd/MM/yyyy")).when(k == 1, F.concat(F.lit(" "), F.date_format(day, "d/M/yyyy"), F.lit(" "))).when(k == 2, "31/02/2024").when(k == 3, "1/2/24").otherwise("")
    return table(spark, sf_dir, "orders").select("o_orderkey", X.parse_date(text).alias("published_date"))


@query("""SELECT event_id, CASE WHEN event_id % 11 = 0 AND event_id % 7 = 0 THEN 'missing:identifier,doc_path' WHEN event_id % 11 = 0 THEN 'missing:identifier' WHEN event_id % 7 = 0 THEN 'missing:doc_path' END AS reason,
  CASE WHEN event_id % 5 = 0 THEN 'missing:published_date' ELSE '' END AS flags FROM events""")
def row_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    name, path = F.when(k % 11 != 0, k.cast("string")), F.when(k % 7 == 0, "").otherwise("/x")
    rows = table(spark, sf_dir, "events").select("event_id", reconcile.row_quality(name, path, F.when(k % 5 != 0, F.to_date("ts"))).alias("q"))
    return rows.select("event_id", "q.reason", F.array_join("q.flags", ",").alias("flags"))


@query("""SELECT event_id, array_to_string(list_filter([CASE WHEN event_id % 2 = 0 THEN 'b' END, CASE WHEN event_id % 3 = 0 THEN 'a' END, CASE WHEN event_id % 2 <> 0 AND event_id % 6 = 3 THEN 'b' END], lambda x: x IS NOT NULL), ',') AS flags FROM events""")
def ordered_distinct_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", F.array_join(X.flags((k % 2 == 0, "b"), (k % 3 == 0, "a"), (k % 6 == 3, "b"), (k % 3 == 0, "a")), ",").alias("flags"))


@query("""WITH p AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '/v/' || CAST(page_id AS VARCHAR) END AS view_page, CASE WHEN page_id % 4 <> 0 THEN '/v/' || CAST(page_id AS VARCHAR) ELSE '' END AS identifier, '/f/' || CAST(page_id % 5 AS VARCHAR) AS doc_path FROM pages),
r AS (SELECT *, coalesce(nullif(view_page, ''), nullif(identifier, ''), doc_path) AS path FROM p)
SELECT count(*) AS n, count(*) FILTER (WHERE view_page IS NOT DISTINCT FROM path) AS view_page, count(*) FILTER (WHERE identifier IS NOT DISTINCT FROM path) AS identifier, count(*) FILTER (WHERE doc_path IS NOT DISTINCT FROM path) AS doc_path, count(*) FILTER (WHERE len(list_distinct(list_filter([view_page, identifier, doc_path], lambda x: coalesce(x, '') <> ''))) > 1) AS conflicts FROM r""")
def path_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, own = F.col("page_id"), F.concat(F.lit("/v/"), F.col("page_id").cast("string"))
    sources = {"view_page": F.when(k % 3 == 0, own), "identifier": F.when(k % 4 != 0, own).otherwise(""), "doc_path": F.concat(F.lit("/f/"), (k % 5).cast("string"))}
    rows = table(spark, sf_dir, "pages").select(*(c.alias(n) for n, c in sources.items()))
    columns = [F.col(n) for n in sources]
    rows = rows.withColumn("path", X.first_present(*columns)).withColumn("conflict", X.conflicting(*columns))
    return rows.agg(F.count("*").alias("n"), *(F.count_if(F.col(n).eqNullSafe(F.col("path"))).alias(n) for n in sources), F.count_if("conflict").alias("conflicts"))


# --- calendar


def _partition_keys(size: str) -> Query:
    def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        rows = table(spark, sf_dir, "orders").select(C.period_key(day, size).alias("key"), C.period_start(day, size).alias("partition_date"), C.period_end(day, size).alias("end_date"))
        return rows.groupBy("key", "partition_date", "end_date").agg(F.count("*").alias("n"))

    return keys


for _size in C.SIZES:
    _end = f"CAST(date_trunc('{_size}', o_orderdate) + INTERVAL 1 {_size.upper()} - INTERVAL 1 DAY AS DATE)"
    query(f"SELECT {_KEY[_size].format(d='o_orderdate')} AS key, CAST(date_trunc('{_size}', o_orderdate) AS DATE) AS partition_date, {_end} AS end_date, count(*) AS n FROM orders GROUP BY 1, 2, 3", name=f"partition_keys_{_size}")(_partition_keys(_size))

#: The range of the window queries: neither end is a month's.
FIRST, LAST = date(1996, 1, 15), date(1998, 3, 10)


def _sql_windows(size: str) -> str:
    return f"""periods AS (SELECT CAST(unnest(generate_series(date_trunc('{size}', DATE '{FIRST}'), DATE '{LAST}', INTERVAL 1 {size.upper()})) AS DATE) AS p),
w AS (SELECT {_KEY[size].format(d='p')} AS key, p AS partition_date, greatest(p, DATE '{FIRST}') AS "start", least(CAST(p + INTERVAL 1 {size.upper()} - INTERVAL 1 DAY AS DATE), DATE '{LAST}') AS "end", CAST(p + INTERVAL 1 {size.upper()} - INTERVAL 1 DAY AS DATE) AS full_end FROM periods)"""


@query(f"""WITH {_sql_windows('month')} SELECT key, partition_date, "start", "end", "start" <> partition_date OR "end" <> full_end AS truncated, CAST("end" - "start" + 1 AS BIGINT) AS days FROM w""")
def partition_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.partitions(spark, FIRST, LAST, "month")


@query(f"""WITH {_sql_windows('week')} SELECT count(*) AS partitions, CAST(sum("end" - "start" + 1) AS BIGINT) AS days, count(*) FILTER (WHERE gap <> 1) AS gaps FROM (SELECT *, lead("start") OVER (ORDER BY "start") - "end" AS gap FROM w)""")
def partition_tiling_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = F.datediff(F.lead("start").over(Window.orderBy("start")), F.col("end"))
    return C.partitions(spark, FIRST, LAST, "week").withColumn("gap", gap).agg(F.count("*").alias("partitions"), F.sum("days").alias("days"), F.count_if(F.col("gap") != 1).alias("gaps"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS key, o_orderpriority AS facet, count(*) AS n FROM orders GROUP BY ROLLUP (1, 2)")
def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(C.period_key(F.col("o_orderdate"), "month").alias("key"), F.col("o_orderpriority").alias("facet"))
    return rows.rollup("key", "facet").agg(F.count("*").alias("n"))


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS key, CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS "start", last_day(min(o_orderdate)) AS "end" FROM orders GROUP BY 1""")
def month_window_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("key")).distinct()
    return keys.select("key", C.month_window(F.col("key")).alias("w")).select("key", "w.*")


# --- planning

SOURCE = spec.Spec(
    "web", "Web", "IE", "en", "https://example.org", "/en/search/", 10, "%-d/%-m/%Y", "from", "to", "pageNumber", {"decisions": "1", "q": "a b"}, "body", "issuing_authority",
    (spec.FacetValue("1", "one"),), "declared_total", spec.Contract({"record": "nav li", "identifier": "a", "published_date": "span.date", "description": "span.text"}, {}, "%d/%m/%Y", {"identifier": ("href",)}), "article", "h1",
)


def _facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation as the facet dimension; every second begins in the course of the range."""
    begins = F.when(F.col("n_nationkey") % 2 == 0, F.expr("make_date(1996, 1 + n_nationkey % 12, 20)"))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("facet_id"), F.col("n_name").alias("facet_name"), begins.alias("active_from"))


_SQL_FACETS = "f AS (SELECT CAST(n_nationkey AS VARCHAR) AS facet_id, n_name AS facet_name, CASE WHEN n_nationkey % 2 = 0 THEN make_date(1996, CAST(1 + n_nationkey % 12 AS INTEGER), 20) END AS active_from FROM nation)"


@query(f"""WITH {_sql_windows('month')}, {_SQL_FACETS} SELECT facet_id, key, active_from IS NULL OR "end" >= active_from AS covered FROM w, f""")
def facet_partition_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner.facet_partitions(C.partitions(spark, FIRST, LAST, "month"), _facets(spark, sf_dir)).select("facet_id", "key", "covered")


@query(f"""WITH {_sql_windows('month')}, {_SQL_FACETS}, c AS (SELECT active_from IS NULL OR "end" >= active_from AS covered FROM w, f) SELECT count(*) FILTER (WHERE covered) AS planned, count(*) FILTER (WHERE NOT covered) AS skipped_inactive, count(*) FILTER (WHERE covered) = 0 AS empty FROM c""")
def plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner.plan_summary(planner.facet_partitions(C.partitions(spark, FIRST, LAST, "month"), _facets(spark, sf_dir)))


@query("""WITH d AS (SELECT strftime(o_orderdate, '%Y-%m') AS key, count(*) AS declared FROM orders GROUP BY 1) SELECT key, CAST(unnest(generate_series(1, CAST(greatest(ceil(declared / 10), 1) AS BIGINT))) AS BIGINT) AS page FROM d""")
def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = table(spark, sf_dir, "orders").groupBy(C.period_key(F.col("o_orderdate"), "month").alias("key")).agg(F.count("*").alias("declared"))
    return planner.page_plan(declared, 10).select("key", "page")


@query(f"""WITH {_sql_windows('month')} SELECT key, 'https://example.org/en/search/?decisions=1&q=a%20b&body=15376&from=' || strftime("start", '%-d/%-m/%Y') || '&to=' || strftime("end", '%-d/%-m/%Y') || '&pageNumber=2' AS url FROM w""")
def listing_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.partitions(spark, FIRST, LAST, "month").select("key", planner.listing_url(SOURCE, F.lit("15376"), F.col("start"), F.col("end"), F.lit(2)).alias("url"))


def _decisions(spark: SparkSession) -> DataFrame:
    rows = spark.range(2 * 3 * 3 * 3 * 3 * 2).select("id")
    k, out = F.col("id"), {}
    for name, n in (("s", 2), ("p", 3), ("e", 3), ("d", 3), ("l", 3), ("r", 2)):
        out[name], k = F.pmod(k, F.lit(n)), F.floor(k / n)
    return rows.select("id", *(c.alias(n) for n, c in out.items())).select(
        "id", F.when(F.col("s") == 0, "declared_total").otherwise("follow_next").alias("strategy"), (F.col("p") + 1).alias("page"), F.when(F.col("e") > 0, F.col("e")).alias("pages_expected"),
        F.col("d").alias("recovery_depth"), F.lit(2).alias("max_recovery"), F.when(F.col("l") == 1, "?p=9").when(F.col("l") == 2, "?p=1").alias("link"), F.lit("https://x.org/s?p=2").alias("base_url"),
        F.array(F.lit("https://x.org/s?p=1")).alias("urls_fetched"), F.col("r").alias("new_records"),
    )


@query("""WITH i AS (SELECT range AS id FROM range(324)),
t AS (SELECT id, id % 2 = 0 AS known, id // 2 % 3 + 1 AS page, nullif(id // 6 % 3, 0) AS expected, id // 18 % 3 AS depth, id // 54 % 3 AS l, id // 162 % 2 AS new FROM i),
w AS (SELECT *, l > 0 AND (NOT known OR coalesce(page >= expected, FALSE) OR depth > 0) AS wanted FROM t),
c AS (SELECT *, known AND wanted AND depth >= 2 AS capped FROM w),
g AS (SELECT *, wanted AND NOT capped AS follows, wanted AND NOT capped AND l = 2 AS loop, wanted AND NOT capped AND l = 1 AND page > 1 AND new = 0 AS stuck FROM c)
SELECT id, CASE WHEN follows AND NOT loop AND NOT stuck THEN 'https://x.org/s?p=9' END AS next_url, CAST(CASE WHEN known AND follows THEN depth + 1 WHEN capped THEN depth ELSE 0 END AS INTEGER) AS depth,
  concat_ws(',', CASE WHEN capped THEN 'pagination_recovery_capped' END, CASE WHEN known AND follows AND depth = 0 THEN 'pagination_underrun' END, CASE WHEN loop THEN 'pagination_loop' END, CASE WHEN stuck THEN 'pagination_no_progress' END) AS anomalies FROM g""")
def continuation_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner.continuations(_decisions(spark)).select("id", "next_url", "depth", F.array_join("anomalies", ",").alias("anomalies"))


@query("""WITH RECURSIVE l AS (SELECT doc_id AS page, CASE WHEN doc_id % 128 < 120 THEN doc_id + 1 WHEN doc_id % 128 = 120 THEN doc_id - 60 END AS next FROM documents),
m AS (SELECT doc_id AS start, doc_id AS page, CAST(1 AS BIGINT) AS position, [doc_id] AS seen FROM documents
  UNION ALL SELECT m.start, l.next, m.position + 1, list_append(m.seen, l.next) FROM m JOIN l ON m.page = l.page WHERE l.next IS NOT NULL AND NOT list_contains(m.seen, l.next))
SELECT CAST(start AS VARCHAR) AS start, CAST(page AS VARCHAR) AS page, position FROM m""")
def pager_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of links over documents, from each of them: up to 121 pages, of which the last links back to one in the middle."""
    docs, k = table(spark, sf_dir, "documents"), F.col("doc_id") % 128
    links = docs.select(F.col("doc_id").alias("page"), F.when(k < 120, F.col("doc_id") + 1).when(k == 120, F.col("doc_id") - 60).alias("next"))
    return planner.walk(links, docs.select(F.col("doc_id").alias("page")))


# --- reconciliation


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as outcomes of orders: each is listed, fetched and stored, but for some."""
    k = F.col("l_orderkey") + F.col("l_linenumber")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("facet_id"), C.period_key(F.col("o_orderdate"), "year").alias("partition_key"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", k.alias("k"))
    listed = F.when(F.col("k") % 97 == 0, F.array(F.lit("skipped"))).otherwise(F.concat(
        F.array(F.lit("scraped")), F.when(F.col("k") % 89 == 0, F.array(F.lit("download_failed"))).otherwise(F.array(F.lit("downloaded"), F.when(F.col("k") % 3 == 0, "unchanged").otherwise("stored"))),
    ))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("facet_id", "partition_key", F.explode(listed).alias("outcome"))


def _declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("facet_id"), C.period_key(F.col("o_orderdate"), "year").alias("partition_key"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    n = F.count("*")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("facet_id", "partition_key").agg(
        F.when(F.col("partition_key") != "1998", n).alias("declared"), F.ceil(n / 10).cast("bigint").alias("pages_expected"), F.ceil(n / 10).cast("bigint").alias("pages_parsed")
    )


_SQL_REPORT = """WITH o AS (SELECT o_orderpriority AS facet_id, CAST(year(o_orderdate) AS VARCHAR) AS partition_key, l_orderkey + l_linenumber AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
c AS (SELECT facet_id, partition_key, CASE WHEN partition_key <> '1998' THEN count(*) END AS declared, count(*) FILTER (WHERE k % 97 <> 0) AS records_scraped, count(*) FILTER (WHERE k % 97 = 0) AS records_skipped,
  count(*) FILTER (WHERE k % 97 <> 0 AND k % 89 <> 0) AS documents_downloaded, count(*) FILTER (WHERE k % 97 <> 0 AND k % 89 = 0) AS downloads_failed,
  count(*) FILTER (WHERE k % 97 <> 0 AND k % 89 <> 0 AND k % 3 <> 0) AS documents_stored, count(*) FILTER (WHERE k % 97 <> 0 AND k % 89 <> 0 AND k % 3 = 0) AS documents_unchanged FROM o GROUP BY 1, 2),
r AS (SELECT *, coalesce(declared, records_scraped + records_skipped) AS records_found, CASE WHEN declared IS NOT NULL THEN 'declared' ELSE 'observed' END AS records_found_source, declared - records_scraped - records_skipped AS records_unaccounted, downloads_failed = 0 AS complete FROM c)"""


@query(f"{_SQL_REPORT} SELECT facet_id, partition_key, records_found, records_found_source, records_scraped, records_skipped, records_unaccounted, documents_downloaded, downloads_failed, documents_stored, documents_unchanged, complete FROM r")
def reconcile_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reconcile.partitions(_outcomes(spark, sf_dir), _declared(spark, sf_dir))
    return report.select("facet_id", "partition_key", "records_found", "records_found_source", "records_scraped", "records_skipped", "records_unaccounted", "documents_downloaded", "downloads_failed", "documents_stored", "documents_unchanged", "complete")


@query(f"""{_SQL_REPORT} SELECT count(*) AS partitions_processed, CAST(sum(records_found) AS BIGINT) AS records_found, CAST(sum(records_scraped) AS BIGINT) AS records_scraped, CAST(sum(records_skipped) AS BIGINT) AS records_skipped, CAST(sum(documents_stored) AS BIGINT) AS documents_stored,
  CAST(sum(records_found) - sum(records_scraped) - sum(records_skipped) AS BIGINT) AS records_unaccounted, bool_and(records_found_source = 'declared') AS found_is_declared, count(*) FILTER (WHERE NOT complete) AS incomplete, bool_and(complete) AS complete FROM r""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = reconcile.run_summary(reconcile.partitions(_outcomes(spark, sf_dir), _declared(spark, sf_dir)))
    return total.select("partitions_processed", "records_found", "records_scraped", "records_skipped", "documents_stored", "records_unaccounted", "found_is_declared", F.size("incomplete_partitions").cast("bigint").alias("incomplete"), "complete")


@query("SELECT event_type AS outcome, count(*) AS n FROM events GROUP BY 1")
def outcome_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("outcome")).agg(F.count("*").alias("n"))


@query("WITH f AS (SELECT unnest([CASE WHEN event_id % 2 = 0 THEN 'missing:published_date' END, CASE WHEN event_id % 3 = 0 THEN 'identifier_reused' END]) AS flag FROM events WHERE event_type <> 'view') SELECT flag, count(*) AS n FROM f WHERE flag IS NOT NULL GROUP BY 1")
def flag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    rows = table(spark, sf_dir, "events").filter("event_type <> 'view'").select(F.explode(X.flags((k % 2 == 0, "missing:published_date"), (k % 3 == 0, "identifier_reused"))).alias("flag"))
    return rows.groupBy("flag").agg(F.count("*").alias("n"))


@query("""SELECT 'missing:' || concat_ws(',', CASE WHEN event_id % 13 = 0 THEN 'identifier' END, CASE WHEN event_id % 7 = 0 THEN 'doc_path' END) AS reason, count(*) AS n FROM events WHERE event_id % 13 = 0 OR event_id % 7 = 0 GROUP BY 1""")
def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why rows of all events are skipped, every 13th of which has no identifier and every 7th no path."""
    k = F.col("event_id")
    judged = table(spark, sf_dir, "events").select(reconcile.row_quality(F.when(k % 13 != 0, "x"), F.when(k % 7 != 0, "y"), F.to_date("ts"))["reason"].alias("reason"))
    return judged.groupBy("reason").agg(F.count("*").alias("n")).filter("reason is not null")


# --- checks


def _yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by year and priority; a year and priority without any has null, as an unreadable count would."""
    rows = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("facet")).agg(F.count("*").alias("n"))
    return rows.select("year", "facet", F.when(F.col("year") != 1997, F.col("n")).alias("records"))


_SQL_YEARLY = "WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS facet, CASE WHEN year(o_orderdate) <> 1997 THEN count(*) END AS records FROM orders GROUP BY year(o_orderdate), o_orderpriority)"


@query(f"{_SQL_YEARLY} SELECT year, facet, CAST(sum(coalesce(records, 0)) AS BIGINT) AS records, count(*) FILTER (WHERE records IS NULL) AS unread, CAST(grouping(year) AS BIGINT) * 2 + CAST(grouping(facet) AS BIGINT) AS level FROM y GROUP BY CUBE (year, facet)")
def coverage_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.coverage(_yearly(spark, sf_dir)).withColumn("level", F.col("level").cast("bigint"))


@query(f"""{_SQL_YEARLY}, z AS (SELECT year, facet, coalesce(records, 0) AS records FROM y), k AS (SELECT *, row_number() OVER (PARTITION BY facet ORDER BY records DESC, year) AS k FROM z)
SELECT facet, min(year) FILTER (WHERE records > 0) AS first_year, max(year) FILTER (WHERE records > 0) AS last_year, CAST(sum(records) AS BIGINT) AS records, max(year) FILTER (WHERE k = 1) AS peak_year, max(records) AS peak_records FROM k GROUP BY facet""")
def coverage_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.bounds(_yearly(spark, sf_dir).select("year", "facet", F.coalesce("records", F.lit(0).cast("bigint")).alias("records")))


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("facet"), F.trunc("o_orderdate", "month").alias("month")).agg(F.count("*").alias("records"))


@query("""WITH m AS (SELECT o_orderpriority AS facet, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS records FROM orders GROUP BY 1, 2)
SELECT facet, month, records, CAST(ceil(records / 10) AS BIGINT) AS pages FROM (SELECT *, row_number() OVER (PARTITION BY facet ORDER BY records DESC, month) AS k FROM m) WHERE k = 1""")
def peak_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = transform.latest(_monthly(spark, sf_dir), ["facet"], [F.desc("records"), F.asc("month")])
    return found.withColumn("pages", planner.pages_expected(F.col("records"), 10))


@query("""WITH m AS (SELECT o_orderpriority AS facet, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS records FROM orders GROUP BY 1, 2),
q AS (SELECT facet, max(n) AS peak_quarter FROM (SELECT facet, date_trunc('quarter', month), sum(records) AS n FROM m GROUP BY 1, 2) GROUP BY 1),
t AS (SELECT facet, max(n) AS peak_three_months FROM (SELECT facet, sum(records) OVER (PARTITION BY facet ORDER BY year(month) * 12 + month(month) RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS n FROM m) GROUP BY 1)
SELECT facet, CAST(peak_quarter AS BIGINT) AS peak_quarter, CAST(peak_three_months AS BIGINT) AS peak_three_months FROM q JOIN t USING (facet)""")
def peak_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.peak_quarters(_monthly(spark, sf_dir))


@query("SELECT 'disjointness' AS \"check\", TRUE AS ok, CAST(count(*) AS VARCHAR) || '/' || CAST(count(*) AS VARCHAR) AS detail FROM customer")
def facet_disjointness(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return checks.disjointness(c.groupBy("c_mktsegment").agg(F.count("*").alias("records")), c.agg(F.count("*").alias("records")))


@query("SELECT DISTINCT user_id FROM events WHERE event_type = 'click' INTERSECT SELECT user_id FROM events WHERE event_type = 'error'")
def page_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.filter("event_type = 'click'").select("user_id").intersect(e.filter("event_type = 'error'").select("user_id"))


@query("SELECT user_id FROM events WHERE event_type = 'click' EXCEPT SELECT user_id FROM events WHERE event_type = 'error' AND event_id % 50 < 2")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.filter("event_type = 'click'").select("user_id").subtract(e.filter("event_type = 'error' and event_id % 50 < 2").select("user_id"))


@query("SELECT user_id FROM events WHERE event_type = 'click' UNION SELECT user_id FROM events WHERE event_type = 'error'")
def set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.filter("event_type in ('click', 'error')").select("user_id").distinct()


def _fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages fetched twice; the second time the server's comment differs, and every 50th page's first paragraph."""
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    again = F.regexp_replace("html", "<!-- ad ", "<!-- elapsed ")
    again = F.when(F.col("page_id") % 50 == 1, F.regexp_replace(again, "(?i)</article>", " more</article>")).otherwise(again)
    out = p.select("page_id", F.col("html").alias("a"), again.alias("b"))
    hashes = lambda x: {"raw": X.raw_hash(F.encode(x, "UTF-8")), "bare": X.raw_hash(X.strip_comments(F.encode(x, "UTF-8"))), "region": F.sha2(F.coalesce(H.region_text(F.col(x), CONTENT), F.lit("")), 256)}
    return out.select("page_id", *(c.alias(f"{x}_{n}") for x in ("a", "b") for n, c in hashes(x).items()))


@query(f"""WITH f AS (SELECT page_id, html AS a, CASE WHEN page_id % 50 = 1 THEN regexp_replace(replace(html, '<!-- ad ', '<!-- elapsed '), '(?i)</article>', ' more</article>', 'g') ELSE replace(html, '<!-- ad ', '<!-- elapsed ') END AS b FROM pages)
SELECT count(*) AS n, count(*) FILTER (WHERE a = b) AS raw_stable, count(*) FILTER (WHERE {_NO_COMMENTS.format(x='a')} = {_NO_COMMENTS.format(x='b')}) AS bare_stable, count(*) FILTER (WHERE {_region('a', CONTENT)} = {_region('b', CONTENT)}) AS region_stable FROM f""")
def fingerprint_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.stability(_fetches(spark, sf_dir))


@query("SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type = 'error' AND event_id % 5 <> 4 ORDER BY event_id LIMIT 1")
def log_find_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first error among events written as JSON lines, with text and broken JSON between them."""
    e = table(spark, sf_dir, "events")
    good = F.to_json(F.struct(F.col("event_type").alias("event"), F.get_json_object("props", "$.k").cast("bigint").alias("k"), "event_id"))
    line = F.when(F.col("event_id") % 5 == 4, F.concat(F.lit("INFO "), good)).otherwise(F.concat(F.lit("  "), good))
    broken = e.select((F.col("event_id") - 0.5).alias("line_no"), F.lit('{"event": "error", ').alias("line"))
    log = e.filter("event_type <> 'error' or event_id % 5 <> 4").select(F.col("event_id").cast("double").alias("line_no"), line.alias("line")).unionByName(broken.withColumn("line_no", F.col("line_no").cast("double")))
    found = logs.find_first(log, "error")
    get = lambda p: F.get_json_object("line", p)
    return found.select(get("$.event_id").cast("bigint").alias("event_id"), get("$.event").alias("event_type"), get("$.k").cast("bigint").alias("k"))


@query("SELECT event_id, '{\"event\":\"' || event_type || '\",\"event_id\":' || CAST(event_id AS VARCHAR) || ',\"day\":\"' || strftime(ts, '%Y-%m-%d') || '\"}' AS line FROM events")
def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("event"), "event_id", F.to_date("ts").alias("day"))
    return logs.lines(e).select(F.get_json_object("line", "$.event_id").cast("bigint").alias("event_id"), "line")


@query("""WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages) SELECT page_id, starts_with(path, '/en/1') OR starts_with(path, '/De/') AS disallowed FROM p""")
def robots_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([("User-agent: *",), ("Disallow: /en/1",), ("DISALLOW: /De/",), ("Allow: /en/2",)], "line string")
    found = table(spark, sf_dir, "pages").select("page_id", X.url_path(F.col("url")).alias("path"))
    verdicts = checks.robots(rules, found.select("path").distinct(), "/")
    return found.join(verdicts, "path").select("page_id", "disallowed")


@query("""WITH r AS (SELECT regexp_extract_all(html, '(?is)<li><a href="([^"]*)">[^<]*</a></li>', 0) AS items, page_id FROM pages),
x AS (SELECT page_id, unnest(items) AS item, unnest(range(len(items))) AS row_pos FROM r)
SELECT page_id, CAST(row_pos AS INTEGER) AS row_pos, regexp_extract(item, '(?is)href="([^"]*)"', 1) AS href, """ + _flat("regexp_extract(item, '(?is)>([^<]*)</a>', 1)") + " AS identifier FROM x")
def listing_rows_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.nav_records(table(spark, sf_dir, "pages"), F.col("page_id"))


@query("""WITH r AS (SELECT regexp_extract_all(html, '(?is)<li><a href="([^"]*)">[^<]*</a></li>', 0) AS items, page_id FROM pages),
x AS (SELECT page_id, unnest(items) AS item, unnest(range(len(items))) AS row_pos FROM r)
SELECT page_id, CAST(row_pos AS INTEGER) AS row_pos, regexp_extract(item, '(?is)href="([^"]*)"', 1) AS doc_path, """ + _flat("regexp_extract(item, '(?is)>([^<]*)</a>', 1)") + " AS identifier, 'missing:published_date' AS flags FROM x")
def listing_rows_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records through the contract's selectors and the DOM."""
    found = pages.listing_rows(table(spark, sf_dir, "pages").select("page_id", "url", "html"), SOURCE.contract)
    return found.select("page_id", "row_pos", "doc_path", "identifier", F.array_join("flags", ",").alias("flags"))


@query("""SELECT 'empty_states' AS "check", TRUE AS ok, '3' AS detail UNION ALL SELECT 'page_size', TRUE, '10' UNION ALL
SELECT 'fingerprint_stability', FALSE, '0' UNION ALL SELECT 'document_formats', FALSE, CAST(count(*) AS VARCHAR) FROM pages WHERE page_id % 10 = 0""")
def check_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    banners = spark.createDataFrame([("no search results", 0), ("of 12 results", 12), ("of many results", None)], "text string, expected bigint")
    sizes = spark.createDataFrame([("none", 10), ("pageSize", 10)], "attempt string, records bigint")
    paths = table(spark, sf_dir, "pages").select(F.when(F.col("page_id") % 10 == 0, "/a.pdf").otherwise("/a.html").alias("doc_path"))
    return checks.collect(
        checks.empty_states(banners.select(X.parse_total(F.col("text")).alias("total"), "expected")), checks.page_size(sizes, 10), checks.stability_verdict(_fetches(spark, sf_dir)), checks.formats_verdict(paths)
    )


@query("SELECT o_orderkey, o_orderpriority AS facet, strftime(o_orderdate, '%Y-%m') AS key FROM orders WHERE strftime(o_orderdate, '%Y-%m') IN ('1996-02', '1996-03')")
def partition_filtered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of some months, as a range that reaches the Parquet scan."""
    day = F.col("o_orderdate")
    rows = table(spark, sf_dir, "orders").filter((day >= F.lit("1996-02-01").cast("timestamp_ntz")) & (day < F.lit("1996-04-01").cast("timestamp_ntz")))
    return rows.select("o_orderkey", F.col("o_orderpriority").alias("facet"), C.period_key(day, "month").alias("key"))


# --- regions by selectors: pages put together from known parts, so that the SQL needs none of the library's patterns


def _sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each of pages: nested elements in a content region told by its class, in some too deep or without a title or region."""
    n = F.col("page_id").cast("string")
    nested = F.concat(F.repeat(F.lit("<div>"), (F.col("page_id") % 60).cast("int")), F.lit("inner "), n, F.repeat(F.lit("</div>"), (F.col("page_id") % 60).cast("int")))
    content = F.concat(F.lit("<p>The <b>decision</b></p><!-- "), n, F.lit(" --><script>x("), n, F.lit(")</script><div class='content'>"), nested, F.lit("</div> tail &amp; &eacute; <p>of  "), F.col("url"), F.lit("</p>"))
    region = F.when(F.col("page_id") % 9 == 4, "section").otherwise("content")
    title = F.when(F.col("page_id") % 5 == 3, "").otherwise(F.concat(F.lit("<h1 class='big page-title'>No. "), n, F.lit(" &lt;x&gt;</h1>")))
    html = F.concat(F.lit("<html><body><nav class='x'>menu</nav><h1>other</h1>"), title, F.lit("<div class='wide "), region, F.lit("'>"), content, F.lit("</div><footer>end</footer></body></html>"))
    return table(spark, sf_dir, "pages").select("page_id", "url", html.alias("html"))


_SHEETS = """WITH p AS (SELECT page_id, CASE WHEN page_id % 5 <> 3 THEN 'No. ' || page_id || ' <x>' END AS title, 'The decision inner ' || page_id || ' tail & é of ' || url AS text, 'inner ' || page_id AS inner_text, page_id % 9 <> 4 AS found FROM pages)"""


@query(f"""{_SHEETS} SELECT page_id, CASE WHEN found THEN text ELSE inner_text END AS text FROM p""")
def region_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first region of a class, nested ones whole; where the outer one has another class, the inner one is the first."""
    return _sheets(spark, sf_dir).select("page_id", H.region_text_dom("div.content")("html").alias("text"))


@query(f"""{_SHEETS} SELECT page_id, sha256(CASE WHEN title IS NOT NULL THEN title || chr(10) ELSE '' END || CASE WHEN found THEN text ELSE inner_text END) AS file_hash, 'content_text' AS basis FROM p""")
def fingerprint_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _sheets(spark, sf_dir).select("page_id", H.fingerprint(F.col("html"), F.lit("html"), "div.content", "h1.page-title").alias("f"))
    return made.select("page_id", "f.file_hash", "f.basis")


@query(f"""{_SHEETS}, o AS (SELECT page_id, title, found, CASE WHEN found THEN text ELSE 'menu other ' || coalesce(title || ' ', '') || text || ' end' END AS kept FROM p)
SELECT page_id, title, CAST(length(kept) AS BIGINT) AS text_chars, CASE WHEN found THEN 'content' ELSE 'body' END AS extracted_with, CASE WHEN found THEN '' ELSE 'extraction_fallback' END AS quality_flags FROM o""")
def extract_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and content by class; a page without the region keeps its body and is told."""
    made = _sheets(spark, sf_dir).select("page_id", H.extraction(F.col("html"), "div.wide.content", "h1.page-title", F.lit("en")).alias("e"))
    return made.select("page_id", "e.title", "e.text_chars", "e.extracted_with", F.array_join("e.quality_flags", ",").alias("quality_flags"))


@query(f"""{_SHEETS}, i AS (SELECT page_id, title, '<p>The <b>decision</b></p><div class="content">' || repeat('<div>', page_id % 60) || inner_text || repeat('</div>', page_id % 60) || '</div> tail &amp; é <p>of  ' || replace(url, '&', '&amp;') || '</p>' AS inside FROM p JOIN pages USING (page_id)),
d AS (SELECT page_id, '<!doctype html>' || chr(10) || '<html lang="en">' || chr(10) || '<head>' || chr(10) || '<meta charset="utf-8">' || chr(10) || '<title>' || {_escaped("coalesce(title, '')")} || '</title>' || chr(10) || '</head>' || chr(10) || '<body>' || chr(10)
  || CASE WHEN title IS NOT NULL THEN '<h1>' || {_escaped('title')} || '</h1>' || chr(10) ELSE '' END || '<div class="content">' || chr(10) || inside || chr(10) || '</div>' || chr(10) || '</body>' || chr(10) || '</html>' || chr(10) AS doc FROM i)
SELECT page_id, sha256(doc) AS file_hash, CAST(strlen(doc) AS BIGINT) AS file_size FROM d""")
def assembled_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and content as a document of their own, without comments and scripts."""
    made = _sheets(spark, sf_dir).select("page_id", H.extraction(F.col("html"), "div.wide", "h1.page-title", F.lit("en"))["html"].alias("body"))
    return made.select("page_id", X.raw_hash(F.col("body")).alias("file_hash"), F.octet_length("body").cast("bigint").alias("file_size"))


# --- a second source, and what a specification says

ISO = spec.Spec(
    "iso", "Iso", "XX", "en", "https://iso.example", "/decisions", 3, "%Y-%m-%d", "after", "before", "p", {}, "court", "issuing_authority",
    (spec.FacetValue("hc", "High Court"), spec.FacetValue("sc", "Supreme Court", date(1997, 6, 1))), "follow_next",
    spec.Contract({"record": "article.d", "identifier": "h3 a", "published_date": "time", "description": "p.summary", "court_no": "span.no", "next_page": "nav a[rel=next]"}, {}, "%Y-%m-%d", {"identifier": ("href",)}), "main", "h1",
)


@query(f"""WITH {_sql_windows('quarter')} SELECT key, 'https://iso.example/decisions?court=hc&after=' || strftime("start", '%Y-%m-%d') || '&before=' || strftime("end", '%Y-%m-%d') || '&p=1' AS url FROM w""")
def listing_params_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.partitions(spark, FIRST, LAST, "quarter").select("key", planner.listing_url(ISO, F.lit("hc"), F.col("start"), F.col("end"), F.lit(1)).alias("url"))


@query("""WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 2 THEN '2024-02-31' END AS s FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN CAST(s AS DATE) END AS published_date FROM t""")
def published_date_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, day = F.col("o_orderkey") % 4, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, F.date_format(day, "dd/MM/yyyy")).when(k == 2, "2024-02-31")
    return table(spark, sf_dir, "orders").select("o_orderkey", X.parse_date(text, ISO.contract.date_format).alias("published_date"))


def _decisions_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing page of the second source for each of pages: two records, of which one may lack its path or date, and a pager link on most."""
    n = F.col("page_id").cast("string")
    one = F.concat(F.lit("<article class='d'><h3><a href='/x/"), n, F.lit("'> D  "), n, F.lit(" </a></h3><time>2024-01-09</time><p class='summary'>about "), n, F.lit("</p><span class='no'> n"), n, F.lit(" </span></article>"))
    two = F.concat(F.lit("<article class='d'><h3><a"), F.when(F.col("page_id") % 3 != 0, F.concat(F.lit(" href='y?"), n, F.lit("'"))).otherwise(""), F.lit(">E</a></h3><time>soon</time><p class='summary'></p><span class='no'> </span></article>"))
    pager = F.when(F.col("page_id") % 4 != 0, F.concat(F.lit("<nav><a rel='prev' href='?p=0'>p</a><a rel='next' href='?p="), n, F.lit("'>n</a></nav>"))).otherwise("")
    facet = F.when(F.col("page_id") % 2 == 0, "hc").otherwise("sc")
    url = F.concat(F.lit("https://iso.example/l/"), n)
    return table(spark, sf_dir, "pages").select("page_id", url.alias("url"), facet.alias("facet_id"), F.lit("2024-01").alias("partition_key"), F.lit(1).alias("page"), F.concat(one, two, pager).alias("html"))


@query("""SELECT page_id, CASE WHEN page_id % 4 <> 0 THEN '?p=' || page_id END AS link, CASE WHEN page_id % 4 <> 0 THEN 'https://iso.example/l/' || page_id || '?p=' || page_id END AS next_url, CAST(2 AS BIGINT) AS records FROM pages""")
def pager_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.parsed(_decisions_pages(spark, sf_dir), ISO.contract)
    return found.select("page_id", "link", U.resolve(F.col("url"), F.col("link")).alias("next_url"), F.size("records").cast("bigint").alias("records"))


@query("""SELECT page_id, CAST(r AS INTEGER) AS row_pos, CASE r WHEN 0 THEN 'D ' || page_id ELSE 'E' END AS identifier, CASE r WHEN 0 THEN DATE '2024-01-09' END AS published_date,
  CASE WHEN r = 0 THEN 'https://iso.example/x/' || page_id WHEN page_id % 3 <> 0 THEN 'https://iso.example/l/y?' || page_id END AS doc_url,
  CASE r WHEN 0 THEN 'court_no=n' || page_id ELSE '' END AS extras, CASE WHEN r = 1 AND page_id % 3 = 0 THEN 'missing:doc_path' END AS reason FROM pages, (SELECT unnest([0, 1]) AS r)""")
def listing_rows_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of listing pages by a contract with ISO dates; extras that are empty are left out."""
    rows = pages.listing_rows(_decisions_pages(spark, sf_dir), ISO.contract)
    extras = F.array_join(F.transform(F.map_entries("source_metadata"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return rows.select("page_id", "row_pos", "identifier", "published_date", "doc_url", extras.alias("extras"), "reason")


@query("""SELECT 'D ' || page_id AS identifier, 'iso' AS source, CASE page_id % 2 WHEN 0 THEN 'High Court' ELSE 'Supreme Court' END AS issuing_authority, 'https://iso.example/x/' || page_id AS doc_url,
  CASE WHEN page_id % 10 = 7 THEN 'download_failed' ELSE 'downloaded' END AS outcome, CASE WHEN page_id % 10 <> 7 THEN 'D-' || page_id END AS identifier_slug, CASE WHEN page_id % 10 <> 7 THEN CASE page_id % 10 WHEN 1 THEN 'pdf' ELSE 'html' END END AS extension,
  CASE WHEN page_id % 10 = 7 THEN NULL WHEN page_id % 10 = 1 THEN sha256('%PDF' || page_id) ELSE sha256('body ' || page_id) END AS file_hash, CASE WHEN page_id % 10 = 7 THEN NULL WHEN page_id % 10 = 1 THEN 'raw_bytes' ELSE 'content_text' END AS file_hash_basis,
  CASE WHEN page_id % 10 <> 7 THEN 'iso/' || CASE page_id % 2 WHEN 0 THEN 'hc' ELSE 'sc' END || '/2024-01/D-' || page_id || '/' || CASE WHEN page_id % 10 = 1 THEN sha256('%PDF' || page_id) ELSE sha256('body ' || page_id) END || '.' || CASE page_id % 10 WHEN 1 THEN 'pdf' ELSE 'html' END END AS object_key
FROM pages""")
def landing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows as landing records, with the documents fetched for them and without those that could not be."""
    rows = pages.listing_rows(_decisions_pages(spark, sf_dir), ISO.contract).filter("row_pos = 0").join(F.broadcast(ISO.facet_table(spark)), "facet_id")
    listed = records.from_listing(rows.withColumn("partition_date", F.lit(date(2024, 1, 1))).withColumn("reused", F.lit(False)), ISO, F.lit("2024-02-01").cast("timestamp"))
    n = F.regexp_extract("doc_url", r"\d+$", 0)
    k = n.cast("bigint") % 10
    body = F.when(k == 1, F.concat(F.lit("%PDF"), n)).otherwise(F.concat(F.lit("<main><div>body <i>"), n, F.lit("</i></div></main>")))
    bodies = listed.filter(k != 7).select("doc_url", F.encode(body, "UTF-8").alias("body"), F.when(k == 1, "application/pdf").otherwise("text/html").alias("header"))
    made = records.enriched(pages.documents(listed, bodies), ISO.content, ISO.title)
    return made.select("identifier", "source", "issuing_authority", "doc_url", "outcome", "identifier_slug", "extension", "file_hash", "file_hash_basis", "object_key")


@query("SELECT * FROM (VALUES ('hc', 'High Court', NULL), ('sc', 'Supreme Court', DATE '1997-06-01')) AS t(facet_id, facet_name, active_from)")
def selected_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facet dimension of a specification, by a list of ids as a run is given."""
    return ISO.facet_table(spark, " sc , hc, other")


@query("""SELECT * FROM (VALUES ('facet', 'facet.maps_to', 'is ''color'', which is none of issuing_authority'), ('blank', 'listing_contract.selectors', 'has nothing for record'), ('source', 'listing_contract.doc_path_sources', 'names nope, which no selector finds'),
  ('paging', 'listing.pagination', 'is ''guess'', which is none of declared_total, follow_next'), ('counted', 'listing_contract.selectors', 'lacks result_count'), ('counted', 'listing_contract.patterns', 'lacks no_results, total'),
  ('content', 'document_contract.content', 'is missing')) AS t(spec, place, what)""")
def contract_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that is wrong with some broken specifications; a fault is a row of a few, told before a run."""
    fields = {field: getattr(ISO, field) for field in spec.PLACES if hasattr(ISO, field)}
    fields |= {"selectors": ISO.contract.selectors, "patterns": ISO.contract.patterns, "published": ISO.contract.date_format, "sources": ISO.contract.path_sources}
    broken = {
        "facet": {"facet_target": "color"}, "blank": {"selectors": {**ISO.contract.selectors, "record": " "}}, "source": {"sources": {**ISO.contract.path_sources, "nope": ("href",)}}, "paging": {"pagination": "guess"},
        "counted": {"pagination": "declared_total"}, "content": {"content": ""}, "none": {},
    }
    found = [(name, *fault) for name, change in broken.items() for fault in spec.problems(fields | change)]
    return spark.createDataFrame(found, "spec string, place string, what string")


@query("""SELECT strftime(m, '%Y-%m') AS key, CAST(m AS DATE) AS first, CAST(last_day(m) AS DATE) AS last FROM (SELECT unnest(generate_series(DATE '1996-11-01', DATE '1998-02-01', INTERVAL 1 MONTH)) AS m)""")
def asset_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly partitions that a job runs for, from one month to another."""
    return spark.createDataFrame(run.months("1996-11", "1998-02"), "key string, first date, last date")


@query("""SELECT CAST(year(o_orderdate) AS VARCHAR) || chr(9) || o_orderpriority || chr(9) || CAST(count(*) AS VARCHAR) AS line, row_number() OVER (ORDER BY year(o_orderdate), o_orderpriority) AS place FROM orders GROUP BY year(o_orderdate), o_orderpriority""")
def export_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the coverage export in its order, a line a year and facet."""
    counts = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("facet")).agg(F.count("*").alias("records"))
    lines = checks.tsv_lines(counts, ["year", "facet"])
    return lines.select("line", F.row_number().over(Window.orderBy("year", "facet")).alias("place"))
