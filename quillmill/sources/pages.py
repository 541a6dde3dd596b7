"""Listing pages as rows: a page's records, its declared count and its pager link."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import html as H
from quillmill.functions import text as X
from quillmill.functions import urls
from quillmill.plans.spec import Contract
from quillmill.sources.retry import Patience

ROWS = "record int, identifier_raw string, description string, published string, paths map<string,string>, extras map<string,string>"


def _first_text(node: H.Node, selector: str) -> str | None:
    """The first text node below the first element that fits and has one."""
    for found in H.select(node, selector):
        for text in found.texts(()):
            return text
    return None


def _path(node: H.Node, selector: str, attributes: tuple[str, ...]) -> str | None:
    found = H.select(node, selector)
    return next((found[0].attributes[a] for a in attributes if found[0].attributes.get(a)), None) if found else None


def parse_page(html: str | None, contract: Contract) -> tuple[str | None, str | None, list[dict]]:
    """Count text, pager link and the records of a page."""
    return H.within(html, lambda top: _page(top, contract))


def _page(top: H.Node, contract: Contract) -> tuple[str | None, str | None, list[dict]]:
    own = contract.selectors
    count = H.select(top, own["result_count"]) if "result_count" in own else []
    pager = H.select(top, own["next_page"]) if "next_page" in own else []
    rows = [
        {
            "record": k, "identifier_raw": _first_text(node, own["identifier"]) or "", "description": _first_text(node, own["description"]), "published": _first_text(node, own["published_date"]),
            "paths": {name: _path(node, own[name], attributes) for name, attributes in contract.path_sources.items()}, "extras": {name: _first_text(node, own[name]) for name in contract.extra_fields},
        }
        for k, node in enumerate(H.select(top, own["record"]))
    ]
    return " ".join(t for c in count for t in c.texts(())) if count else None, pager[0].attributes.get("href") if pager else None, rows


def parsed(pages: DataFrame, contract: Contract) -> DataFrame:
    """pages with count_text, link and records (an array), from one parse of each page in Arrow batches."""
    H.in_batches(pages.sparkSession)
    kind = f"count_text string, link string, records array<struct<{ROWS.replace(' int', ':int').replace(' string', ':string').replace(' map', ':map').replace(', ', ',')}>>"

    @F.pandas_udf(f"struct<{kind.replace('count_text string', 'count_text:string').replace('link string', 'link:string').replace('records array', 'records:array').replace(', ', ',')}>")
    def parse(html: pd.Series) -> pd.DataFrame:
        found = [parse_page(x, contract) for x in html]
        return pd.DataFrame({"count_text": [f[0] for f in found], "link": [f[1] for f in found], "records": [f[2] for f in found]})

    # As one whose results may vary: a filter on records, which exploding them brings, would else be moved below it and parse all pages once more.
    return pages.withColumn("__page", parse.asNondeterministic()("html")).select(*pages.columns, "__page.*")


def listing_rows(pages: DataFrame, contract: Contract) -> DataFrame:
    """A row per record: identifier, description, published_date, doc_path, doc_url, path_conflict, extras, reason, flags.

    Rows without identifier or path stay, with the reason for which they are to be skipped.
    """
    return record_rows(parsed(pages, contract), contract)


def record_rows(pages: DataFrame, contract: Contract) -> DataFrame:
    """listing_rows of pages that are parsed already."""
    found = pages.select(*(c for c in pages.columns if c not in ("html", "count_text", "link", "records")), F.explode("records").alias("r"))
    sources = [F.col("r")["paths"][name] for name in contract.path_sources]
    path = X.first_present(*sources)
    out = found.select(
        *(c for c in found.columns if c != "r"), F.col("r")["record"].alias("row_pos"), X.normalise(F.col("r")["identifier_raw"]).alias("identifier"), F.col("r")["identifier_raw"].alias("identifier_raw"),
        X.normalise(F.col("r")["description"]).alias("description"), X.parse_date(F.col("r")["published"], contract.date_format).alias("published_date"), path.alias("doc_path"), urls.resolve(F.col("url"), path).alias("doc_url"),
        X.conflicting(*sources).alias("path_conflict"), X.non_empty(F.transform_values(F.col("r")["extras"], lambda k, v: X.normalise(v))).alias("source_metadata"),
    )
    from quillmill.operators.reconcile import row_quality

    return out.withColumn("__q", row_quality(F.col("identifier"), F.col("doc_path"), F.col("published_date"))).select(*out.columns, "__q.*")


def nav_records(pages: DataFrame, id_column: Column) -> DataFrame:
    """Links of pages' list items, natively: for listings whose records are plain `<li><a href>`."""
    items = F.regexp_extract_all("html", F.lit(r'(?is)<li><a href="([^"]*)">[^<]*</a></li>'), F.lit(0))
    rows = pages.select(id_column.alias("page_id"), F.posexplode(items).alias("row_pos", "item"))
    link = F.regexp_extract("item", r'(?is)href="([^"]*)"', 1)
    return rows.select("page_id", "row_pos", link.alias("href"), X.normalise(F.regexp_extract("item", r"(?is)>([^<]*)</a>", 1)).alias("identifier"))


def documents(rows: DataFrame, bodies: DataFrame) -> DataFrame:
    """Listing rows with the documents fetched for them (doc_url, body, header): a left join, so that failures stay as rows."""
    return rows.join(bodies, "doc_url", "left").withColumn("outcome", F.when(F.col("body").isNull(), "download_failed").otherwise("downloaded"))


def fetched(batches: Iterator[pd.DataFrame], fetch, patience: Patience = Patience()) -> Iterator[pd.DataFrame]:  # noqa: B008  it cannot change
    """For mapInPandas: each row's URL fetched by `fetch(url) -> (body, header)`; an error that stays becomes a column, so that it costs one row."""
    for batch in batches:
        found = []
        for url in batch["doc_url"]:
            try:
                found.append((*patience.ask(lambda url=url: fetch(url)), None))
            except Exception as e:  # noqa: BLE001  any failure of one document is reported with it
                found.append((None, None, type(e).__name__))
        yield batch.assign(body=[f[0] for f in found], header=[f[1] for f in found], error=[f[2] for f in found])


def live(rows: DataFrame, fetch, patience: Patience = Patience()) -> DataFrame:  # noqa: B008
    """The documents (doc_url, body, header, error) of listing rows, each URL fetched once."""
    urls = rows.select("doc_url").filter("doc_url is not null").distinct()
    return urls.mapInPandas(lambda batches: fetched(batches, fetch, patience), "doc_url string, body binary, header string, error string")
