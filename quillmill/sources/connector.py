"""Listing pages as a Spark data source: one input partition per facet, period and page.

The transport is a function that the options name as module:function, url -> html; offline it reads a table or a
folder. A filter on the facet is pushed into what is asked for, and honoured exactly. A request that meets a fault that
may pass is made again, after a pause; one that fails for good is a row with its error.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition
from pyspark.sql.types import StructType

from quillmill.sources.retry import Patience


@dataclass
class Request(InputPartition):
    url: str
    facet_id: str
    partition_key: str
    page: int


class PageSource(DataSource):
    """Options: requests (JSON list of url, facet_id, partition_key, page), transport (module:function), delay, retries and backoff (see Patience), and push.

    With push set to true, which needs spark.sql.python.filterPushdown.enabled, a filter on the facet spares its requests.
    """

    @classmethod
    def name(cls) -> str:
        return "listing_pages"

    def schema(self) -> str:
        return "url string, facet_id string, partition_key string, page int, html string, error string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return (FilteredPageReader if self.options.get("push") == "true" else PageReader)(self.options)


class PageReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.requests = [Request(r["url"], r["facet_id"], r["partition_key"], int(r["page"])) for r in json.loads(options["requests"])]
        self.transport = options["transport"]
        self.patience = Patience(**{k: kind(options[k]) for k, kind in (("delay", float), ("retries", int), ("backoff", float)) if k in options})

    def partitions(self) -> list[InputPartition]:
        return self.requests

    def read(self, partition: Request) -> Iterator[tuple]:
        module, _, function = self.transport.partition(":")
        try:
            fetch = getattr(importlib.import_module(module), function)
            html, error = self.patience.ask(lambda: fetch(partition.url)), None
        except Exception as e:  # noqa: BLE001  a page that fails is a row with its error
            html, error = None, type(e).__name__
        yield partition.url, partition.facet_id, partition.partition_key, partition.page, html, error


class FilteredPageReader(PageReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("facet_id",):
                self.requests = [r for r in self.requests if r.facet_id == f.value]
            else:
                yield f
