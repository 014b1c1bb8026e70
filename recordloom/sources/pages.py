"""Paged services as Spark data sources: partitions are ranges of pages, the first page says how many there are.

``spark.read.format("registry_pages")`` reads a table that stands on numbered HTML pages,
``format("search_pages")`` one query of a JSON search.  Both give ``page`` and the page as text,
and ask for the first page once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import fetch, html

#: Rows that a first page without any is taken to hold.
GUESS = 10


@dataclass
class PageRange(InputPartition):
    """Pages to ask for; or with ``text`` the first page, which is known."""

    first: int
    last: int
    text: str | None = None


class _Reader(DataSourceReader):
    """Asks page by page, with retries; options: ``attempts``, ``timeout``, ``pause``, ``longest``, ``jitter``, ``span`` (pages a partition)."""

    only: tuple[int, ...] | None = None

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options
        if "url" not in options:
            raise ValueError("the url is missing")
        given = {k: float(options[k]) for k in ("timeout", "pause", "longest", "jitter") if k in options}
        self.how = fetch.Patience(attempts=int(options.get("attempts", 5)), only=self.only, **given)

    def page(self, number: int) -> str:
        raise NotImplementedError

    def count(self, first: str) -> int:
        raise NotImplementedError

    def partitions(self) -> list[PageRange]:
        first = self.page(1)
        span, last = int(self.options.get("span", 50)), self.count(first)
        return [PageRange(1, 1, first), *(PageRange(p, min(p + span - 1, last)) for p in range(2, last + 1, span))]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        for number in range(partition.first, partition.last + 1):
            yield number, self.page(number) if partition.text is None else partition.text


class RegistryReader(_Reader):
    def page(self, number: int) -> str:
        params = {"skind": "ALL", "sword": "", "sword2": "", "page": str(number)}
        return fetch.ask(self.options["url"], params, fetch.page_headers(self.options.get("user_agent", "recordloom")), None, self.how)

    def count(self, first: str) -> int:
        total = html.stated_total(first)
        if total is None:
            raise ValueError("the first page states no total")
        return -(-total // (html.count_records(first) or GUESS))


class SearchReader(_Reader):
    only = fetch.BUSY

    def page(self, number: int) -> str:
        o = self.options
        sent = fetch.search_form(o.get("text", "*"), number, int(o.get("page_size", 100)), o.get("api_key", ""), o.get("user_agent", "recordloom"), o.get("field", "inciName"), o.get("item_type"), tuple(json.loads(o.get("extra", "[]"))))
        return fetch.ask(o["url"], *sent, self.how)

    def count(self, first: str) -> int:
        said = json.loads(first)
        size = int(said.get("pageSize") or 0) or int(self.options.get("page_size", 100))
        return -(-int(said.get("totalResults") or 0) // size)


class RegistryPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "registry_pages"

    def schema(self) -> str:
        return "page bigint, html string"

    def reader(self, schema) -> RegistryReader:
        return RegistryReader(dict(self.options))


class SearchPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "search_pages"

    def schema(self) -> str:
        return "page bigint, payload string"

    def reader(self, schema) -> SearchReader:
        return SearchReader(dict(self.options))


def register(spark: SparkSession) -> None:
    for source in (RegistryPages, SearchPages):
        spark.dataSource.register(source)
