"""Result tables in HTML pages, read with the standard library's tokenizer in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import TOTALS, as_of_date

#: Words of a result table's header; the two lists differ in one word.
TABLE_MARKS = ("성분코드", "국문명", "영문명", "INCI", "코드", "CAS No", "구명칭")
HEADER_MARKS = ("성분코드", "국문명", "영문명", "INCI", "번호", "CAS No", "구명칭")
FIELDS = ("ingredient_code", "std_name_ko", "std_name_en", "cas_no", "old_name_ko", "as_of_date")


def one_line(text: str) -> str:
    return " ".join(text.replace(" ", " ").split())


class _Node:
    """A table, row or cell: its parts in order, texts and nodes."""

    def __init__(self, kind: str) -> None:
        self.kind, self.parts = kind, []

    def text(self) -> str:
        return " ".join(t for t in (p.strip() if isinstance(p, str) else p.text() for p in self.parts) if t)

    def all(self, *kinds: str) -> list[_Node]:
        out = []
        for part in self.parts:
            if isinstance(part, _Node):
                if part.kind in kinds:
                    out.append(part)
                out += part.all(*kinds)
        return out


class _Page(HTMLParser):
    KEPT = ("table", "tr", "td", "th", "title")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("page")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag not in self.KEPT:
            return
        # a row or cell that is not closed ends where the next begins, inside its own table
        ends = {"tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, ())
        while len(self.open) > 1 and self.open[-1].kind in ends:
            self.open.pop()
        node = _Node(tag)
        self.open[-1].parts.append(node)
        self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        if tag in self.KEPT and any(n.kind == tag for n in self.open):
            while self.open.pop().kind != tag:
                pass

    def handle_data(self, data: str) -> None:
        self.open[-1].parts.append(data)


def read_page(html: str) -> tuple[str, list[list[str]] | None]:
    """Title, and the cells of each row of the result table; None for rows if there is no table."""
    page = _Page()
    page.feed(html)
    page.close()
    titles, found = page.root.all("title"), page.root.all("table")
    title = one_line(titles[0].text()) if titles else ""
    named = (t for t in found if any(m in one_line(t.text()) for m in TABLE_MARKS))
    chosen = next(named, found[0] if found else None)
    return title, chosen and [[one_line(c.text()) for c in row.all("td", "th")] for row in chosen.all("tr")]


def count_records(html: str) -> int:
    """Rows of a page's result table that ``record`` takes, for a crawl that has one page to plan by."""
    _, rows = read_page(html)
    return sum(bool(cells and re.fullmatch(r"\d+", cells[0].replace(",", "")) and not any(m in " ".join(cells) for m in HEADER_MARKS)) for cells in rows or ())


def stated_total(html: str) -> int | None:
    """What ``total_count`` gives, for the same."""
    for pattern in TOTALS:
        if found := re.search(pattern, html, re.A):
            digits = found[1].replace(",", "")
            return int(digits) if digits else None
    return None


def record(cells: Column) -> Column:
    """The six fields of a row of cells; null for a row that is no record: a header, or one without a number in front."""
    code = F.replace(F.get(cells, F.lit(0)), F.lit(","), F.lit(""))
    heading = F.array_join(cells, " ").rlike("|".join(map(re.escape, HEADER_MARKS)))
    named = [F.nullif(F.get(cells, F.lit(k + 1)), F.lit("")) for k in range(4)]
    fields = [c.alias(name) for c, name in zip((code, *named, as_of_date(cells)), FIELDS)]
    return F.when(code.rlike(r"(?U)^\d+$") & ~heading, F.struct(*fields))


def table_rows(pages: DataFrame, page: str = "page_id", html: str = "html", strict: bool = False) -> DataFrame:
    """A row for each data row of each page: the page, its place in the table and six text fields.

    Pages are cut into cells in Arrow batches; which rows are records and what their fields
    are is decided in the JVM.  A page without a table gives no rows; with ``strict`` it is an
    error that names its title.
    """
    kind = pages.schema[page].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for number, text in zip(batch[page], batch[html]):
                title, rows = read_page(text or "")
                if rows is None and strict:
                    raise ValueError(f"no result table in page {number}; its title: {title}")
                out += [(number, i, cells) for i, cells in enumerate(rows or ())]
            yield pd.DataFrame(out, columns=[page, "row", "cells"])

    cut = pages.select(page, html).mapInPandas(run, f"{page} {kind}, row int, cells array<string>")
    return cut.select(page, "row", record(F.col("cells")).alias("record")).where("record IS NOT NULL").select(page, "row", "record.*")


def page_title(html: Column) -> Column:
    """Text of the first title, in one line; null if there is none."""
    raw = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.nullif(F.trim(F.regexp_replace(F.replace(raw, F.lit(" "), F.lit(" ")), r"(?U)[\s\x1c-\x1f]+", " ")), F.lit(""))


def list_links(html: Column) -> Column:
    """(href, label) of every ``<li><a href=...>``."""
    every = F.regexp_extract_all(html, F.lit(r"(?is)<li><a href=\"([^\"]*)\">(.*?)</a></li>"), F.lit(0))
    return F.transform(every, lambda x: F.struct(F.regexp_extract(x, r'(?is)href="([^"]*)"', 1).alias("href"), F.regexp_extract(x, r'(?is)">(.*?)</a>', 1).alias("label")))
