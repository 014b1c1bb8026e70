"""Crawls as plans: the pages a first answer promises, and the rows a split plan collects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import total_count
from ..operators.validate import ValidationError
from ..sources import fetch
from ..sources import html as pages_html
from ..sources.counts import CountLog
from ..sources.pages import register
from ..sources.store import landed
from .frontier import search_counts, split_plan_by_asking
from .prefixes import ALPHABET, DEPTH, LIMIT, first_queries, page_count, pages


def further_pages(first: DataFrame, page: str = "page_id", html: str = "html", guess: int = 10) -> DataFrame:
    """``total``, ``per_page``, ``pages`` of each first page, a row for each ``page`` from the second on.

    A first page without a readable total is an error.
    """
    seen = pages_html.table_rows(first, page, html, strict=True).groupBy(page).agg(F.count("*").alias("per_page"))
    stated = total_count(F.col(html))
    total = F.when(stated.isNull(), F.raise_error(F.concat(F.lit("no total on page "), F.col(page).cast("string"))).cast("bigint")).otherwise(stated)
    counted = first.select(page, total.alias("total")).join(seen, page, "left").withColumn("per_page", F.when(F.col("per_page") > 0, F.col("per_page")).otherwise(F.lit(guess)))
    counted = counted.withColumn("pages", page_count(F.col("total"), F.col("per_page"), guess).cast("bigint"))
    return pages(counted, "pages").where("page > 1")


def require_whole(plan: DataFrame) -> DataFrame:
    """``plan``; raises if any prefix stays over the limit, before anything is collected."""
    left = plan.where("status = 'oversized'").count()
    if left:
        raise ValidationError(f"oversized queries remain: {left}")
    return plan


def collect_by_plan(rows: DataFrame, row_id: str, tokens: str, plan: DataFrame, longest: int, most: int | None = None, page_size: int = 100) -> DataFrame:
    """The rows that the final prefixes of a plan find, with ``query_text``, ``page`` and ``nth`` in it.

    The plan is read twice: a table, or a landed frame.  A row comes once for each query that finds it, as with repeated searches.  ``most`` takes
    the first queries in order.  A query holds no more rows than the plan's limit, so the
    order within it is a small sort.
    """
    final = require_whole(plan).where("status = 'final'").select("prefix")
    if most is not None:
        final = final.orderBy("prefix").limit(most)
    cut = lambda t: F.transform(F.sequence(F.lit(1), F.least(F.char_length(t), F.lit(longest))), lambda k: F.substring(t, F.lit(1), k))
    every = F.array_distinct(F.flatten(F.transform(F.filter(tokens, lambda t: t != ""), cut)))
    found = rows.withColumn("prefix", F.explode(every)).join(final, "prefix")
    place = F.row_number().over(Window.partitionBy("prefix").orderBy(row_id)) - 1
    return found.withColumn("nth", place).withColumn("page", F.floor(F.col("nth") / page_size) + 1).withColumn("query_text", F.concat("prefix", F.lit("*"))).drop("prefix")


def collection_stats(collected: DataFrame, plan: DataFrame) -> DataFrame:
    """One row: final and oversized queries of the plan, pages and results collected."""
    of = lambda s: F.count(F.when(F.col("status") == s, 1))
    planned = plan.agg(of("final").alias("final_query_count"), of("oversized").alias("oversized_query_count"))
    got = collected.agg(F.count_distinct("query_text", "page").alias("raw_page_count"), F.count("*").alias("raw_result_count"))
    return planned.crossJoin(got)  # one row each


@dataclass(frozen=True)
class Crawl:
    """The pages as they came, and one row of statistics."""

    pages: DataFrame
    stats: DataFrame


def crawl_registry(spark: SparkSession, url: str, folder: str | None = None, **options: object) -> tuple[Crawl, DataFrame]:
    """All pages of a registry, from the first one on, and the rows on them (page, row and six fields).

    Pages land in ``folder`` (or scratch) once, so nothing is asked twice.  ``options`` are those of the
    ``registry_pages`` source.  Statistics: the total that the first page states, and the rows collected.
    """
    register(spark)
    source = spark.read.format("registry_pages").options(url=url, **{k: str(v) for k, v in options.items()})
    found = landed(source.load(), folder)
    rows = pages_html.table_rows(found, "page", strict=True)
    stated = found.where("page = 1").select(total_count(F.col("html")).alias("total_expected"))  # one row
    return Crawl(found, stated.crossJoin(rows.agg(F.count("*").alias("total_collected")))), rows


@dataclass(frozen=True)
class Search:
    """A search service and how it is asked."""

    url: str
    api_key: str
    user_agent: str
    field: str = "inciName"
    item_type: str | None = "ingredient"
    extra: tuple[dict, ...] = ()
    page_size: int = 100
    how: fetch.Patience = fetch.SEARCHING

    def answers(self, queries: DataFrame, size: str | None = None) -> DataFrame:
        """``queries`` (query_text, page) with the ``payload`` of each."""
        wanted = fetch.search_requests(queries, self.url, self.api_key, F.col(size) if size else self.page_size, self.user_agent, self.field, self.item_type, self.extra)
        return fetch.responses(wanted, self.how, "payload").select("query_text", "page", "payload")


def collect_search(queries: DataFrame, service: Search, folder: str | None = None, batch: int = 50) -> DataFrame:
    """``query_text``, ``page`` and ``payload`` of every page of every query.

    First pages are asked for and land, then what they promise, in tasks of ``batch`` requests.
    """
    below = lambda name: folder and f"{folder}/{name}"
    dealt = lambda rows, n: rows.repartition(max(1, -(-n // batch)), "query_text", "page")
    asked = queries.select("query_text", F.lit(1).cast("bigint").alias("page"))
    first = landed(service.answers(dealt(asked, asked.count())), below("first"))
    said = lambda name: F.coalesce(F.get_json_object("payload", f"$.{name}").try_cast("bigint"), F.lit(0))
    sized = first.select("query_text", said("totalResults").alias("total"), F.coalesce(F.nullif(said("pageSize"), F.lit(0)), F.lit(service.page_size)).alias("size"))
    more = pages(sized.withColumn("pages", page_count(F.col("total"), F.col("size"))), "pages").where("page > 1")
    rest = landed(service.answers(dealt(more, more.count()), "size"), below("rest"))
    return first.unionByName(rest)


def extract_search(
    service: Search, log: CountLog, limit: int = LIMIT, depth: int = DEPTH, seeds: str = ALPHABET, following: str = ALPHABET, max_seeds: int | None = None, max_queries: int | None = None, folder: str | None = None
) -> Crawl:
    """A whole extraction under a row limit: plan by asking, no oversized query, every page of every query.

    The pages are for ``payload.bronze``.  Statistics: final and oversized queries, pages and results.
    """
    ask = search_counts(service.url, service.api_key, service.user_agent, service.field, service.item_type, service.extra, service.how)
    plan = require_whole(landed(split_plan_by_asking(ask, log, limit, depth, seeds, following, max_seeds), folder and f"{folder}/plan"))
    final = plan.where("status = 'final'") if max_queries is None else first_queries(plan, max_queries)
    queries = final.select(F.concat("prefix", F.lit("*")).alias("query_text"))
    found = collect_search(queries, service, folder)
    results = F.coalesce(F.json_array_length(F.get_json_object("payload", "$.results")), F.lit(0))
    got = found.agg(F.count("*").alias("raw_page_count"), F.coalesce(F.sum(results), F.lit(0)).cast("bigint").alias("raw_result_count"))
    counted = queries.agg(F.count("*").alias("final_query_count")).withColumn("oversized_query_count", F.lit(0).cast("bigint"))
    return Crawl(found, counted.crossJoin(got))  # one row each
