"""The split plan against a service that only answers counts: level by level, open prefixes alone are asked.

A prefix is open if it is a seed, or its parent is over the limit.  Answers go into a
``CountLog`` at once, and the closed form of the plan over that log is the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import fetch
from ..sources.counts import CountLog
from ..sources.store import landed
from ..sources.tables import count_key
from .prefixes import ALPHABET, DEPTH, LIMIT, split_plan

#: Answers the prefixes of a frame: takes ``prefix``, gives ``prefix`` and ``n`` for each.
Ask = Callable[[DataFrame], DataFrame]
#: Prefixes that one task asks for before its counts are kept.
BATCH = 200


def log_key(prefix: Column, fields: Mapping[str, object] | None = None) -> Column:
    """Under which a prefix's count is kept: its wildcard query, and the form fields if there are any."""
    return F.concat(prefix, F.lit(count_key("*", fields)))


def recorded(log: CountLog, fields: Mapping[str, object] | None = None) -> DataFrame:
    """``prefix`` and ``n`` of the log's counts that were asked with these fields."""
    tail = count_key("*", fields)
    known = log.known().where(F.col("key").endswith(tail))
    return known.select(F.expr(f"left(key, char_length(key) - {len(tail)})").alias("prefix"), "n").where(~F.col("prefix").contains("*"))


def ask_frontier(
    ask: Ask, log: CountLog, limit: int = LIMIT, depth: int = DEPTH, seeds: str = ALPHABET, following: str = ALPHABET, max_seeds: int | None = None, fields: Mapping[str, object] | None = None, batch: int = BATCH
) -> None:
    """Fill the log with the counts that the plan needs; known counts are not asked for.

    A job a level, at most ``depth + 1``.  A prefix without an answer counts as 0.  Open prefixes
    land level by level, so a level's plan does not hold those above it.
    """
    chosen = seeds if max_seeds is None else seeds[:max_seeds]
    wanted = log.spark.createDataFrame([(c,) for c in chosen], "prefix string")
    for level in range(depth + 1):
        missing = landed(wanted.join(recorded(log, fields), "prefix", "left_anti"))
        left = missing.count()
        if left:
            missing = missing.repartition(-(-left // batch), "prefix")
            found = ask(missing).select("prefix", F.coalesce(F.col("n").cast("bigint"), F.lit(0)).alias("n"))
            log.append(found.select(log_key(F.col("prefix"), fields).alias("key"), "n"))
        if level == depth:
            return
        over = wanted.join(recorded(log, fields).where(F.col("n") > limit).select("prefix"), "prefix", "left_semi")
        wanted = landed(over.select(F.explode(F.transform(F.array(*[F.lit(c) for c in following]), lambda c: F.concat("prefix", c))).alias("prefix")))
        if wanted.isEmpty():
            return


def split_plan_by_asking(
    ask: Ask, log: CountLog, limit: int = LIMIT, depth: int = DEPTH, seeds: str = ALPHABET, following: str = ALPHABET, max_seeds: int | None = None, fields: Mapping[str, object] | None = None, batch: int = BATCH
) -> DataFrame:
    """``prefix``, ``n`` and ``status`` of the queries to send, from counts that are asked for and kept."""
    ask_frontier(ask, log, limit, depth, seeds, following, max_seeds, fields, batch)
    return split_plan(recorded(log, fields), limit, depth, seeds, max_seeds)


def requests_by_level(counts: DataFrame, limit: int) -> DataFrame:
    """For each length of a prefix how many were asked, and how many of them are over the limit."""
    return counts.groupBy(F.char_length("prefix").cast("bigint").alias("level")).agg(F.count("*").alias("asked"), F.count(F.when(F.col("n") > limit, 1)).alias("over"))


def search_counts(url: str, api_key: str, user_agent: str, field: str, item_type: str | None = None, extra: tuple[dict, ...] = (), how: fetch.Patience = fetch.SEARCHING) -> Ask:
    """Counts from the search service: one result of one page is asked for, its total is read."""

    def ask(prefixes: DataFrame) -> DataFrame:
        asked = prefixes.select("prefix", F.concat("prefix", F.lit("*")).alias("query_text"), F.lit(1).alias("page"))
        answers = fetch.responses(fetch.search_requests(asked, url, api_key, 1, user_agent, field, item_type, extra), how)
        return answers.select("prefix", F.get_json_object("response", "$.totalResults").cast("bigint").alias("n"))

    return ask
