"""Splitting an extraction by prefixes so that no query passes a row limit.

The recursion "expand a prefix that is over the limit" has a closed form: with ``n(p)`` the
rows that match prefix ``p``, a prefix is final if 0 < n(p) <= limit and it is a seed or its
parent is over the limit; a longest prefix over the limit is oversized.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALPHABET = string.ascii_lowercase + string.digits
LIMIT = 9500
DEPTH = 6


def prefix_counts(rows: DataFrame, row_id: str, tokens: str, longest: int = DEPTH + 1, seeds: str = ALPHABET, following: str = ALPHABET, unique: bool = False) -> DataFrame:
    """``prefix`` and ``n``: distinct rows with some token that begins with it.

    A row's prefixes are made distinct inside the row.  With ``unique`` ids each stands at the first
    of the row's sorted heads (tokens, cut) that has it: a head brings the prefixes longer than what it
    shares with the head before.  So heads are counted by that length, and only counts are cut up.
    """
    head = F.transform(F.array_distinct(F.transform(tokens, lambda t: F.left(t, F.lit(longest)))), lambda t: F.regexp_extract(t, f"^[{seeds}][{following}]{{0,{longest - 1}}}", 0))
    heads = rows.select(row_id, F.filter(F.array_distinct(head), lambda t: t != "").alias("heads"))
    if not unique:
        cut = F.flatten(F.transform("heads", lambda t: F.transform(F.sequence(F.lit(1), F.char_length(t)), lambda k: F.substring(t, F.lit(1), k))))
        return heads.select(row_id, F.explode(F.array_distinct(cut)).alias("prefix")).distinct().groupBy("prefix").agg(F.count("*").alias("n"))
    each = heads.select(F.sort_array("heads").alias("heads")).select(F.inline(F.arrays_zip("heads", F.concat(F.array(F.lit("")), "heads")))).toDF("head", "before").where("head IS NOT NULL")
    shared = F.lit(longest)
    for k in range(longest, 0, -1):
        shared = F.when(F.startswith("head", F.left("before", F.lit(k))), shared).otherwise(k - 1)
    counted = each.groupBy("head", F.least(shared, F.char_length("before")).alias("shared")).agg(F.count("*").alias("n"))
    brought = F.transform(F.sequence(F.col("shared") + 1, F.char_length("head")), lambda k: F.left("head", k))
    return counted.select(F.explode(brought).alias("prefix"), "n").groupBy("prefix").agg(F.sum("n").alias("n"))


def split_plan(counts: DataFrame, limit: int = LIMIT, depth: int = DEPTH, seeds: str = ALPHABET, max_seeds: int | None = None) -> DataFrame:
    """``prefix``, ``n`` and ``status`` (final or oversized) of the prefixes to query.

    ``counts`` may be any recorded counts; zero counts and prefixes that are never reached
    fall away.
    """
    chosen = seeds if max_seeds is None else seeds[:max_seeds]
    size = F.char_length("prefix")
    inside = counts.where((F.col("n") > 0) & F.substring("prefix", 1, 1).isin(*chosen) & (size <= depth + 1))
    over = inside.where(F.col("n") > limit).select(F.col("prefix").alias("parent"))
    parent = F.when(size > 1, F.expr("left(prefix, char_length(prefix) - 1)"))
    reached = inside.withColumn("parent", parent).join(over.withColumn("open", F.lit(True)), "parent", "left").where("parent IS NULL OR open")
    status: Column = F.when(F.col("n") <= limit, "final").when(size == depth + 1, "oversized")
    return reached.select("prefix", "n", status.alias("status")).where("status IS NOT NULL")


def residual(counts: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Prefixes over the limit with the rows that their children do not add up to: at least so many a split loses."""
    children = counts.groupBy(F.expr("left(prefix, char_length(prefix) - 1)").alias("prefix")).agg(F.sum("n").alias("below"))
    return counts.where(F.col("n") > limit).join(children, "prefix", "left").select("prefix", "n", F.greatest(F.col("n") - F.coalesce("below", F.lit(0)), F.lit(0)).alias("residual"))


def first_queries(plan: DataFrame, most: int) -> DataFrame:
    """The first ``most`` final prefixes in order."""
    return plan.where("status = 'final'").orderBy("prefix").limit(most)


def page_count(total: Column, per_page: Column, guess: int = 10) -> Column:
    """Pages that hold ``total`` rows; a first page without rows is taken for ``guess`` a page."""
    return F.ceil(total / F.coalesce(F.nullif(per_page, F.lit(0)), F.lit(guess)))


def pages(rows: DataFrame, count: str) -> DataFrame:
    """One row for each page 1 .. ``count``; none for no pages."""
    return rows.where(F.col(count) > 0).withColumn("page", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(count).cast("bigint"))))
