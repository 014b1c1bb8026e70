"""Matching the rows of one registry to another: exact key cascade, then the best fuzzy match.

Left and right frames carry an order column ``_ord`` (first wins) and the keys of ``KEYS``.
The right frame's payload travels as one struct until the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.similarity import places, similarity, similarity_of
from ..sources.store import landed
from .dedupe import first_by_key
from .fuzzy import best_of_rounds

#: (key column, label), best first.
STAGES: tuple[tuple[str, str], ...] = (
    ("key_cas", "exact_cas"),
    ("key_basic", "exact_basic"),
    ("key_full", "exact_full_normalized"),
    ("key_paren_removed", "exact_paren_removed"),
    ("key_sorted", "exact_word_sorted"),
    ("key_sorted_strict", "exact_word_sorted_strict"),
)
KEYS = tuple(k for k, _ in STAGES)


def with_keys(rows: DataFrame, name: str, cas: str, fold: bool = True, strict_leading: bool = False) -> DataFrame:
    """``rows`` with the six match keys.  ``fold`` off promises names without compatibility characters."""
    rows = rows.withColumns({"key_basic": tx.basic(F.col(name), fold=fold), "key_cas": tx.identifier(F.col(cas))})
    rows = rows.withColumns({"key_full": tx.full(F.col("key_basic")), "key_paren_removed": tx.paren_removed(F.col("key_basic"), strict_leading)})
    return rows.withColumns({"key_sorted": tx.word_sorted(F.col("key_full")), "key_sorted_strict": tx.word_sorted_strict(F.col("key_paren_removed"))})


def lookup(right: DataFrame, key: str, name: str, payload: Sequence[str]) -> DataFrame:
    """First row of each key; ``hit`` is null where that row has no name (it shadows later rows all the same)."""
    first = first_by_key(right.select(key, "_ord", *[c for c in dict.fromkeys((name, *payload)) if c not in (key, "_ord")]), key)
    whole = F.struct(*[F.col(c) for c in dict.fromkeys((*payload, name))], F.col("_ord").alias("_right_ord"))
    return first.select(F.col(key), F.when(F.col(name).isNotNull(), whole).alias("hit"))


def exact_match(left: DataFrame, right: DataFrame, key: str, label: str, name: str, payload: Sequence[str]) -> DataFrame:
    """``left`` with ``hit`` (null if unmatched), ``match_type`` and ``match_score`` of one exact stage."""
    joined = left.join(lookup(right, key, name, payload), key, "left")
    found = F.col("hit").isNotNull()
    return joined.withColumns({"match_type": F.when(found, F.lit(label)), "match_score": F.when(found, F.lit(100.0))})


def _payload(right: DataFrame, name: str, payload: Sequence[str], out: str) -> DataFrame:
    """``_right_ord`` and the payload of each right row as one struct."""
    whole = F.struct(*[F.col(c) for c in dict.fromkeys((*payload, name))], F.col("_ord").alias("_right_ord"))
    return right.select(F.col("_ord").alias("_right_ord"), whole.alias(out))


def spread(rows: DataFrame, *kept: Column | str, stages: Sequence[tuple[str, str]] = STAGES) -> DataFrame:
    """``kept`` columns with a row for each (``stage``, ``key``) that is not null."""
    order = F.array(*[F.struct(F.lit(i).alias("stage"), F.col(k).alias("key")) for i, (k, _) in enumerate(stages)])
    return rows.select(*kept, F.explode(order).alias("s")).select("*", "s.stage", "s.key").drop("s").where("key IS NOT NULL")


def first_holders(right: DataFrame, name: str, stages: Sequence[tuple[str, str]] = STAGES) -> DataFrame:
    """The first row of each key: ``stage``, ``key``, ``_right_ord`` and whether it is ``named``; it decides, and only then its name is looked at."""
    first = spread(right, F.struct("_ord", F.col(name).isNotNull().alias("named")).alias("first"), stages=stages).groupBy("stage", "key").agg(F.min("first").alias("f"))
    return first.select("stage", "key", F.col("f._ord").alias("_right_ord"), "f.named")


def first_hits(spread_left: DataFrame, holders: DataFrame) -> DataFrame:
    """``_ord``, ``stage`` and ``_right_ord`` of the first stage that has a named hit."""
    met = spread_left.join(holders.where("named").drop("named"), ["stage", "key"])
    return least_hits(met.select("_ord", "stage", "_right_ord"))


def least_hits(hits: DataFrame) -> DataFrame:
    return hits.groupBy("_ord").agg(F.min(F.struct("stage", "_right_ord")).alias("b")).select("_ord", "b.stage", "b._right_ord")


def cascade_keys(left: DataFrame, right: DataFrame, name: str, stages: Sequence[tuple[str, str]] = STAGES) -> DataFrame:
    """``_ord`` of each left row that an exact stage matches, its first such ``stage`` and the ``_right_ord`` that it hits.

    Stages do not depend on each other, so both sides become (stage, key) rows and meet in
    one equi-join; the least stage with a named hit wins.  Only keys and order numbers travel.
    Keys that many rows share are left to the adaptive skew join.  Left rows are told apart by ``_ord``.
    """
    return first_hits(spread(left, "_ord", stages=stages), first_holders(right, name, stages))


def _label(stages: Sequence[tuple[str, str]]) -> Column:
    return F.element_at(F.array(*[F.lit(t) for _, t in stages]), F.col("stage") + 1)


def cascade(left: DataFrame, right: DataFrame, name: str, payload: Sequence[str], stages: Sequence[tuple[str, str]] = STAGES) -> DataFrame:
    """``left`` with the hit of the first stage that has one; the payload joins the winners."""
    joined = left.join(cascade_keys(left, right, name, stages), "_ord", "left").join(_payload(right, name, payload, "hit"), "_right_ord", "left")
    found = F.col("stage").isNotNull()
    return joined.withColumns({"match_type": F.when(found, _label(stages)), "match_score": F.when(found, F.lit(100.0))}).drop("stage", "_right_ord")


@dataclass(frozen=True)
class Thresholds:
    auto: int = 95
    review: int = 90

    @property
    def cutoff(self) -> int:
        return min(self.auto, self.review)


def best_fuzzy(left_keys: DataFrame, right: DataFrame, cutoff: int, python: bool = True) -> DataFrame:
    """For each distinct text ``key``, the best ``candidate`` of the right side and its score, if that reaches ``cutoff``.

    ``right`` has ``key`` and ``_ord``; of candidates that score alike the first in order wins.
    Scores come from Arrow batches, or with ``python`` off from bit-parallel column functions,
    which need no Python workers and about twice the time.
    """
    b = landed(right.groupBy(F.col("key").alias("b")).agg(F.min("_ord").alias("_ord")))

    def best(pairs: DataFrame, least: int) -> DataFrame:
        if python:
            # not taken for deterministic, or it would move below the distinct and score pairs several times
            scored = pairs.withColumn("score", similarity.asNondeterministic()("a", "b")).where(F.col("score") >= least).join(b, "b")
        else:
            met = pairs.join(b.withColumn("spots", places(F.col("b"))), "b")
            # as rows of its own the score is computed once, where a condition on it would move into the join and be made again
            reached = F.filter(F.array(similarity_of(F.col("a"), F.col("b"), F.col("spots"))), lambda s: s >= least)
            scored = met.select("a", "b", "_ord", F.explode(reached).alias("score"))
        return scored.groupBy("a").agg(F.min_by(F.struct("b", "score", "_ord"), F.struct(-F.col("score"), F.col("_ord"))).alias("m"))

    found = best_of_rounds(left_keys.select(F.col("key").alias("a")), b.select("b"), cutoff, best)
    return found.select(F.col("a").alias("key"), F.col("m.b").alias("candidate"), F.col("m.score").alias("score"), F.col("m._ord").alias("_right_ord"))


def routed(left: DataFrame, right: DataFrame, name: str, payload: Sequence[str], limits: Thresholds = Thresholds()) -> DataFrame:
    """``left`` with one ``status`` a row - matched, review or unmatched - and its hit, label and score.

    The exact cascade goes first; one fuzzy pass over distinct keys of what is left decides
    the rest.
    """
    exact = cascade_keys(left, right, name)
    rest = left.join(exact, "_ord", "left_anti").select(F.col("key_full").alias("key"))
    near = best_fuzzy(rest, right.select(F.col("key_full").alias("key"), "_ord"), limits.cutoff)
    return assembled(left, right, exact, near, name, payload, limits)


def assembled(left: DataFrame, right: DataFrame, exact: DataFrame, near: DataFrame, name: str, payload: Sequence[str], limits: Thresholds = Thresholds()) -> DataFrame:
    """The routed rows from exact hits (of ``cascade_keys``) and fuzzy ones (of ``best_fuzzy``).

    Both give order numbers of the right side, and its payload is joined once at the end.
    """
    near = near.withColumnRenamed("_right_ord", "_near_ord")
    joined = left.join(exact, "_ord", "left").join(near, (F.col("key_full") == F.col("key")) & F.col("stage").isNull(), "left").drop("key")
    found, auto, review = F.col("stage").isNotNull(), F.col("score") >= limits.auto, F.col("score") >= limits.review
    joined = joined.withColumns({
        "status": F.when(found | auto, "matched").when(review, "review").otherwise("unmatched"),
        "match_type": F.when(found, _label(STAGES)).when(auto, "fuzzy_auto"),
        "match_score": F.when(found, F.lit(100.0)).when(auto, F.col("score")),
        "candidate_score": F.when(~found & ~F.coalesce(auto, F.lit(False)) & review, F.col("score")),
        "_right_ord": F.when(found, F.col("_right_ord")).when(auto | review, F.col("_near_ord")),
    }).drop("stage", "score", "_near_ord")
    return joined.join(_payload(right, name, payload, "hit"), "_right_ord", "left").drop("_right_ord")
