"""The output tables of a reconciliation, as projections of one routed frame.

``left`` and ``right`` prefix the columns of the two registries.  ``keep_lineage`` off gives
fuzzy rows no identifier of the left side and no lineage of the right side, for
compatibility with consumers that expect those nulls; it is the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import nullify

PAYLOAD = ("inci_name", "substance_id", "cas_no", "function_names", "cosmetic_restriction", "other_restrictions", "identified_ingredient", "status", "source", "ingest_date", "batch_id")
NAMES = ("ingredient_code", "std_name_ko", "std_name_en", "old_name_ko")
DETAILS = ("function_names", "cosmetic_restriction", "other_restrictions", "identified_ingredient")


def _own(keep_lineage: bool) -> Column:
    return F.lit(True) if keep_lineage else F.col("match_type").startswith("exact")


def matched(rows: DataFrame, left: str = "left", right: str = "right", keep_lineage: bool = False) -> DataFrame:
    """22 columns of every matched row."""
    own, hit = _own(keep_lineage), F.col("hit")
    return rows.where("status = 'matched'").select(
        *NAMES, F.when(own, F.col("cas_no")).alias(f"{left}_cas_no"), hit["inci_name"].alias("canonical_inci_name"), hit["substance_id"].alias(f"{right}_substance_id"),
        hit["cas_no"].alias(f"{right}_cas_no"), *[hit[c].alias(c) for c in DETAILS], hit["status"].alias("status"), "match_type", "match_score",
        F.col("source").alias(f"{left}_source"), F.col("ingest_date").alias(f"{left}_ingest_date"), F.col("batch_id").alias(f"{left}_batch_id"),
        *[F.when(own, hit[c]).alias(f"{right}_{c}") for c in ("source", "ingest_date", "batch_id")], "as_of_date",
    )


def review(rows: DataFrame, left: str = "left", right: str = "right", keep_lineage: bool = False) -> DataFrame:
    """16 columns of every row that a person has to decide."""
    hit = F.col("hit")
    cas = F.col("cas_no") if keep_lineage else F.lit(None).cast("string")
    return rows.where("status = 'review'").select(
        *NAMES, cas.alias(f"{left}_cas_no"), hit["inci_name"].alias("candidate_inci_name"), hit["substance_id"].alias(f"{right}_substance_id"), hit["cas_no"].alias(f"{right}_cas_no"),
        "candidate_score", *[hit[c].alias(c) for c in DETAILS], hit["status"].alias("status"), F.lit("pending").alias("review_decision"), F.col("candidate").alias("fuzzy_key_review"),
    )


def unmatched(rows: DataFrame, left: str = "left", keep_lineage: bool = False) -> DataFrame:
    """6 columns of every row that nothing matches."""
    cas = F.col("cas_no") if keep_lineage else F.lit(None).cast("string")
    return rows.where("status = 'unmatched'").select(*NAMES, cas.alias(f"{left}_cas_no"), "as_of_date")


def graph_map(matched_rows: DataFrame) -> DataFrame:
    """The matched columns without lineage: 15 of 22."""
    return matched_rows.select(*[c for c in matched_rows.columns if not c.endswith(("_source", "_ingest_date", "_batch_id", "as_of_date"))])


def summary(rows: DataFrame, right_rows: DataFrame, left: str = "left", right: str = "right", auto: int = 95, least: int = 90, inputs: dict[str, str] | None = None) -> DataFrame:
    """One row of totals; the match rate is null for an empty left side."""
    of = lambda s: F.count(F.when(F.col("status") == s, 1))
    counted = rows.agg(F.count("*").alias(f"{left}_total"), of("matched").alias("matched_final_total"), of("unmatched").alias(f"unmatched_{left}_total"), of("review").alias("fuzzy_review_total"))
    totals = counted.crossJoin(right_rows.agg(F.count("*").alias(f"{right}_total")))  # one row each
    rate = F.round(F.col("matched_final_total") / F.nullif(F.col(f"{left}_total"), F.lit(0)) * 100, 2)
    return totals.select(
        *[F.lit(v).alias(k) for k, v in (inputs or {}).items()], f"{left}_total", f"{right}_total", "matched_final_total", f"unmatched_{left}_total", "fuzzy_review_total",
        rate.alias(f"match_rate_vs_{left}"), F.lit(auto).alias("fuzzy_auto_threshold"), F.lit(least).alias("fuzzy_review_threshold"),
    )


def rendered(rows: DataFrame) -> DataFrame:
    """Every column as text, null for every way to write "no value"."""
    return rows.select(*[nullify(F.col(c)).alias(c) for c in rows.columns])


def with_lineage(rows: DataFrame, source: str, ingest_date: str) -> DataFrame:
    return rows.withColumns({"source": F.lit(source), "ingest_date": F.lit(ingest_date), "batch_id": F.lit(f"{source}_{ingest_date}")})
