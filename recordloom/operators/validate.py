"""Validation as data, and the gate that stops a run."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ValidationError(ValueError):
    pass


def missing_columns(rows: DataFrame, required: Iterable[str]) -> list[str]:
    return [c for c in required if c not in rows.columns]


def require_columns(rows: DataFrame, required: Iterable[str]) -> DataFrame:
    if missing := missing_columns(rows, required):
        raise ValidationError(f"missing columns: {', '.join(missing)}")
    return rows


def count_verdict(counted: Column, expected: Column, strict: bool = True, empty: str = "no rows", differ: str = "count mismatch: expected %d, got %d") -> Column:
    """Message of the first check that fails: emptiness, then the count; null if none does."""
    unequal = F.format_string(differ, expected, counted)
    return F.when(counted == 0, F.lit(empty)).when(F.lit(strict) & ~expected.eqNullSafe(counted), unequal)


def validate(rows: DataFrame, expected: int, strict: bool = True, required: Iterable[str] = ()) -> DataFrame:
    """One row (is_valid, message): emptiness, count, then columns, in this order."""
    problem = count_verdict(F.col("n"), F.lit(expected).cast("long"), strict)
    if missing := missing_columns(rows, required):
        problem = F.coalesce(problem, F.lit(f"missing columns: {', '.join(missing)}"))
    return rows.agg(F.count("*").alias("n")).select(problem.isNull().alias("is_valid"), F.coalesce(problem, F.lit("OK")).alias("message"))


def gate(verdict: DataFrame) -> None:
    """Raise unless the verdict is valid; call before anything is written."""
    row = verdict.first()
    if row is None or not row.is_valid:
        raise ValidationError(row.message if row else "no verdict")
