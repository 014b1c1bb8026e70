"""Values that may be one or several: JSON fields that hold a scalar, a list or nothing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def items(raw: Column) -> Column:
    """A JSON value (as text) as an array of texts; null stays null, a scalar is one item."""
    listed = F.from_json(raw, "array<string>")
    return F.when(raw.startswith("["), listed).when(raw.isNotNull(), F.array(raw))


def first_or_none(raw: Column) -> Column:
    """First item; null for none."""
    return F.get(items(raw), F.lit(0))


def joined(values: Column, separator: str = " | ", null_text: str | None = None) -> Column:
    """Items stripped and joined, blank ones left out; null if nothing is left.

    A null item is left out, or written as ``null_text`` if one is given.
    """
    shown = F.transform(values, lambda v: strip(F.coalesce(v, F.lit(null_text)) if null_text else v))
    return F.nullif(F.array_join(F.filter(shown, lambda v: v != ""), separator), F.lit(""))


def join_list(raw: Column, separator: str = " | ", null_text: str | None = None) -> Column:
    return joined(items(raw), separator, null_text)


def count_items(raw: Column, scalar_length: bool = False) -> Column:
    """Number of items, 0 for none.  ``scalar_length`` counts a scalar's characters instead of 1."""
    one = F.char_length(raw) if scalar_length else F.lit(1)
    return F.when(raw.isNull(), 0).when(raw.startswith("["), F.size(F.from_json(raw, "array<string>"))).otherwise(one)


#: Ways to write "yes".
YES = ("1", "true", "yes", "y", "on")


def flag(text: Column, default: bool = False) -> Column:
    """A written option as true or false; ``default`` where it is missing."""
    return F.coalesce(F.lower(strip(text)).isin(*YES), F.lit(default))


def run_date(given: str | None = None) -> Column:
    """The date of a run as text: the one given, else today."""
    return F.lit(given) if given else F.date_format(F.current_date(), "yyyy-MM-dd")
