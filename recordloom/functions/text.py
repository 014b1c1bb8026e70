"""Column expressions for cleaning text and deriving match keys.

Null stands for missing everywhere: cleaning gives null instead of empty text, and a null
key matches nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python sees it: Java's Unicode class and the four separators it leaves out.
WS = r"(?U)[\s\x1c-\x1f]"

#: Text that means "no value" once stripped and lower-cased.
NULL_LIKE = ("", "-", "--", "nan", "none", "null")

#: Tokens that a CSV reader takes for a missing value, compared exactly.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

#: Whole names with another accepted spelling.
ALIASES: Mapping[str, str] = {"NIACINAMIDE": "NICOTINAMIDE"}


def strip(text: Column) -> Column:
    """Without white space at both ends (Unicode, unlike ``trim``)."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def squeeze(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, f"{WS}+", " "))


def clean(text: Column) -> Column:
    """Stripped; null if nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def na_to_null(text: Column) -> Column:
    """Null for the exact tokens that CSV readers take for missing."""
    return F.when(~text.isin(*NA_TOKENS), text)


def nullify(value: Column) -> Column:
    """As text, stripped; null if it is a way to write "no value"."""
    text = strip(value.cast("string"))
    return F.when(~F.lower(text).isin(*NULL_LIKE), text)


def nfkc(text: Column) -> Column:
    """Unicode compatibility form, by the Unicode library that Spark's collations use; ASCII text is left as it is."""
    folded = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))
    return F.when(text.rlike(r"^\p{ASCII}*$") | text.isNull(), text).otherwise(folded)


def apply_alias(name: Column, aliases: Mapping[str, str] = ALIASES) -> Column:
    """A whole name in its accepted spelling; other names stripped."""
    out, upper = strip(name), F.upper(strip(name))
    for known, accepted in aliases.items():
        out = F.when(upper == known.upper(), F.lit(accepted)).otherwise(out)
    return out


def basic(name: Column, aliases: Mapping[str, str] = ALIASES, fold: bool = True) -> Column:
    """Alias, compatibility form, lower case, single spaces.  ``fold`` off skips the compatibility form."""
    text = apply_alias(name, aliases)
    return F.nullif(squeeze(F.lower(nfkc(text) if fold else text)), F.lit(""))


def without_parentheses(text: Column) -> Column:
    return squeeze(F.regexp_replace(text, r"(?s)\(.*?\)", ""))


def without_separators(text: Column) -> Column:
    return squeeze(F.regexp_replace(text, r"[/,\-]+", " "))


def full(basic_key: Column) -> Column:
    """From the basic key: no parentheses, separators as spaces."""
    return F.nullif(without_separators(without_parentheses(basic_key)), F.lit(""))


#: Leading marks of a name that the next key leaves out, in this order.
LEADING = (r"^\(?[+\-]\)?\s*", r"(?i)^\(?dl\)?\s*[-]?\s*", r"(?i)^\(?[drls]\)?\s*[-]?\s*")


def paren_removed(basic_key: Column, strict_leading: bool = False) -> Column:
    """From the basic key: leading signs and letters of chirality go, then parentheses, quotes, dots and separators.

    By default one leading d, r, l or s goes from any name.  ``strict_leading`` asks for a
    bracket or hyphen after it.
    """
    text = basic_key
    steps = (LEADING[0], r"(?i)^(?:\(dl\)\s*-?|dl-)\s*", r"(?i)^(?:\([drls]\)\s*-?|[drls]-)\s*") if strict_leading else LEADING
    for pattern in steps:
        text = F.regexp_replace(text, pattern, "")
    text = F.regexp_replace(without_parentheses(text), "[\"'`.]", " ")
    return F.nullif(without_separators(F.regexp_replace(text, "&+", " and ")), F.lit(""))


def word_sorted(full_key: Column) -> Column:
    """Words of the full key in code-point order."""
    return F.array_join(F.array_sort(F.split(full_key, " ")), " ")


def word_sorted_strict(paren_key: Column) -> Column:
    """Words of the parenthesis-free key without "and", in code-point order."""
    words = F.filter(F.split(paren_key, r"[\s/,\-]+"), lambda w: (w != "and") & (w != ""))
    return F.nullif(F.array_join(F.array_sort(words), " "), F.lit(""))


def identifier(text: Column) -> Column:
    """A registry number without its label and white space; null if there is none."""
    bare = strip(F.replace(F.replace(strip(text), F.lit("CAS No."), F.lit("")), F.lit("CAS No"), F.lit("")))
    return F.regexp_replace(F.when(~F.lower(bare).isin(*NULL_LIKE), bare), f"{WS}+", "")


#: How a page states the number of its results.
TOTALS = (r"총\s*([0-9,]+)\s*건", r"(?:검색결과|결과)\s*([0-9,]+)\s*건")


def total_count(text: Column) -> Column:
    """The number of results a page states; null if it states none."""
    first, second = (F.regexp_extract(text, pattern, 1) for pattern in TOTALS)
    return F.replace(F.when(first != "", first).otherwise(second), F.lit(","), F.lit("")).try_cast("bigint")


def as_of_date(cells: Column, first: int = 6) -> Column:
    """The first cell from the sixth on that holds a date, dots written as hyphens; the whole cell."""
    rest = F.slice(cells, first, F.greatest(F.size(cells), F.lit(1)))
    return F.replace(F.get(F.filter(rest, lambda c: c.rlike(r"\d{4}[-.]\d{2}[-.]\d{2}")), F.lit(0)), F.lit("."), F.lit("-"))
