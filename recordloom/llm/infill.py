"""Fill-in-middle transformation: a text's middle moves behind its prefix and suffix, between marks.

A unit grammar says how a text falls into units.  It is translated to a zero-width regex, a
lookbehind and a lookahead for the classes of two neighbouring characters, and ``split`` cuts
there, so the pieces are the text, whole.  Everything is a column expression: no shuffle, and a
row's result depends on its own text and id only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Any character, line breaks too.
ANY = r"[\s\S]"


@dataclass(frozen=True)
class Units:
    """How a text falls into units.

    ``pattern`` matches one unit after the other; ``cuts`` has the same as pairs of classes: a
    unit ends between a character of the first and one of the second.
    """

    pattern: str
    cuts: tuple[tuple[str, str], ...]

    @property
    def boundary(self) -> str:
        return "|".join(f"(?<={before})(?={after})" for before, after in self.cuts)


def ended_by(members: str) -> Units:
    """Units up to and with the next character of a class (lines)."""
    return Units(f"[^{members}]*[{members}]|[^{members}]+", ((f"[{members}]", ANY),))


def trailed_by(members: str) -> Units:
    """Units up to and with the next run of a class (words with the blanks after them, sentences)."""
    return Units(f"[^{members}]*[{members}]+|[^{members}]+", ((f"[{members}]", f"[^{members}]"),))


def begun_by(members: str) -> Units:
    """Units that begin with a character of a class (list items, sections)."""
    return Units(f"[{members}][^{members}]*|[^{members}]+", ((ANY, f"[{members}]"),))


def runs(members: str) -> Units:
    """Runs of a class and runs of all else (words and blanks apart)."""
    return Units(f"[{members}]+|[^{members}]+", ((f"[{members}]", f"[^{members}]"), (f"[^{members}]", f"[{members}]")))


LINES = ended_by(r"\n")
WORDS = trailed_by(r"\x20\x09-\x0D")
SENTENCES = trailed_by(".!?")
CHARACTERS = Units(ANY, ((ANY, ANY),))


@dataclass(frozen=True)
class Marks:
    """Texts that stand before prefix, suffix and middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def any(self) -> str:
        return "|".join(rf"\Q{m}\E" for m in (self.prefix, self.suffix, self.middle))


def pieces(text: Column, units: Units) -> Column:
    """The units of a text in order; none for an empty text, of which ``split`` would make one empty piece."""
    return F.when(text != "", F.split(text, units.boundary, -1)).otherwise(F.array().cast("array<string>"))


def fill_in_middle(
    docs: DataFrame, units: Units = LINES, seed: int = 7, rate: int = 100, spm: int = 50, marks: Marks = Marks(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with ``n`` (units), ``form``, ``prefix``, ``middle``, ``suffix`` and ``output``.

    Two cuts between units and the form follow from the sha256 of seed and key: of 100 texts
    ``rate`` are changed, of 100 of those ``spm`` have the suffix before the prefix (``spm``,
    else ``psm``).  ``plain`` are the others, empty texts and those that hold a mark; their three
    parts are null and the output is the text.  Null text counts as empty, a null key as the
    empty text.  Repeated rows and equal keys give equal results for equal texts.  Columns of
    ``docs`` with the names of new ones are replaced, others pass through, whatever their names.
    """
    made = ("n", "form", "prefix", "middle", "suffix", "output")
    kept = [c for c in docs.columns if c not in made]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("said"),
        F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256).alias("hex"),
    )
    number = lambda k: F.conv(F.substring("hex", 8 * k - 7, 8), 16, 10).cast("bigint")
    rows = rows.withColumns({"units": pieces(F.col("said"), units), "h1": number(1), "h2": number(2), "h3": number(3), "h4": number(4)})
    rows = rows.withColumn("n", F.size("units").cast("bigint"))
    first, second = F.pmod("h1", F.col("n") + 1), F.pmod("h2", F.col("n") + 1)
    unchanged = (F.col("said") == "") | F.col("said").rlike(marks.any) | (F.col("h3") % 100 >= rate)
    form = F.when(unchanged, "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm")
    rows = rows.withColumns({"form": form, "low": F.least(first, second).cast("int"), "high": F.greatest(first, second).cast("int")})
    part = lambda start, size: F.when(F.col("form") != "plain", F.array_join(F.slice("units", start, size), ""))
    rows = rows.withColumns({
        "prefix": part(F.lit(1), F.col("low")),
        "middle": part(F.col("low") + 1, F.col("high") - F.col("low")),
        "suffix": part(F.col("high") + 1, F.size("units") - F.col("high")),
    })
    p, s, m = F.lit(marks.prefix), F.lit(marks.suffix), F.lit(marks.middle)
    psm, spm_ = F.concat(p, "prefix", s, "suffix", m, "middle"), F.concat(s, "suffix", p, "prefix", m, "middle")
    output = F.when(F.col("form") == "plain", F.col("said")).when(F.col("form") == "spm", spm_).otherwise(psm)
    return rows.select(*[F.col("row").getField(c).alias(c) for c in kept], "n", "form", "prefix", "middle", "suffix", output.alias("output"))


def restore(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text from its transformed form: the parts between the marks, in their order in the text.

    No part holds a mark, and as no mark ends with the beginning of another, none can form where
    a part and a mark meet.
    """
    part = F.split(output, marks.any, -1)
    swapped = form == "spm"
    first, last = F.when(swapped, part[2]).otherwise(part[1]), F.when(swapped, part[1]).otherwise(part[2])
    return F.when(form == "plain", output).otherwise(F.concat(first, part[3], last))


def report(docs: DataFrame) -> DataFrame:
    """Lengths and digests of every document's output and of the text rebuilt from it."""
    made = fill_in_middle(docs.select("doc_id", "text"))
    made = made.withColumn("restored", restore(F.col("output"), F.col("form")))
    return made.select(
        "doc_id", "n", "form", F.char_length("prefix").cast("bigint").alias("prefix_chars"), F.char_length("middle").cast("bigint").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )
