"""Indel similarity of two texts: (1 - D / (m + n)) * 100, where D = m + n - 2 * LCS."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Cells of a table of partial results that are held at once.
CELLS = 1 << 21


def _codes(texts: list[str], blank: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts, one row each, filled up with ``blank``; and the lengths."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.full((len(texts), int(size.max(initial=0))), blank, np.int32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
    return out, size


#: Characters of a text whose row of the table is one word.
WORD = 64


def _word_lengths(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Lengths for codes of texts of at most ``WORD`` characters: a row of the table is a word of bits, a zero where it grows."""
    if max(left.max(initial=0), right.max(initial=0)) < 254:  # most texts; a byte a character compares faster
        left, right = left.astype(np.uint8), right.astype(np.uint8)  # blanks become 255 and 254
    right = np.ascontiguousarray(right.T)
    row, met = np.full(len(left), ~np.uint64(0)), np.zeros((len(left), WORD), bool)
    for letters in right:
        np.equal(left, letters[:, None], out=met[:, : left.shape[1]])
        same = row & np.packbits(met, axis=1, bitorder="little").view("<u8")[:, 0]
        row = (row + same) | (row - same)
    return np.bitwise_count(~row).astype(np.int64)


def common_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs of texts, all pairs of a block in step.

    Of long texts a row of the usual table grows along it, so a running maximum gives the next one whole.
    """
    out = np.zeros(len(a), np.int64)
    long = np.fromiter(map(len, a), np.int64, len(a))
    order, at = np.argsort(long, kind="stable"), 0
    while at < len(order):
        # texts of about one length together, so that little is filled up
        block = order[at : at + max(1, CELLS // max(1, int(long[order[-1]])))]
        block = block[long[block] <= 2 * long[block[0]] + 8]
        at += len(block)
        left, size = _codes([a[k] for k in block], -1)
        right, _ = _codes([b[k] for k in block], -2)
        if left.shape[1] <= WORD:
            out[block] = _word_lengths(left, right)
            continue
        row = np.zeros((len(block), left.shape[1] + 1), np.int32)
        for j in range(right.shape[1]):
            met = row[:, :-1] + (left == right[:, j, None])
            np.maximum(row[:, 1:], met, out=row[:, 1:])
            np.maximum.accumulate(row, axis=1, out=row)
        out[block] = row[:, -1]
    return out


def indel_similarities(a: list[str], b: list[str]) -> np.ndarray:
    both = np.fromiter(map(len, a), np.int64, len(a)) + np.fromiter(map(len, b), np.int64, len(b))
    return np.where(both > 0, (1 - (both - 2 * common_lengths(a, b)) / np.maximum(both, 1)) * 100, 100.0)


def indel_similarity(a: str, b: str) -> float:
    return float(indel_similarities([a], [b])[0])


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Arrow-batched score of two columns; null if either is null."""
    known = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), np.nan)
    out[known] = indel_similarities(a[known].tolist(), b[known].tolist())
    return pd.Series(out).where(known, None).astype("Float64")


#: Places of a text in a word: with carries a sum of two words still fits 64 bits, signed.
BITS = 62


def places(text: Column) -> Column:
    """For each character of a text the places where it stands, as words of ``BITS`` bits; made once a text, for many pairs."""
    letters = F.filter(F.split(text, ""), lambda c: c != "")

    def words(c: Column, all_letters: Column) -> Column:
        spots = F.filter(F.sequence(F.lit(0), F.size(all_letters) - 1), lambda j: F.get(all_letters, j) == c)
        bit = lambda j: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(j, F.lit(BITS)))
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_letters) - 1) / BITS).cast("int")),
            lambda w: F.aggregate(F.filter(spots, lambda j: F.floor(j / BITS) == w), F.lit(0).cast("bigint"), lambda acc, j: acc.bitwiseOR(bit(j))),
        )

    entries = F.transform(F.array_distinct(letters), lambda c: F.struct(c.alias("key"), words(c, letters).alias("value")))
    return F.when(F.size(letters) > 0, F.map_from_entries(entries)).otherwise(F.create_map().cast("map<string,array<bigint>>"))


def common_length(a: Column, b: Column, spots: Column) -> Column:
    """Length of the longest common subsequence, with ``spots`` as ``places(b)`` gives them.

    A row of the usual table is a word of bits, a zero where it grows; each character of ``a``
    turns one row into the next by an addition, whose carries run along the words.
    """
    n = F.char_length(b)
    full = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.greatest(F.least(k, F.lit(BITS)), F.lit(0))) - 1
    letters = F.filter(F.split(a, ""), lambda c: c != "")
    zeros = lambda row, k: F.least(k, F.lit(BITS)) - F.bit_count(row)

    def step(row: Column, met: Column, most: Column) -> Column:
        same = row.bitwiseAND(met)
        return (row + same).bitwiseOR(row - same).bitwiseAND(most)

    one = F.aggregate(letters, full(n), lambda row, c: F.coalesce(step(row, F.get(F.try_element_at(spots, c), F.lit(0)), full(n)), row))

    # several words: (words so far, carry) along each row
    size = lambda w: n - w * BITS
    numbers = F.sequence(F.lit(0), F.floor((n - 1) / BITS).cast("int"))
    start = F.transform(numbers, lambda w: full(size(w)))

    def row_after(row: Column, c: Column) -> Column:
        met = F.try_element_at(spots, c)

        def word(acc: Column, w: Column) -> Column:
            old = F.get(row, w)
            same = old.bitwiseAND(F.get(met, w))
            total = old + same + acc["carry"]
            new = total.bitwiseOR(old - same).bitwiseAND(full(size(w)))
            return F.struct(F.concat(acc["row"], F.array(new)).alias("row"), F.shiftright(total, BITS).alias("carry"))

        none = F.struct(F.array().cast("array<bigint>").alias("row"), F.lit(0).cast("bigint").alias("carry"))
        return F.when(met.isNull(), row).otherwise(F.aggregate(numbers, none, word, lambda acc: acc["row"]))

    rows = F.aggregate(letters, start, row_after)
    many = F.aggregate(F.transform(rows, lambda x, w: zeros(x, size(w))), F.lit(0), lambda acc, x: acc + x)
    return F.when(n == 0, 0).when(n <= BITS, zeros(one, n)).otherwise(many)


def similarity_of(a: Column, b: Column, spots: Column) -> Column:
    """The score of two texts inside the JVM, with ``spots`` as ``places(b)`` gives them; null if either is null."""
    both = (F.char_length(a) + F.char_length(b)).cast("double")
    return F.when(both > 0, (1 - (both - 2 * common_length(a, b, spots)) / both) * 100).when(both == 0, 100.0)
