"""Pairs of texts that may be alike: every pair that can score the cutoff meets under some key.

An edit (one character inserted or deleted) touches one character.  So if the alphabet is dealt
into two groups more than the edits that a pair may need, the pair agrees in at least two
groups: what is left of both texts without all other characters is the same, in the same
order.  That remainder is the key.  It knows no places, so nothing shifts, and it says as
much as the characters of its groups; these are dealt by how much each tells the texts apart.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.store import landed

#: Groups that a key is made of.
SHARED = 2
#: Most groups of characters, so pairs of up to ``MOST - SHARED`` edits are found by them.
MOST = 24
#: Characters that are dealt by what they tell; all others share a group.
ALPHABET = 256


def edits(m: Column, n: Column, cutoff: int) -> Column:
    """Most insertions and deletions that a pair of these lengths may need; as even or odd as ``m + n``."""
    most = F.floor((m + n) * (100 - cutoff) / 100.0 + 1e-6).cast("int")
    return most - F.pmod(most - m - n, F.lit(2))


#: Bits of a signature: two words.
BITS = 128


def _word(bits: str, which: int) -> Column:
    """One word of 64 bits with those set that a column lists."""
    one = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(k, F.lit(64)).cast("int"))
    # never null, which keeps the optimizer from filtering on it, that is from computing it twice
    return F.coalesce(F.aggregate(F.filter(bits, lambda k: F.floor(k / 64) == which), F.lit(0).cast("bigint"), lambda acc, k: acc.bitwiseOR(one(k))), F.lit(0).cast("bigint"))


def _with_signatures(rows: DataFrame, text: str, to: str) -> DataFrame:
    """``rows`` with a struct ``to``: two words of bits of the text's characters, two of its pairs of characters.

    The second of two equal parts counts as another part.  Parts that differ may share a bit,
    so two signatures differ in no more bits than the texts differ in parts.  Each step is a
    column of its own, so that nothing is computed again for each element.
    """
    letters = F.array_remove(F.split(text, ""), "")
    pairs = F.when(F.char_length(text) > 1, F.transform(F.sequence(F.lit(1), F.char_length(text) - 1), lambda i: F.substring(F.col(text), i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumns({"_l": F.sort_array(letters), "_p": F.sort_array(pairs)})
    bits = lambda c: F.transform(c, lambda x, i: F.pmod(F.xxhash64(x, i + 1 - F.array_position(c, x)), F.lit(BITS)).cast("int"))
    rows = rows.withColumns({"_lb": bits("_l"), "_pb": bits("_p")}).drop("_l", "_p")
    return rows.withColumn(to, F.struct(*[_word(f"_{c}b", k).alias(f"{c}{k}") for c in "lp" for k in (0, 1)])).drop("_lb", "_pb")


def _differing(a: str, b: str, of: str) -> Column:
    return F.bit_count(F.col(f"{a}.{of}0").bitwiseXOR(F.col(f"{b}.{of}0"))) + F.bit_count(F.col(f"{a}.{of}1").bitwiseXOR(F.col(f"{b}.{of}1")))


def survey(texts: DataFrame, text: str) -> tuple[list[tuple[str, float]], int]:
    """Characters with the entropy of how often each stands in a text, most telling first; and the length of the longest text.

    At most ``ALPHABET`` of the 4,096 most frequent characters.  They decide how keys are made,
    never which pairs are found.
    """
    often = F.transform(F.array_distinct("_l"), lambda c: F.struct(c.alias("c"), F.size(F.filter("_l", lambda x: x == c)).alias("k")))
    # each text also stands under no character, which gives their number and lengths
    whole = F.array(F.struct(F.lit("").alias("c"), F.size("_l").alias("k")))
    each = texts.select(F.filter(F.split(text, ""), lambda c: c != "").alias("_l")).select(F.explode(F.concat(whole, often)).alias("e"))
    seen = each.groupBy("e.c", "e.k").agg(F.count("*").alias("v")).groupBy("c").agg(F.sum("v").alias("n"), F.sum(F.col("v") * F.log("v")).alias("s"), F.max("k").alias("k"))
    rows = seen.orderBy(F.desc("n"), "c").limit(4097).collect()
    total, longest = next(((r.n, r.k) for r in rows if not r.c), (0, 0))
    of = lambda r: math.log(total) - (r.s + (total - r.n) * math.log(max(total - r.n, 1))) / total
    # characters of two units in Java's texts stay with the others
    told = [(r.c, of(r)) for r in rows if r.c and ord(r.c) < 0x10000]
    return sorted((x for x in told if x[1] > 1e-9), key=lambda x: (-x[1], x[0]))[:ALPHABET], longest


def deal(letters: list[tuple[str, float]], groups: int) -> list[str]:
    """Characters in groups that tell about the same."""
    out, load = [""] * groups, [0.0] * groups
    for c, weight in letters:
        g = load.index(min(load))
        out[g] += c
        load[g] += weight
    return out


def _projections(letters: list[tuple[str, float]], most: int) -> list[tuple[int, int, str, bool]]:
    """For each number of edits all ways to choose ``SHARED`` groups: (edits, number, characters that go, whether all others stay)."""
    out = []
    for d in range(most + 1):
        groups = deal(letters, d + SHARED)
        for nth, kept in enumerate(combinations(range(d + SHARED), SHARED)):
            out.append((d, nth, "".join(g for k, g in enumerate(groups) if k not in kept), d + SHARED - 1 in kept))
    return out


def _partners(length: str, cutoff: int) -> tuple[Column, Column]:
    share, n = (100 - cutoff) / 100.0, F.col(length)
    return F.ceil(n * (1 - share) / (1 + share) - 1e-6).cast("int"), F.floor(n * (1 + share) / (1 - share) + 1e-6).cast("int")


def keyed_sides(left: DataFrame, right: DataFrame, cutoff: int, most: int, letters: list[tuple[str, float]]) -> tuple[DataFrame, DataFrame]:
    """Both sides with a row for each ``key``: edits and lengths of a pair, number of the projection, and what it leaves of the text.

    For texts of ``left`` (a, m) and ``right`` (b, n) that need at most ``most`` edits.
    """
    ways = F.broadcast(left.sparkSession.createDataFrame(_projections(letters, most), "d int, nth int, gone string, others boolean"))
    known = "".join(rf"\x{{{ord(c):x}}}" for c, _ in letters)
    plain = lambda text: F.regexp_replace(text, f"[^{known}]", "") if known else F.lit("")
    left_over = "translate(if(others, text, plain), gone, '')"

    low, high = _partners("n", cutoff)
    budget = lambda m: edits(m, F.col("n"), cutoff)
    fits = lambda m: (budget(m) >= F.abs(m - F.col("n"))) & (budget(m) <= most)
    shown = right.withColumns({"text": F.col("b"), "plain": plain("b"), "d": F.explode(F.array_distinct(F.transform(F.filter(F.sequence(low, high), fits), budget)))})
    shown = shown.join(ways, "d").withColumn("key", F.xxhash64("d", "n", "nth", F.expr(left_over)))

    low, high = _partners("m", cutoff)
    lengths = right.select("n").distinct()
    probes = left.withColumns({"text": F.col("a"), "plain": plain("a"), "n": F.explode(F.sequence(low, high))}).join(F.broadcast(lengths), "n")
    probes = probes.withColumn("d", edits(F.col("m"), F.col("n"), cutoff)).where((F.col("d") >= F.abs(F.col("m") - F.col("n"))) & (F.col("d") <= most))
    probes = probes.join(ways, "d").withColumn("key", F.xxhash64("d", "n", "nth", F.expr(left_over)))
    return probes.select("a", "sa", "d", "key"), shown.select("b", "sb", "key")


def _piece_sides(left: DataFrame, right: DataFrame, cutoff: int, above: int) -> tuple[DataFrame, DataFrame]:
    """Keys for pairs of more than ``above`` edits: pieces of long texts, near their places.

    For every length of a partner a right text is cut into one piece more than the edits that
    the pair may need, so the partner holds at least one piece unchanged (pigeonhole).
    """
    pieces = lambda m, n: F.least(edits(m, n, cutoff) + 1, n)
    begin = lambda i: F.floor(F.col("n") * i / F.col("p")).cast("int")  # noqa: E731  where piece i begins
    key = lambda piece: F.xxhash64("n", "p", "i", piece)
    start, end = begin(F.col("i")), begin(F.col("i") + 1)
    numbers = F.explode(F.sequence(F.lit(0), F.col("p") - 1)).alias("i")

    low, high = _partners("n", cutoff)
    many = F.filter(F.sequence(low, high), lambda m: edits(m, F.col("n"), cutoff) > above)
    parts = F.array_distinct(F.transform(many, lambda m: pieces(m, F.col("n"))))
    shown = right.select("b", "sb", "n", F.explode(parts).alias("p")).select("*", numbers)
    shown = shown.select("b", "sb", key(F.substring(F.col("b"), start + 1, end - start)).alias("key"))

    low, high = _partners("m", cutoff)
    probes = left.select("a", "sa", "m", F.explode(F.sequence(low, high)).alias("n")).join(F.broadcast(right.select("n").distinct()), "n")
    probes = probes.withColumns({"d": edits(F.col("m"), F.col("n"), cutoff), "p": pieces(F.col("m"), F.col("n"))}).where(F.col("d") > above).select("*", numbers)
    # places shift by the insertions less the deletions before the piece
    first = F.greatest(start - F.floor((F.col("d") - (F.col("m") - F.col("n"))) / 2).cast("int"), F.lit(0))
    last = F.least(start + F.floor((F.col("d") + (F.col("m") - F.col("n"))) / 2).cast("int"), F.col("m") - (end - start))
    probes = probes.withColumns({"low": first, "high": last, "size": end - start}).where("low <= high")
    stretches = F.array_distinct(F.transform(F.sequence("low", "high"), lambda at: F.substring(F.col("a"), at + 1, F.col("size"))))
    probes = probes.select("a", "sa", "d", "n", "p", "i", F.explode(stretches).alias("piece")).select("a", "sa", "d", key(F.col("piece")).alias("key"))
    return probes, shown


def signed(texts: DataFrame, text: str) -> DataFrame:
    """Distinct texts that are not empty, with their length (``m`` of ``a``, ``n`` of ``b``) and signature (``sa``, ``sb``)."""
    to = {"a": "m", "b": "n"}[text]
    # lengths are aggregates: conditions on them stay above the exchange and do not repeat what made the texts
    size = texts.groupBy(text).agg(F.max(F.char_length(text)).alias(to)).where(F.col(to) > 0)
    return _with_signatures(size, text, f"s{text}")


def _check(cutoff: int) -> None:
    if not 50 < cutoff <= 100:
        raise ValueError("the cutoff must lie above 50, up to 100")


def sides(left: DataFrame, right: DataFrame, cutoff: int) -> list[tuple[DataFrame, DataFrame]]:
    """Keyed probes (a, sa, d, key) and texts (b, sb, key) that meet on ``key``: by projections, and by pieces where there are texts too long for these."""
    _check(cutoff)
    return signed_sides(signed(left, "a"), signed(right, "b"), cutoff, *survey(right, "b"))


def signed_sides(a: DataFrame, b: DataFrame, cutoff: int, letters: list[tuple[str, float]], longest: int) -> list[tuple[DataFrame, DataFrame]]:
    """``sides`` of texts as ``signed`` gives them, with the ``survey`` of the right ones."""
    # groups that hold no telling character would let everything through
    most = max(min(MOST, len(letters)) - SHARED, 0)
    out = [keyed_sides(a, b, cutoff, most, letters)]
    share = (100 - cutoff) / 100
    partner = math.floor(longest * (1 + share) / (1 - share) + 1e-6)
    if math.floor((longest + partner) * share + 1e-6) > most:
        out.append(_piece_sides(a, b, cutoff, most))
    return out


def candidate_pairs(left: DataFrame, right: DataFrame, cutoff: int) -> DataFrame:
    """Pairs (a, b) of distinct texts that can score ``cutoff`` or more; none that can is missing.

    Texts that share a key must also pass two bounds inside the join, on signatures: an edit
    changes one character of the text and at most three pairs of characters.
    """
    return _near_pairs(sides(left, right, cutoff))


def _near_pairs(both: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    out = None
    for probes, shown in both:
        near = (_differing("sa", "sb", "l") <= F.col("d")) & (_differing("sa", "sb", "p") <= 3 * F.col("d"))
        met = probes.join(shown, (probes["key"] == shown["key"]) & near).select("a", "b")
        out = met if out is None else out.unionByName(met)
    return out.distinct()


#: Up to this many pairs of texts one round takes less than three.
FEW = 1 << 27


def rounds(cutoff: int) -> list[int]:
    """Cutoffs that fall to the one asked for, by thirds of the way from 100."""
    return sorted({100 - (100 - cutoff) * k // 3 for k in (1, 2, 3)}, reverse=True)


def best_of_rounds(left: DataFrame, right: DataFrame, cutoff: int, best: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """The rows that ``best`` makes of candidate pairs (a, b) and a cutoff, one at most for each text ``a``, in rounds of falling cutoffs.

    A text that has a partner under a high cutoff has its best one there, since all pairs that
    reach the cutoff are candidates.  Only texts without one go on, so the many pairs that barely
    reach the last cutoff are made for few texts.  Small sides go in one round.  Both sides and each round's rows are written once.
    """
    _check(cutoff)
    # few rows that become many: written in as many files as there are shuffle partitions, not in the one that their bytes would fill
    wide = lambda rows: landed(rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    a, b = wide(signed(left, "a")), wide(signed(right, "b"))
    told, out = survey(b, "b"), None
    for at in rounds(cutoff) if a.count() * b.count() > FEW else [cutoff]:
        found = landed(best(_near_pairs(signed_sides(a, b, at, *told)), at))
        out = found if out is None else out.unionByName(found)
        if at > cutoff:
            a = wide(a.join(found.select("a"), "a", "left_anti"))
    return out


def comparisons(left: DataFrame, right: DataFrame, cutoff: int) -> DataFrame:
    """For each key that both sides have, the pairs that meet under it, before any bound."""
    out = None
    for probes, shown in sides(left, right, cutoff):
        both = probes.groupBy("key").agg(F.count("*").alias("na")).join(shown.groupBy("key").agg(F.count("*").alias("nb")), "key")
        met = both.select("key", (F.col("na") * F.col("nb")).alias("pairs"))
        out = met if out is None else out.unionByName(met)
    return out
