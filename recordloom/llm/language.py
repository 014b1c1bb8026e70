"""Language identification by cross-parsing entropy.

Labelled text of each language becomes a suffix automaton.  A document is parsed
greedily against each automaton into the longest phrases that occur in that
language's text; a byte that does not occur there is a phrase of its own.  A phrase
costs log2 of the reference's length, and the language that needs the fewest such
normalised phrases wins.  The transitions of all automata lie in one open hash table, and
numpy walks all segments of a batch at once, one byte of each per step.

Only letters count: texts are parsed with A-Z lower-cased, runs of other ASCII as one space.
Documents are parsed in segments of ``SEGMENT`` bytes, all of them; a phrase ends with
its segment, alike for every language.  A row's result depends on its own text alone.

Bounds (parameters of ``Training``): rows of a language are taken in the order of a hash of
doc_id and text, each of them whole, until they hold ``enough`` bytes or are ``docs`` rows; a
language whose rows all miss the sample gives its lowest row.

Defined results: text that is null or has no letter gives ``und`` and score 0; so does
every text when nothing can be learned.  The score is the winner's share of
2 ** -(code length) over all languages; ties go to the language that sorts first.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, ship, utf8

ship(__name__)

SEGMENT = 512


@dataclass(frozen=True)
class Training:
    docs: int = 48
    enough: int = 24_000


def spoken(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What texts say: A-Z lower-cased, other ASCII than letters as spaces, runs of spaces as one."""
    data = SPOKEN[data[at[0] : at[-1]]]
    keep = data != 32
    keep[1:] |= data[:-1] != 32
    begin = at[:-1][np.diff(at) > 0] - at[0]
    keep[begin] = True  # a row's first byte stays, whatever row is before it
    return data[keep], np.append(0, np.cumsum(keep))[at - at[0]]


SPOKEN = np.array([b + 32 if 65 <= b < 91 else b if b >= 128 or 97 <= b < 123 else 32 for b in range(256)], np.uint8)


def automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the root."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = clone
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
        last = new
    return moves


class CrossParser:
    """The automata of several reference texts; ``keys`` and ``moves`` are a hash table of their transitions.

    A key is a state's number times ``wide`` plus the code of a byte.  States of all
    references are numbered through; a reference's root comes first.
    """

    SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, references: list[bytes]) -> None:
        alphabet = sorted({b for r in references for b in r})
        self.code = np.full(256, len(alphabet), np.int64)
        self.code[alphabet] = np.arange(len(alphabet))
        self.wide = len(alphabet) + 1
        roots, keys, moves, base = [], [], [], 0
        for reference in references:
            steps = automaton(reference)
            state = np.repeat(np.arange(len(steps)), [len(m) for m in steps])
            keys.append((base + state) * self.wide + self.code[[c for m in steps for c in m]])
            moves.append(base + np.array([t for m in steps for t in m.values()], np.int64))
            roots.append(base)
            base += len(steps)
        self.roots = np.array(roots, np.int64)
        self._fill(np.concatenate(keys), np.concatenate(moves))
        #: where a phrase that begins with a byte leads; -1 if the reference does not have the byte
        self.first = np.stack([self._next(r * self.wide + np.arange(self.wide)) for r in roots])

    def _fill(self, keys: np.ndarray, moves: np.ndarray) -> None:
        size = 1 << max(4, int(2.5 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - size.bit_length() + 1), size - 1
        self.keys, self.moves = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        spot, left = self._spot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[spot[left]] < 0]
            self.keys[spot[free]], self.moves[spot[free]] = keys[free], moves[free]
            left = left[self.keys[spot[left]] != keys[left]]  # of those that meet, one stays
            spot[left] = (spot[left] + 1) & self.last

    def _spot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * self.SPREAD >> self.shift).astype(np.int64)

    def _next(self, keys: np.ndarray) -> np.ndarray:
        """The state that each transition leads to, -1 where there is none."""
        spot = self._spot(keys)
        found = self.keys[spot]
        out = np.where(found == keys, self.moves[spot], -1)
        left = np.flatnonzero((found != keys) & (found >= 0))
        while len(left):
            spot[left] = (spot[left] + 1) & self.last
            found = self.keys[spot[left]]
            hit = found == keys[left]
            out[left[hit]] = self.moves[spot[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out

    def phrases(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Phrases of each document under each reference."""
        size = np.diff(at)
        parts = np.maximum(-(-size // SEGMENT), 1)
        owner = np.repeat(np.arange(len(size)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = at[:-1][owner] + nth * SEGMENT
        long = np.minimum(at[1:][owner] - begin, SEGMENT)
        order = np.argsort(-long, kind="stable")
        owner, begin, long = owner[order], begin[order], long[order]
        active = np.searchsorted(-long, -np.arange(SEGMENT), "left")  # segments longer than t
        codes = self.code[data] if len(data) else np.zeros(0, np.int64)
        out = np.zeros((len(size), len(self.roots)))
        for k, root in enumerate(self.roots.tolist()):
            state, count = np.full(len(owner), root), np.zeros(len(owner), np.int64)
            for t in range(SEGMENT):
                m = active[t]
                if not m:
                    break
                code, now = codes[begin[:m] + t], state[:m]
                then = self._next(now * self.wide + code)
                stop = np.flatnonzero(then < 0)
                if len(stop):
                    fresh = self.first[k][code[stop]]
                    # the phrase so far ends, and a byte that the reference does not have is one of its own
                    count[stop] += (now[stop] != root).astype(np.int64) + (fresh < 0)
                    then[stop] = np.where(fresh < 0, root, fresh)
                state[:m] = then
            out[:, k] = np.bincount(owner, count + (state != root), minlength=len(size))
        return out


@dataclass(frozen=True)
class Languages:
    names: tuple[str, ...]
    references: tuple[bytes, ...]


def learn(docs: DataFrame, usable, how: Training = Training()) -> Languages:
    """Reference texts from the rows that ``usable`` (a condition) admits."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & usable)
    place = F.xxhash64("doc_id", "text")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Languages((), ())

    def near(lang: str, n: int):
        edge = min(int(min(1.0, 3.0 * how.docs / n) * 2**64) - 2**63, 2**63 - 1)
        return (F.col("lang") == lang) & (place <= edge)

    fields = [place.alias("at"), "doc_id", F.encode("text", "utf-8").alias("text")]
    some = rows.where(reduce(lambda a, b: a | b, (near(k, n) for k, n in sorted(counts.items())))).select("lang", *fields)
    kept = some.dropDuplicates(["lang", "at"]).collect()
    missed = sorted(counts.keys() - {r["lang"] for r in kept})
    if missed:
        lowest = rows.where(F.col("lang").isin(missed)).select("lang", F.struct(*fields).alias("row"))
        kept += lowest.groupBy("lang").agg(F.min("row").alias("row")).select("lang", "row.*").collect()
    found: dict[str, list[bytes]] = {}
    for r in sorted(kept, key=lambda r: (r["lang"], r["at"])):
        taken = found.setdefault(r["lang"], [])
        if len(taken) < how.docs and sum(map(len, taken)) < how.enough:
            taken.append(bytes(r["text"]))
    names = tuple(k for k in sorted(found) if any(found[k]))
    joined = [np.frombuffer(b"\n".join(found[k]), np.uint8) for k in names]
    return Languages(names, tuple(spoken(t, np.array([0, len(t)]))[0].tobytes() for t in joined))


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


def identify(docs: DataFrame, languages: Languages) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    parser = CrossParser(list(languages.references)) if languages.names else None
    shared = docs.sparkSession.sparkContext.broadcast((languages.names, parser, np.log2([max(2, len(r)) for r in languages.references])))

    def make():
        known, parser, cost = shared.value

        def compute(column: pa.Array) -> list[pa.Array]:
            written = [any(map(str.isalpha, t or "")) for t in column.to_pylist()]
            if parser is None:
                return [pa.array(["und"] * len(written), pa.string()), pa.array(np.zeros(len(written)), pa.float64())]
            bits = parser.phrases(*spoken(*utf8(column))) * cost
            best = bits.argmin(1)
            share = 1 / np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000)).sum(1)
            names = [known[b] if w else "und" for b, w in zip(best.tolist(), written)]
            return [pa.array(names, pa.string()), pa.array(np.where(np.array(written, bool), share, 0.0), pa.float64())]

        return compute

    return append_columns(docs, make, FIELDS)
