"""URL filtering: exact rules, then a Bloom filter cascade of listed domains.

The key universe is every host of the corpus with all its parent domains.  The first
level of the cascade encodes the listed keys; the second encodes the other keys of the
universe that the first lets through; the third the listed keys that the second lets
through, and so on until a level lets nothing wrong through.  Over that universe the
cascade then answers membership exactly, and pages are judged without a join.

The first level lets about as many others through as there are listed keys, every later one a
quarter of what it should stop: with more hashes the levels were fewer, but larger together.

The filters are broadcast.  Their size is foretold from the keys that are listed and the
share of the others that pass by chance: where it would pass ``MOST_BYTES``, the keys are
split by hash into shards with a cascade each, which judge the pages one after the other.

Defined results: a null url, or one without ``://``, has empty host and path.  No rule
fits an empty host, and the method allows it.  Repeated rows repeat their verdict.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialize, mix, ship

ship(__name__)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
MOST_BYTES = 64 << 20
#: Hashes of the first level at least and at most (a key passes by chance with one half to their power), and of later ones.
FIRST, LATER = (1, 10), 2
#: Bits for a key and hash, for filters that are half full.
FULL = 1 / math.log(2)
#: Bits of all levels for each listed key, or each thousandth other one: twice what is expected.
BITS = 30


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def keys_of(host: Column) -> Column:
    """A host and all its parent domains."""
    labels = F.split(host, r"\.", -1)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; ties go to the longer host, then by name."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def spots(hashes: np.ndarray, level: int, size: int, probes: int) -> np.ndarray:
    """Bit positions of 64-bit hashes in a level of ``size`` bits, ``probes`` for each."""
    base = mix(hashes ^ np.uint64((level * 0x9E3779B97F4A7C15 + 1) % 2**64))
    step = mix(base) | np.uint64(1)
    with np.errstate(over="ignore"):
        return (base[:, None] + np.arange(probes, dtype=np.uint64) * step[:, None]) % np.uint64(size)


@dataclass
class Cascade:
    """``levels``: the bits of each level as bytes, with its size in bits and its hashes."""

    levels: list[tuple[np.ndarray, int, int]]

    def passed(self, hashes: np.ndarray, first: int = 0) -> np.ndarray:
        """How many levels in a row let each hash through."""
        out = np.zeros(len(hashes), np.int64)
        alive = np.arange(len(hashes))
        for level, (bits, size, probes) in enumerate(self.levels):
            if not len(alive):
                break
            at = spots(hashes[alive], level, size, probes)
            inside = ((bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(1)
            alive = alive[inside]
            out[alive] = level + 1
        return out

    def listed(self, hashes: np.ndarray) -> np.ndarray:
        return self.passed(hashes) % 2 == 1


def _level(hashed: DataFrame, level: int, n: int, probes: int) -> tuple[np.ndarray, int, int]:
    """A filter of the ``n`` hashes in ``hashed``; the words of its bits are combined on the executors."""
    size = max(64, math.ceil(n * probes * FULL))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(spots(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), level, size, probes))
            word, begin = np.unique(at >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), begin) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(bits.view(np.int64))], names=["word", "bits"])

    rows = hashed.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(-(-size // 64), np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint8), size, probes


def build_cascade(universe: DataFrame, most: int = 64) -> Cascade:
    """From distinct keys: columns ``hash`` (64 bits) and ``listed``."""
    spark = universe.sparkSession
    cascade = Cascade([])
    sizes = universe.agg(F.count_if("listed").alias("listed"), F.count("*").alias("all")).first()
    stops = round(math.log2(max(1, sizes.all - sizes.listed) / max(1, sizes.listed)))
    first = min(max(stops, FIRST[0]), FIRST[1])
    for level in range(most):
        side = F.col("listed") if level % 2 == 0 else ~F.col("listed")
        if level == 0:
            wrong = universe.where(side).select("hash")
        else:
            shared = spark.sparkContext.broadcast(cascade)

            def through(batches, shared=shared, level=level):
                for batch in batches:
                    hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                    yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(shared.value.passed(hashes) == level))], names=["hash"])

            wrong = universe.where(side).select("hash").mapInArrow(through, "hash long")
        n = sizes.listed if level == 0 else wrong.count()
        if n == 0 and level:
            return cascade
        cascade = Cascade([*cascade.levels, _level(wrong, level, n, LATER if level else first)])
    raise ValueError("two keys share a 64-bit hash; no cascade can tell them apart")


def judge_urls(pages: DataFrame, rules: list[Rule], listed: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``listed`` has the blocked domains in ``key``; each covers its subdomains.  Columns of
    ``pages`` with the names of new ones are replaced.
    """
    hosts = pages.select(host_of(F.col(url)).alias("host")).distinct()
    keys = hosts.select(F.explode(keys_of(F.col("host"))).alias("key")).distinct()
    marked = listed.where(F.col("key").isNotNull()).select("key").distinct().withColumn("listed", F.lit(True))
    universe = materialize(keys.join(marked, "key", "left").select("key", F.xxhash64("key").alias("hash"), F.coalesce("listed", F.lit(False)).alias("listed")))
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    # the columns of pages travel as one, so that no name of theirs can clash
    own = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.lit(None).cast("string")
    parts = pages.select(own.alias("own"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    judged = parts.withColumns({"blocked": F.lit(False), "keys": F.transform(keys_of(F.col("host")), lambda k: F.xxhash64(k))})
    sizes = universe.agg(F.count_if("listed").alias("listed"), F.count("*").alias("all")).first()
    shards = max(1, -(-max(sizes.listed, sizes.all // 1000) * BITS // 8 // MOST_BYTES))
    for shard in range(shards):
        mine = universe.where(F.pmod("hash", F.lit(shards)) == shard) if shards > 1 else universe
        shared = pages.sparkSession.sparkContext.broadcast(build_cascade(mine))
        judged = judged.mapInArrow(_members(shared, shard, shards), judged.schema)
        if shard + 1 < shards:
            before, judged = judged, materialize(judged)  # one shard's filters in memory at a time
            discard(before)
    discard(universe)
    other = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(*[F.col(f"own.`{c}`").alias(c) for c in kept], "host", "path", name.alias("rule"), F.coalesce(verdict, other).alias("verdict"))


def _members(shared, shard: int, shards: int):
    """Marks rows with a listed key in this shard; the last two columns are ``blocked`` and ``keys``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            found = shared.value.listed(flat.view(np.uint64)) & (flat % shards == shard)
            hit = np.append(0, np.cumsum(found))
            ends = np.append(0, np.cumsum([0 if x is None else x for x in column.value_lengths().to_pylist()])).astype(np.int64)
            blocked = batch.column(batch.num_columns - 2).to_numpy(zero_copy_only=False) | (hit[ends[1:]] > hit[ends[:-1]])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(blocked), column], schema=batch.schema)

    return run
