"""N-gram Jaccard join of documents by multiple-global-order filtering.

A document's set holds the 64-bit hashes of its distinct word n-grams.  Equal sets form a
class; classes are joined, copies are only members.  Two sets link when
``den * intersection >= num * union``.

1. Under a first order, by hash, each class shows a prefix long enough that two linked
   classes share several tokens in it.  A class that shares too few of its prefix tokens
   with other classes leaves.
2. Under orders that put rare tokens first, with different orders among equally rare
   ones, linked classes share a token of their prefixes under every order.  Candidates
   come from the first of these, must also share a prefix token under the others, and
   pass the bound on sizes.
3. Candidates that pass are verified on their whole sets.

A token that many classes show does not give all pairs.  Its classes are first paired with
one pivot, the most central of them; verified links join into components, and classes that
are in one component already need no link between them.  ``PIVOTS`` other pivots follow for
tokens that still show several components; what is left after that is paired across
components.  The places of the shared token bound the overlap of every pair, and in the last
turn so do sketches: each bit says whether an odd number of a class's tokens falls on it, so two
classes differ in at least as many tokens as their sketches differ in bits.  No pair that can
link is dropped, so the components are exact.

Defined results: null or blank text has an empty set, links with nothing and is its own
component.  Fewer words than ``width`` make one n-gram.  Repeated rows and copies get the
same component.  A null doc_id takes part and never names a component unless all members
are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import block_count, deal, text_bytes
from .common import WordHash, discard, materialize, mix, ship, slices, texts, tidy, utf8

ship(__name__)

PIVOTS = 4
MOST_BYTES = 32 << 20
SKETCH = 16  # words of 64 bits
NOWHERE = -(2**63)  # stands for a null doc_id in joins


@dataclass(frozen=True)
class Link:
    """Width of the n-grams and the least Jaccard similarity as ``num / den``."""

    width: int = 4
    num: int = 85
    den: int = 100

    def least(self, n):
        """Tokens that a set of ``n`` shares at least with a linked one."""
        return -(-self.num * n // self.den)

    def several(self, n):
        """Tokens asked for in the first prefix: a tenth of the set, rounded up."""
        return -(-n // 10)

    def first_prefix(self, n):
        return n - self.least(n) + self.several(n)


def gram_sets(documents: list[bytes], width: int, words: WordHash) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text (A-Z lower-cased)."""
    out = []
    salt = [np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 % 2**64) for k in range(width)]
    for text in documents:
        said = text.lower().split()
        if not said:
            out.append(np.zeros(0, np.uint64))
            continue
        h = words.of(said)
        k = min(width, len(h))
        grams = np.full(len(h) - k + 1, k, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(k):
                grams = mix(grams ^ (h[j : len(h) - k + 1 + j] + salt[j]))
        out.append(np.unique(grams))
    return out


def key_of(name: bytes) -> int:
    """A class's name as a signed 64-bit number."""
    return int.from_bytes(name[:8], "little", signed=True)


def signatures(docs: DataFrame, link: Link) -> DataFrame:
    """doc_id, ``n`` (set size), ``cls`` (16 bytes naming the set) and ``key`` (8 of them) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        words = WordHash()
        for batch in batches:
            _, at = utf8(batch.column(1))
            for a, b in slices(at, 4 << 20):
                sets = gram_sets(texts(batch.column(1).slice(a, b - a)), link.width, words)
                names = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), pa.array([key_of(x) for x in names], pa.int64())], names=["doc_id", "n", "cls", "key"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(tidy(run), T.StructType([rows.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("cls", T.BinaryType()), T.StructField("key", T.LongType())]))


def shared_counts(docs: DataFrame, link: Link) -> DataFrame:
    """``key`` (64 bits of a class) and how many tokens of its first prefix other classes show too.

    A token that several classes of one batch show is known to be shared there and is sent
    once, without them; a token is thus sent at most once a batch, however frequent it is.
    """
    blocks = block_count(docs.sparkSession, text_bytes(docs))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        words = WordHash()
        for batch in batches:
            _, at = utf8(batch.column(0))
            for a, b in slices(at, 16 << 20):
                tokens, keys = [], []
                seen = set()
                for s in gram_sets(texts(batch.column(0).slice(a, b - a)), link.width, words):
                    if not len(s):
                        continue
                    key = key_of(xxhash.xxh3_128_digest(s.tobytes()))
                    if key in seen:
                        continue
                    seen.add(key)
                    tokens.append(s[: link.first_prefix(len(s))])
                    keys.append(np.full(len(tokens[-1]), key, np.int64).view(np.uint64))
                if not tokens:
                    continue
                token, key = np.concatenate(tokens), np.concatenate(keys)
                order = np.argsort(token, kind="stable")
                token, key = token[order], key[order]
                fresh = np.append(True, token[1:] != token[:-1])
                group = np.cumsum(fresh) - 1
                several = np.bincount(group) > 1
                here, n = np.unique(key[several[group]], return_counts=True)
                token, key = token[fresh], np.where(several, np.uint64(0), key[fresh])
                order, runs = deal(token, blocks)
                token, key = token[order], key[order]
                rows = [(k, token[x:y].tobytes(), key[x:y].tobytes()) for k, x, y in runs]
                cut, runs = deal(here, 64)
                here, n = here[cut], n[cut].astype(np.int64)
                rows += [(-1 - k - 64 * (len(token) % 16), here[x:y].tobytes(), n[x:y].tobytes()) for k, x, y in runs]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], names=["block", "a", "b"])

    def meet(key: tuple, group: pa.Table) -> pa.Table:
        left = np.frombuffer(b"".join(group["a"].to_pylist()), np.uint64)
        right = np.frombuffer(b"".join(group["b"].to_pylist()), np.uint64)
        if key[0].as_py() < 0:
            return packed(left, right.view(np.int64))
        order = np.lexsort([right, left])
        token, cls = left[order], right[order]
        fresh = np.append(True, token[1:] != token[:-1])
        begin = np.flatnonzero(fresh)
        end = np.append(begin[1:], len(token)) - 1
        # a zero sorts first and says that the token is shared
        several = (cls[begin] == 0) | (cls[begin] != cls[end])
        fresh_class = fresh | np.append(True, cls[1:] != cls[:-1])
        chosen = several[np.cumsum(fresh) - 1] & fresh_class & (cls != 0)
        return packed(*np.unique(cls[chosen], return_counts=True))

    def packed(keys: np.ndarray, n: np.ndarray) -> pa.Table:
        """Counts of classes, an array for each block of classes: a class is a row only once they are summed."""
        order, runs = deal(keys, 4 * blocks)
        keys, n = keys[order], n[order].astype("<u4")
        return pa.table({"block": pa.array([k for k, _, _ in runs], pa.int32()), "a": pa.array([keys[x:y].tobytes() for _, x, y in runs], pa.binary()), "b": pa.array([n[x:y].tobytes() for _, x, y in runs], pa.binary())})

    def total(key: tuple, group: pa.Table) -> pa.Table:
        keys, spot = np.unique(np.frombuffer(b"".join(group["a"].to_pylist()), np.int64), return_inverse=True)
        n = np.zeros(len(keys), np.int64)
        np.add.at(n, spot, np.frombuffer(b"".join(group["b"].to_pylist()), "<u4"))
        return pa.table({"key": keys, "shared": n})

    sent = docs.select("text").mapInArrow(tidy(send), "block int, a binary, b binary")
    met = sent.groupBy("block").applyInArrow(meet, "block int, a binary, b binary")
    return met.groupBy("block").applyInArrow(total, "key long, shared long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node of ``edges`` (a, b) that is not a root, by alternating stars."""
    pairs = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    while True:
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(pairs.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
        small = materialize(small.select("e.hi", "e.lo").where("hi <> lo").distinct())
        nodes = small.groupBy("hi").agg(F.count("*").alias("n"))
        discard(pairs)
        ended = small.select(F.col("lo").alias("hi")).distinct().join(nodes.select("hi"), "hi", "left_semi").isEmpty() and nodes.where("n > 1").isEmpty()
        pairs = small
        if ended:
            return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _sets(rows: DataFrame, link: Link) -> DataFrame:
    """``id`` and the set of each row whose text is of the class ``key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        words = WordHash()
        for batch in batches:
            _, at = utf8(batch.column(1))
            for a, b in slices(at, 4 << 20):
                sets = gram_sets(texts(batch.column(1).slice(a, b - a)), link.width, words)
                wanted = batch.column(0).slice(a, b - a).to_pylist()
                kept = [(k, s) for k, s in zip(wanted, sets) if key_of(xxhash.xxh3_128_digest(s.tobytes())) == k]
                flat = np.concatenate([np.zeros(0, np.uint64), *(s for _, s in kept)]).view(np.int64)
                ends = np.cumsum([0, *(len(s) for _, s in kept)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in kept], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["id", "tokens"])

    return rows.select("key", "text").mapInArrow(tidy(run), "id long, tokens array<long>")


def _ordered(sets: DataFrame, link: Link) -> DataFrame:
    """Classes that can link: ``id``, ``n``, shared ``tokens`` (rare first) and their prefixes under three orders.

    Tokens of one class alone come first in every order; only their number matters.
    """
    each = sets.select("id", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    listed = each.join(often, "token").groupBy("id", "n").agg(F.collect_list(F.struct("df", "token")).alias("all"))
    exact = F.expr(f"CAST(({link.num}L * n + {link.den - 1}) DIV {link.den} AS INT)")
    listed = listed.withColumn("least", exact).where(F.size("all") >= F.col("least"))
    span = F.size("all") - F.col("least") + 1  # of the prefix, less the tokens that stand alone

    def order(k: int):
        rank = (lambda x: F.struct(x["df"].alias("r"), x["token"].alias("h"), x["token"])) if k == 0 else (lambda x: F.struct(F.floor(F.log2(x["df"].cast("double"))).alias("r"), F.xxhash64(x["token"], F.lit(k)).alias("h"), x["token"]))
        return F.transform(F.slice(F.array_sort(F.transform("all", rank)), F.lit(1), span), lambda x: x["token"])

    alone = F.col("n") - F.size("all")
    mass = (F.aggregate("all", F.lit(0).cast("long"), lambda a, x: a + x["df"]) + alone) / F.col("n")
    return listed.select(
        "id", F.col("n").cast("long").alias("n"), alone.cast("long").alias("alone"), mass.alias("mass"), F.transform("all", lambda x: x["token"]).alias("tokens"),
        order(0).alias("p0"), order(1).alias("p1"), order(2).alias("p2"),
    )


def _verified(pairs: DataFrame, classes: DataFrame, link: Link) -> DataFrame:
    """The pairs (a, b) that link: size bound and other orders first, then whole sets."""
    slim = classes.select("id", "n", "p1", "p2")
    left = pairs.join(slim.toDF("a", "na", "a1", "a2"), "a")
    both = left.join(slim.toDF("b", "nb", "b1", "b2"), "b")
    near = both.where((link.den * F.least("na", "nb") >= link.num * F.greatest("na", "nb")) & F.arrays_overlap("a1", "b1") & F.arrays_overlap("a2", "b2")).select("a", "b", "na", "nb")
    full = classes.select("id", "tokens")
    met = near.join(full.toDF("a", "ta"), "a").join(full.toDF("b", "tb"), "b")
    met = met.select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("inter"))
    return met.where(link.den * F.col("inter") >= link.num * (F.col("na") + F.col("nb") - F.col("inter"))).select("a", "b")


def _may_link(link: Link, n, at, other_n, other_at):
    """Whether two sets that share a token at these places can still reach the overlap that a link needs."""
    most = F.least(n - at, other_n - other_at)
    sizes = link.den * F.least(n, other_n) >= link.num * F.greatest(n, other_n)
    return sizes & (most * (link.num + link.den) >= link.num * (n + other_n))


def _sketches(classes: DataFrame, ids: DataFrame) -> DataFrame:
    """``id``, ``alone`` and the words ``w0`` ... of some classes' sketches: the parities of the shared tokens that fall on each bit."""
    each = classes.join(ids, "id", "left_semi").select("id", "alone", F.explode("tokens").alias("token")).withColumn("h", F.xxhash64("token", F.lit(7)))
    spot = F.expr("shiftleft(1L, cast(h & 63 as int))")
    words = [F.expr(f"bit_xor(CASE WHEN shiftright(h, 6) & {SKETCH - 1} = {k} THEN spot ELSE 0L END)").alias(f"w{k}") for k in range(SKETCH)]
    return each.withColumn("spot", spot).groupBy("id", "alone").agg(*words)


def _sketches_may_link(link: Link, n, alone, words, other_n, other_alone, other_words):
    """Whether two sets can differ in as few tokens as a link allows: those of one class alone, and one at least for each bit."""
    differing = alone + other_alone
    for a, b in zip(words, other_words):
        differing = differing + F.bit_count(a.bitwiseXOR(b))
    # intersection and union from the sum of sizes and the difference
    both = n + other_n
    return link.den * (both - differing) >= link.num * (both + differing)


def linked_components(classes: DataFrame, link: Link) -> DataFrame:
    """(node, root) over the classes of ``_ordered``; classes without links are not listed."""
    shown = classes.select("id", "n", "alone", "mass", F.posexplode("p0").alias("at", "token"))
    shown = materialize(shown.select("id", "n", "mass", "token", (F.col("at") + F.col("alone")).alias("at")))
    roots = None
    for turn in range(3):
        now = shown.withColumn("comp", F.col("id"))
        if roots is not None:
            now = shown.join(roots.select(F.col("node").alias("id"), "root"), "id", "left").withColumn("comp", F.coalesce("root", "id"))
        what = [F.col(c) for c in ("id", "comp", "n", "at")]
        if turn == 0:
            # the class whose tokens are the most frequent ones stands in the middle of its group
            pivots = [F.min(F.struct((-F.col("mass")).alias("r"), *what))]
        else:
            pivots = [F.min(F.struct(F.xxhash64("id", F.lit(k)).alias("r"), *what)) for k in range(PIVOTS)]
        several = now.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.array_distinct(F.array(*pivots)).alias("pivots")).where("lo < hi")
        if turn < 2:
            other = several.select("token", F.explode("pivots").alias("p")).selectExpr("token", "p.id AS other", "p.comp AS other_comp", "p.n AS other_n", "p.at AS other_at")
            apart = F.col("comp") != F.col("other_comp")
        else:
            left = materialize(now.join(several.select("token"), "token", "left_semi"))
            now = materialize(left.join(_sketches(classes, left.select("id").distinct()), "id"))
            discard(left)
            words = [f"w{k}" for k in range(SKETCH)]
            other = now.selectExpr("token", "id AS other", "comp AS other_comp", "n AS other_n", "at AS other_at", "alone AS other_alone", *[f"{w} AS other_{w}" for w in words])
            apart = F.col("comp") < F.col("other_comp")
            apart = apart & _sketches_may_link(link, F.col("n"), F.col("alone"), [F.col(w) for w in words], F.col("other_n"), F.col("other_alone"), [F.col(f"other_{w}") for w in words])
        near = _may_link(link, F.col("n"), F.col("at"), F.col("other_n"), F.col("other_at"))
        met = now.join(other, (now["token"] == other["token"]) & apart & near)
        pairs = materialize(met.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct())
        if turn == 2:
            discard(now)
        if pairs.isEmpty():
            discard(pairs)
            continue
        found, before = _verified(pairs, classes, link), roots
        if before is not None:
            found = found.union(before.select(F.col("root").alias("a"), F.col("node").alias("b")))
        roots = components(found)
        for done in (pairs, before):
            if done is not None:
                discard(done)
    discard(shown)
    return roots if roots is not None else classes.sparkSession.createDataFrame([], "node long, root long")


def likely(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among ``wanted``; none of the others is lost.

    A Bloom filter of the wanted keys, so that rows that a join would drop are not shuffled.
    It never holds more than ``MOST_BYTES``: beyond ten bits a key it asks fewer hashes and lets
    more rows through.
    """
    n = wanted.count()
    size = min(max(64, 10 * n), 8 * MOST_BYTES)
    probes = max(1, min(5, round(0.7 * size / max(1, n))))
    hashes = [F.xxhash64(key, F.lit(k)) for k in range(probes)]
    spot = wanted.select(F.explode(F.array(*[F.pmod(h, F.lit(size)) for h in hashes])).alias("spot"))
    words = spot.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(spot & 63 as int)))").alias("bits")).toArrow()
    bits = np.zeros(-(-size // 64), np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(bits.view(np.uint8))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.ones(batch.num_rows, bool)
            for k in range(probes):
                at = batch.column(batch.num_columns - probes + k).to_numpy()
                ok &= (shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            yield pa.RecordBatch.from_arrays(batch.columns[:-probes], schema=pa.schema(list(batch.schema)[:-probes])).filter(pa.array(ok))

    probed = rows.select("*", *[F.pmod(h, F.lit(size)).alias(f"_spot{k}") for k, h in enumerate(hashes)])
    return probed.mapInArrow(keep, rows.schema)


def near_duplicates(docs: DataFrame, link: Link = Link()) -> DataFrame:
    """doc_id, ``n_shingles`` and ``component_id`` of each row of ``docs``."""
    signed = materialize(signatures(docs, link))
    classes = signed.where("n > 0").groupBy("cls", "key", "n").agg(F.min("doc_id").alias("first"))
    counts = shared_counts(docs, link)
    needed = F.expr(f"((({link.num}L * n + {link.den - 1}) DIV {link.den}) + 9) DIV 10")
    alive = classes.join(counts, "key").where(F.col("shared") >= needed).select(F.coalesce(F.col("first").cast("long"), F.lit(NOWHERE)).alias("at"), "key")
    alive = materialize(alive)
    text = likely(docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NOWHERE)).alias("at"), "text"), alive.select("at"), "at").join(alive, "at")
    text = text.withColumn("digest", F.xxhash64("text")).dropDuplicates(["at", "key", "digest"])
    ordered = materialize(_ordered(_sets(text, link), link))
    discard(alive)
    roots = linked_components(ordered, link)
    discard(ordered)
    rooted = materialize(classes.join(roots, F.col("key") == F.col("node"), "left").select("cls", "first", F.coalesce("root", "key").alias("root")))
    discard(roots)
    named = rooted.groupBy("root").agg(F.min("first").alias("component"))
    out = signed.join(rooted.join(named, "root").select("cls", "component"), "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
