"""Document fingerprints from closed syncmers, in DataFrame operations only.

A text is read as tokens: runs without ASCII white space, cut after 16 characters.  Of
its K-token substrings those are chosen whose smallest inner S-token substring (by hash)
stands at an edge.  The choice depends on nothing outside the substring, so a passage
yields the same anchors wherever it stands.  Short texts are fingerprinted by characters
as well.  A fingerprint lists its anchors in order as ``place.hash``.

Likeness matches anchors by hash and place: two anchors match if their hashes are equal
and their places lie in the same or in neighbouring cells of ``CELL`` tokens.  It is the
matched share of all distinct (hash, cell) anchors of both texts.  Texts that are both
short are compared by characters, others by tokens.

Each document is followed by the next in ascending doc_id; after the last comes the
first.  Neighbours meet by sorting within ranges of doc_id; the ranges come from
quantiles, and the first document of each range is also sent to the range before it.

Defined results: null text counts as empty; the fingerprint of an empty text is empty,
and like another empty one (1), not like any other (0).  Repeated rows of a doc_id follow
each other in the order of their texts.  A null doc_id sorts first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

K, S = 5, 2  # tokens
CHAR_K, CHAR_S, SHORT = 8, 3, 512  # characters
CELL = 64
TOKENS = r"[^\x20\x09-\x0D]{1,16}"
#: Ranges of doc_id: no fewer, no more, and of about this much text between.
FEWEST, MOST, RANGE_BYTES = 2047, 65535, 16 << 20
LEAST = -(2**63)


def _anchors(rows: DataFrame, hashes: str, out: str, k: int, s: int) -> DataFrame:
    """``rows`` with ``out``: the anchors (place, hash) of a column of token hashes.

    Fewer than ``k`` tokens are one anchor; null stays null.  Each step is a column of its
    own, so that nothing is computed again for each element.
    """
    n, inner, places = F.size(hashes), f"{out}_inner", f"{out}_places"

    def edge(i: Column) -> Column:
        ends = F.least(F.get(inner, i), F.get(inner, i + (k - s)))
        return ends <= F.least(*[F.get(inner, i + j) for j in range(1, k - s)])

    rows = rows.withColumn(inner, F.when(n >= k, F.transform(F.sequence(F.lit(0), n - s), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(s)]))))
    rows = rows.withColumn(places, F.when(n >= k, F.filter(F.sequence(F.lit(0), n - k), edge)).when(n > 0, F.array(F.lit(0))).when(n == 0, F.array().cast("array<int>")))
    whole = F.xxhash64(hashes)
    each = F.transform(places, lambda i: F.struct(i.alias("at"), F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]).alias("hash")))
    short = F.transform(places, lambda i: F.struct(i.alias("at"), whole.alias("hash")))
    return rows.withColumn(out, F.when(n >= k, each).otherwise(short)).drop(hashes, inner, places)


def with_anchors(rows: DataFrame, text: str, tokens: str, chars: str) -> DataFrame:
    """``rows`` with the anchors of ``text`` by tokens and, for short texts that are not empty, by characters."""
    words = F.transform(F.regexp_extract_all(F.col(text), F.lit(f"({TOKENS})"), F.lit(1)), lambda w: F.xxhash64(w))
    letters = F.transform(F.array_remove(F.split(F.col(text), ""), ""), lambda c: F.xxhash64(c))
    short = (F.char_length(text) < SHORT) & (F.col(text) != "")
    rows = rows.withColumns({f"{tokens}_hashes": words, f"{chars}_hashes": F.when(short, letters)})
    return _anchors(_anchors(rows, f"{tokens}_hashes", tokens, K, S), f"{chars}_hashes", chars, CHAR_K, CHAR_S)


def written(tokens: Column, chars: Column) -> Column:
    """The fingerprint as text; hashes shown to 32 bits."""

    def line(anchors: Column) -> Column:
        return F.array_join(F.transform(anchors, lambda a: F.concat(a["at"].cast("string"), F.lit("."), F.lower(F.hex(a["hash"].bitwiseAND(0xFFFFFFFF))))), " ")

    return F.concat(line(tokens), F.coalesce(F.concat(F.lit("|"), line(chars)), F.lit("")))


def _matched(rows: DataFrame, left: str, right: str, out: str) -> DataFrame:
    """``rows`` with the share of anchors that match, 0 to 1; 1 for two empty lists, null if one is null."""

    def keys(anchors: str, shift: int) -> Column:
        return F.transform(anchors, lambda a: F.xxhash64(a["hash"], (a["at"] / CELL).cast("int") + shift))

    own, other, around = f"{out}_own", f"{out}_other", f"{out}_around"
    both = F.least(F.size(F.array_intersect(own, around)), F.size(other))
    rows = rows.withColumns({own: F.array_distinct(keys(left, 0)), other: F.array_distinct(keys(right, 0)), around: F.concat(keys(right, 0), keys(right, -1), keys(right, 1))})
    rows = rows.withColumn(out, both)
    union = F.size(own) + F.size(other) - F.col(out)
    known = F.col(left).isNotNull() & F.col(right).isNotNull()
    return rows.withColumn(out, F.when(known, F.when(union == 0, F.lit(1.0)).otherwise(F.col(out) / union))).drop(own, other, around)


def with_likeness(rows: DataFrame, other: str, out: str) -> DataFrame:
    """``rows`` with the likeness of its anchors to those of ``other``."""
    rows = _matched(rows, "chars", f"{other}_chars", f"{out}_c")
    rows = _matched(rows, "tokens", f"{other}_tokens", f"{out}_t")
    return rows.withColumn(out, F.coalesce(f"{out}_c", f"{out}_t")).drop(f"{out}_c", f"{out}_t")


def with_next(docs: DataFrame, key: str = "doc_id", ranges: int | None = None) -> DataFrame:
    """``docs`` (with a column ``text``) with ``next_text``, the text of the document that follows.

    The number of ranges follows the bytes of text, up to ``MOST``; beyond that a range grows,
    and sorting it spills.
    """
    spark = docs.sparkSession
    place = F.coalesce(F.col(key).cast("long"), F.lit(LEAST))
    if ranges is None:
        size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
        ranges = min(MOST, max(FEWEST, size // RANGE_BYTES))
    edges = docs.select(F.percentile_approx(place, [(i + 1) / (ranges + 1) for i in range(ranges)], 100_000).alias("edges")).first().edges or []
    edges = sorted(set(edges))
    bounds = F.lit(edges) if edges else F.array().cast("array<bigint>")
    halves, step = [], 1
    while step <= len(edges):
        halves.insert(0, step)
        step *= 2

    def search(lo: Column, by: Column) -> Column:
        return F.when((lo + by <= len(edges)) & (F.get(bounds, lo + by - 1) <= F.col("_place")), lo + by).otherwise(lo)

    found = F.aggregate(F.array(*map(F.lit, halves)), F.lit(0), search) if halves else F.lit(0)
    # one row a range: the least place in it
    heads = sorted((r.bucket, r.head) for r in docs.select(place.alias("_place")).withColumn("bucket", found).groupBy("bucket").agg(F.min("_place").alias("head")).collect())
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}
    table = materialize(spark.createDataFrame([(h, b) for h, b in before.items()] or [(LEAST, 0)], "_head long, _before int"))
    rows = docs.withColumn("_place", place).withColumn("_bucket", found).join(F.broadcast(table), F.col("_place") == F.col("_head"), "left")
    # the head of a range stands at the end of the range before it as well, the first of all behind everything
    itself = F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("halo"))
    ahead = F.struct(F.col("_before").alias("bucket"), F.lit(True).alias("halo"))
    spread = rows.withColumn("_spot", F.explode(F.when(F.col("_before").isNull(), F.array(itself)).otherwise(F.array(itself, ahead))))
    order = Window.partitionBy("_spot.bucket").orderBy("_spot.halo", "_place", F.col("text").asc_nulls_first())
    ahead_text = spread.withColumn("next_text", F.lead(F.coalesce("text", F.lit(""))).over(order))
    return ahead_text.where(~F.col("_spot.halo")).drop("_place", "_bucket", "_head", "_before", "_spot")


def fingerprint(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likeness."""
    rows = with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "text", "next_text", edited.alias("edited"))
    rows = with_anchors(rows, "text", "tokens", "chars")
    rows = with_anchors(rows, "edited", "edited_tokens", "edited_chars")
    rows = with_anchors(rows, "next_text", "next_tokens", "next_chars").drop("text", "next_text")
    rows = with_likeness(with_likeness(rows, "edited", "near_edited"), "next", "near_next")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), written(F.col("tokens"), F.col("chars")).alias("fingerprint"),
        written(F.col("edited_tokens"), F.col("edited_chars")).alias("edited_fingerprint"), "near_edited", "near_next",
    )
