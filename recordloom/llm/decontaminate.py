"""Benchmark decontamination: a prefix-filtered set join, in DataFrame operations only.

Every item is cut into windows of ``WINDOW`` consecutive words.  For exact containment one
token of each window is necessary, so the prefix is its rarest word, rarity being counted
over all documents.  Document words join these prefix words; the length and the position of
the window bound where it can lie in the document; the words of the candidate stretch are
then compared one by one with the window's.

The prefix table is broadcast only after its size is measured (``MOST_WINDOWS`` rows, checked
on the table itself); a larger one joins by shuffle, with the same result.  Then only words that
can be prefixes are shuffled, with the words around them: a filter of ``FILTER`` bits, one for
the hash of each prefix word, is broadcast and lets the others go where they stand.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text after lower-casing A-Z.
Defined results: null text has no words and no hits; items without words or with null text
have no window; an item with a null id counts as an item without a name (it marks words but
is not listed).  One row per row of ``docs``, repeated rows included; equal windows of
several items count for each of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

WINDOW = 10
MOST_WINDOWS = 400_000
SALTS = 8
#: Bits of the filter: 8 MB as words of 64.
FILTER = 1 << 26
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_az(column: Column) -> Column:
    """Lower-case A-Z only; text without other letters takes the faster way."""
    return F.when(F.octet_length(column) == F.char_length(column), F.lower(column)).otherwise(F.translate(column, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_az(F.coalesce(text, F.lit(""))), BETWEEN, -1), "")


def item_windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """Distinct windows: ``words``, their number ``size``, and the ``items`` that have them."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("all")).where(F.size("all") > 0)
    count = F.greatest(F.size("all") - width + 1, F.lit(1))
    each = items.select("item_id", "all", F.explode(F.sequence(F.lit(1), count)).alias("at"))
    cut = each.select("item_id", F.slice("all", F.col("at"), F.least(F.size("all"), F.lit(width))).alias("words"))
    return cut.groupBy("words").agg(F.collect_set(F.col("item_id").cast("string")).alias("items")).withColumn("size", F.size("words"))


def prefixes(docs: DataFrame, windows: DataFrame, bound: int = MOST_WINDOWS) -> tuple[DataFrame, bool]:
    """Each window under its rarest word (``prefix``, at ``offset`` in it); whether the table may be broadcast."""
    windows = materialize(windows)
    small = windows.count() <= bound
    words = windows.select(F.explode("words").alias("word")).distinct()
    seen = docs.select(F.explode(words_of(F.col("text"))).alias("word"))
    frequency = seen.join(F.broadcast(words) if small else words, "word").groupBy("word").agg(F.count("*").alias("n"))
    ranked = windows.select("words", "size", "items", F.posexplode("words").alias("offset", "word"))
    # a word that many windows hold is dealt to several tasks, each with a copy of its count
    ranked = ranked.withColumn("salt", F.pmod(F.xxhash64("words"), F.lit(SALTS)))
    copies = frequency.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    ranked = ranked.join(copies, ["word", "salt"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # a word that no document has rules its window out: as the rarest it never joins
    best = ranked.groupBy("words", "size").agg(F.min(F.struct("n", "word", "offset")).alias("rarest"), F.first("items").alias("items"))
    found = materialize(best.select(F.col("rarest.word").alias("prefix"), F.col("rarest.offset").alias("offset"), "size", "words", "items").where(F.col("rarest.n") > 0))
    discard(windows)
    return found, small


def occurrences(docs: DataFrame, prefix: DataFrame, small: bool) -> DataFrame:
    """A row for each occurrence of a window, and one with null ``start`` for each document.

    ``row`` tells the rows of ``docs`` apart, ``n_words`` is their number of words.
    """
    rows = docs.select("doc_id", words_of(F.col("text")).alias("said"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("n_words", F.size("said"))
    if not small:
        return _far_occurrences(rows, prefix)
    each = rows.select("doc_id", "row", "n_words", "said", F.posexplode(F.concat(F.array(F.lit("")), F.col("said"))).alias("at", "prefix"))
    # the empty word stands for the document itself
    itself = prefix.sparkSession.createDataFrame([("", 0, 0, None, None)], prefix.schema)
    joined = each.join(F.broadcast(prefix.unionByName(itself)), "prefix")
    start = F.col("at") - 1 - F.col("offset")
    fits = (start >= 0) & (start + F.col("size") <= F.col("n_words"))
    same = F.when(fits, F.slice("said", start + 1, F.col("size")) == F.col("words")).otherwise(F.lit(False))
    kept = joined.where((F.col("size") == 0) | same)
    real = F.col("size") > 0
    return kept.select("doc_id", "row", "n_words", F.when(real, start).alias("start"), F.when(real, F.col("size")).alias("size"), "items")


def _prefix_bits(prefix: DataFrame, bits: int) -> DataFrame:
    """One row ``filter``: words of 64 bits, with one set for the hash of each prefix word."""
    spot = F.pmod(F.xxhash64("prefix"), F.lit(bits))
    words = prefix.select(spot.alias("spot")).groupBy(F.shiftright("spot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(spot & 63 as int)))").alias("set"))
    every = prefix.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(words, "word", "left").select("word", F.coalesce("set", F.lit(0)).alias("set"))
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "set"))), lambda x: x["set"]).alias("filter"))


def _may_be_prefix(word: Column, bits: int) -> Column:
    spot = F.pmod(F.xxhash64(word), F.lit(bits))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), spot.bitwiseAND(63).cast("int"))
    return F.get("filter", F.shiftright(spot, 6).cast("int")).bitwiseAND(one) != 0


def _far_occurrences(rows: DataFrame, prefix: DataFrame, bits: int = FILTER) -> DataFrame:
    """The same by a join of two shuffled sides: a word that may be a prefix travels with the words that a window around it can reach."""
    reach = prefix.agg(F.coalesce(F.max("size"), F.lit(1)).alias("n")).first().n - 1
    begin = F.greatest(F.col("at") - reach, F.lit(0))
    # the places are chosen before rows are made of them, so that the filter does not travel along
    places = F.filter(F.sequence(F.lit(0), F.col("n_words") - 1), lambda i: _may_be_prefix(F.get("said", i), bits))
    marked = rows.where("n_words > 0").join(F.broadcast(_prefix_bits(prefix, bits))).select("doc_id", "row", "n_words", "said", places.alias("places"))
    each = marked.select("doc_id", "row", "n_words", "said", F.explode("places").alias("at")).withColumn("prefix", F.get("said", F.col("at")))
    each = each.select("doc_id", "row", "n_words", "at", "prefix", begin.alias("begin"), F.slice("said", begin + 1, F.col("at") - begin + reach + 1).alias("near"))
    start = F.col("at") - F.col("offset")
    fits = (start >= 0) & (start + F.col("size") <= F.col("n_words"))
    same = F.when(fits, F.slice("near", start - F.col("begin") + 1, F.col("size")) == F.col("words")).otherwise(F.lit(False))
    found = each.join(prefix, "prefix").where(same).select("doc_id", "row", "n_words", start.cast("int").alias("start"), "size", "items")
    itself = rows.select("doc_id", "row", "n_words", F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("size"), F.lit(None).cast(found.schema["items"].dataType).alias("items"))
    return found.unionByName(itself)


def covered(spans: Column) -> Column:
    """Number of places inside any of the [start, start + size) spans; ``spans`` is sorted by start."""
    begin = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(acc: Column, span: Column) -> Column:
        end = span["start"] + span["size"]
        return F.struct((acc["n"] + F.greatest(end - F.greatest(acc["end"], span["start"]), F.lit(0))).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(spans, begin, step, lambda acc: acc["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row per document: words, hit words, the items found in it, and whether there are any hits."""
    prefix, small = prefixes(docs, item_windows(benchmark, width))
    found = occurrences(docs, prefix, small)
    spans = F.array_sort(F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "size"))))
    grouped = found.groupBy("row", "doc_id").agg(F.max("n_words").alias("n_words"), spans.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    hit = grouped.withColumn("n_hit", covered(F.col("spans")))
    return hit.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items", "spans",
    )
