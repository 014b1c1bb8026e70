"""Many searches at once: blocks of rows meet all queries, and a row must have all words of a query."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What stands between the words of a field.
APART = r"[^\p{L}\p{N}]+"
#: A block holds about so many rows, of about so many characters in all; a slice of queries so many.
ROWS, CHARS, QUERIES = 8192, 8 << 20, 1 << 16
#: Most tasks that blocks are dealt to.
TASKS = 2000
#: Bytes of bits, and pairs found, that are held at once.
BYTES, PAIRS = 1 << 24, 1 << 17


def query_words(text: Column) -> Column:
    """Words of a query as structs: ``stem``, and whether a trailing ``*`` asks for any word that begins so.  None for all rows."""
    words = F.filter(F.split(F.lower(text), r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")
    every = text.isNull() | (text == "") | (text == "*")
    none = F.array().cast("array<struct<stem:string,prefix:boolean>>")
    return F.when(every, none).otherwise(F.transform(words, lambda w: F.struct(F.regexp_replace(w, r"\*+$", "").alias("stem"), w.endswith("*").alias("prefix"))))


class _Index:
    """Which rows of a block have a word, as one bit a row."""

    def __init__(self, words: list[pa.Array]) -> None:
        told = pa.concat_arrays(words)
        self.n = len(told)
        coded = told.flatten().dictionary_encode()
        vocabulary = coded.dictionary.to_pylist()
        order = sorted(range(len(vocabulary)), key=vocabulary.__getitem__)
        self.vocabulary = [vocabulary[k] for k in order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        word = place[coded.indices.to_numpy(zero_copy_only=False)] if len(order) else np.zeros(0, np.int64)
        row = told.value_parent_indices().to_numpy()
        by = np.argsort(word, kind="stable")
        self.rows, self.start = row[by], np.searchsorted(word[by], np.arange(len(order) + 1))

    def bits(self, term: str) -> np.ndarray | None:
        """Rows with a word: with one that begins so, if the term begins with ``*``; None if there are none."""
        stem, low = term[1:], bisect_left(self.vocabulary, term[1:])
        if term[0] == "*":
            # beyond all words that begin with the stem
            high = bisect_left(self.vocabulary, True, low, key=lambda w: not w.startswith(stem))
        else:
            high = low + (low < len(self.vocabulary) and self.vocabulary[low] == stem)
        if low == high:
            return None
        has = np.zeros(self.n, bool)
        has[self.rows[self.start[low] : self.start[high]]] = True
        return np.packbits(has, bitorder="little")


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query, id) of the pairs of one block of rows and one slice of queries."""
    ids, words, asked, wanted = [], [], [], []
    for batch in batches:
        is_query = batch.column("is_query")
        rows, queries = batch.filter(pc.invert(is_query)), batch.filter(is_query)
        ids.append(rows.column("id"))
        words.append(rows.column("words"))
        asked.append(queries.column("query"))
        wanted += queries.column("words").to_pylist()
    ids, asked, index = pa.concat_arrays(ids), pa.concat_arrays(asked), _Index(words)
    if not len(ids):
        return
    every = np.packbits(np.ones(len(ids), bool), bitorder="little")
    # queries of which each word stands somewhere in the block; bits of a word are made once
    number: dict[str, int] = {}
    bits: list[np.ndarray] = [every]
    kept, terms = [], []
    for k, ws in enumerate(wanted):
        mine = []
        for w in ws:
            if w not in number:
                found = index.bits(w)
                number[w] = -1 if found is None else len(bits)
                bits += [] if found is None else [found]
            mine.append(number[w])
            if mine[-1] < 0:
                break
        if not mine or mine[-1] >= 0:
            kept.append(k)
            terms.append(mine)
    table, step = np.stack(bits), max(1, BYTES // len(every))
    for at in range(0, len(kept), step):
        some, most = terms[at : at + step], max(map(len, terms[at : at + step]))
        # a query of fewer words asks for what every row has
        spots = np.array([ws + [0] * (most - len(ws)) for ws in some], np.int64).reshape(len(some), most)
        met = np.repeat(every[None], len(some), 0)
        for nth in range(most):
            met &= table[spots[:, nth]]
        query, byte = np.nonzero(met)
        for part in range(0, len(query), PAIRS // 8):
            q, b = query[part : part + PAIRS // 8], byte[part : part + PAIRS // 8]
            pair, bit = np.nonzero(np.unpackbits(met[q, b][:, None], axis=1, bitorder="little"))
            yield pa.RecordBatch.from_arrays([asked.take(pa.array(np.array(kept, np.int64)[at + q[pair]])), ids.take(pa.array(b[pair] * 8 + bit))], names=["query", "id"])


def search_many(rows: DataFrame, queries: DataFrame, row_id: str, field: str, query: str = "query_text") -> DataFrame:
    """(``query``, ``row_id``) of every row that a query finds, as the search predicate does one query at a time.

    Rows are dealt into blocks, and each block is sent every query, in slices; there a word is a
    bit for each row, and a query the ``and`` of its words.  So what is shuffled are rows, and
    queries once a block, never the pairs of a query and a row that has one of its words.
    Each row is judged by itself.  Repeated queries count once.
    """
    said = F.coalesce(F.array_distinct(F.split(F.lower(field), APART)), F.array().cast("array<string>"))
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.char_length(field)), F.lit(0)).alias("chars")).first()
    asked = queries.select(F.col(query).alias("query")).distinct()
    blocks, slices = 1 + max(size.n // ROWS, size.chars // CHARS), 1 + asked.count() // QUERIES
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    terms = F.transform(query_words(F.col("query")), lambda w: F.concat(F.when(w["prefix"], F.lit("*")).otherwise(F.lit(" ")), w["stem"]))
    nothing = lambda kind: F.lit(None).cast(kind)
    key = rows.schema[row_id].dataType
    dealt = rows.select(F.pmod(F.xxhash64(row_id, field), F.lit(blocks)).cast("int").alias("block"), every(slices).alias("slice"), F.lit(False).alias("is_query"), nothing("string").alias("query"), F.col(row_id).alias("id"), said.alias("words"))
    sent = asked.select(every(blocks).alias("block"), "query").select("block", F.pmod(F.xxhash64("query"), F.lit(slices)).cast("int").alias("slice"), F.lit(True).alias("is_query"), "query", nothing(key).alias("id"), terms.alias("words"))
    schema = T.StructType([T.StructField("query", T.StringType()), T.StructField("id", key)])
    # a number of its own, as the few bytes of a block say nothing of what is found in it
    both = dealt.unionByName(sent).repartition(min(2 * blocks * slices, TASKS), "block", "slice")
    met = both.groupBy("block", "slice").applyInArrow(_searched, schema)
    return met.select(F.col("query").alias(query), F.col("id").alias(row_id))
