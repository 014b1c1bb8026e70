"""From raw documents to token ids: five stages over the operators of ``recordloom.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``.  ``run`` writes each stage's result to the shared folder and reads
it again, so a lost executor never repeats an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import bpe, decontaminate, ngram_join, pii, quality
from recordloom.llm.common import discard, fold, materialize, table

#: Near duplicates: five words, Jaccard similarity 0.8 or more.
NEAR = ngram_join.Link(5, 80, 100)


def _numbered(docs: DataFrame) -> DataFrame:
    """Each row as one column ``doc`` with a number of its own, ``row``, written so that every reading gives the same ones.

    As one column, a row's own columns clash with nothing, whatever their names.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return materialize(docs.select(whole, F.monotonically_increasing_id().alias("row")))


def _texts(rows: DataFrame) -> DataFrame:
    """The row's number in the place of doc_id, so that an operator judges each row by itself."""
    return rows.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text"))


def _own(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(f"doc.`{c}`").alias(c) for c in columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier gives 0.5 or more.

    Rows are judged one by one by their text: equal texts stay or go together, null text counts
    as empty.  The id serves only to find the labels to learn from; rows without one are judged
    like others.
    """
    rows = quality.training_rows(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 3) != 1)
    net = quality.fit([t for t, _ in rows], [y for _, y in rows])
    score = "score"
    while score in docs.columns:
        score += "_"
    return quality.score_documents(docs, net, score).where(F.col(score) >= 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: of its smallest doc_id, null being the largest.

    Rows are grouped by their texts alone; ids may be null or repeat.  Of rows that tie, any one
    stays.  Empty and null texts are near nothing and all stay.
    """
    rows = _numbered(docs)
    found = ngram_join.near_duplicates(_texts(rows), NEAR).select(F.col("doc_id").alias("row"), "component_id")
    named = rows.select("row", F.struct(F.col("doc.doc_id").isNull(), F.col("doc.doc_id"), F.col("row")).alias("first"))
    kept = found.join(named, "row").groupBy("component_id").agg(F.min("first").alias("first"))
    return _own(rows.join(kept.select("first.row"), "row", "left_semi"), docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item.

    Rows are judged one by one by their text; ids may be null or repeat.  Null text has no
    words and stays, as does everything where there are no items.
    """
    rows = _numbered(docs)
    judged = decontaminate.decontaminate(_texts(rows), table(spark, sf_dir, "benchmark"))
    hit = judged.where("contaminated").select(F.col("doc_id").alias("row"))
    return _own(rows.join(hit, "row", "left_anti"), docs.columns)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced; ``n_chars`` follows the new text.

    No row goes.  Null text stays null, with null ``n_chars``; equal texts are changed alike.
    """
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (little-endian unsigned 32-bit), with whether they decode to its text.

    One row a row, repeated ones too; null text has no ids.  Columns: doc_id, lang, source,
    n_tokens, ids and round_trip.
    """
    import public_tokenizers

    coded = bpe.encode_verified(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", "round_trip")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("byte_bpe", encode),
]

#: Neither the classifier nor the merges can be written in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  The tables between them go once the next one is written."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            lazy, docs = docs, materialize(docs)
            # the tables of this stage and the rows it began with; the input itself stays
            discard(lazy)
            discard(before)
    return docs
