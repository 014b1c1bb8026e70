"""Keys against values worked out by hand from the rules."""

import random
import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from recordloom.functions import text as tx
from recordloom.functions.values import count_items, first_or_none, join_list
from recordloom.operators.match import with_keys

GOLDEN = [
    ("Sodium Chloride", "sodium chloride", "sodium chloride", "chloride sodium", "odium chloride", "chloride odium"),
    ("DL-Alpha-Tocopherol", "dl-alpha-tocopherol", "dl alpha tocopherol", "alpha dl tocopherol", "alpha tocopherol", "alpha tocopherol"),
    ("(+)-Catechin", "(+)-catechin", "catechin", "catechin", "catechin", "catechin"),
    ("Mica & Talc (CI 77019)", "mica & talc (ci 77019)", "mica & talc", "& mica talc", "mica and talc", "mica talc"),
    ("DL-Lysine", "dl-lysine", "dl lysine", "dl lysine", "ysine", "ysine"),
    ("C12-15 Alkyl Benzoate", "c12-15 alkyl benzoate", "c12 15 alkyl benzoate", "15 alkyl benzoate c12", "c12 15 alkyl benzoate", "15 alkyl benzoate c12"),
    ("ＡＬＯＥ　Vera", "aloe vera", "aloe vera", "aloe vera", "aloe vera", "aloe vera"),
    ("Peg-8 (a (b) c) X", "peg-8 (a (b) c) x", "peg 8 c) x", "8 c) peg x", "peg 8 c) x", "8 c) peg x"),
    ("(D)-Glucose", "(d)-glucose", "glucose", "glucose", "glucose", "glucose"),
    ("L'Or. Extract", "l'or. extract", "l'or. extract", "extract l'or.", "or extract", "extract or"),
    (" Rosa  Canina ", "rosa canina", "rosa canina", "canina rosa", "osa canina", "canina osa"),
    ("()", "()", None, None, None, None),
    ("Niacinamide",) + ("nicotinamide",) * 5,
    (None,) + (None,) * 5,
]


def test_keys(spark):
    rows = with_keys(spark.createDataFrame([(g[0], None) for g in GOLDEN], "name string, cas string"), "name", "cas").collect()
    got = {r.name: (r.key_basic, r.key_full, r.key_sorted, r.key_paren_removed, r.key_sorted_strict) for r in rows}
    assert got == {g[0]: g[1:] for g in GOLDEN}


def test_strict_leading_keeps_words(spark):
    rows = spark.createDataFrame([("sodium chloride",), ("l-lysine",), ("(d)-glucose",)], "k string").select(tx.paren_removed(F.col("k"), True).alias("v")).collect()
    assert [r.v for r in rows] == ["sodium chloride", "lysine", "glucose"]


@pytest.mark.parametrize("raw,want", [("CAS No. 50-81-7", "50-81-7"), ("-", None), ("- -", "--"), ("50-81-7 / 1 2", "50-81-7/12"), ("cas no. 1", "casno.1"), (None, None), ("CAS No", None)])
def test_identifier(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(tx.identifier(F.col("t"))).first()[0] == want


@pytest.mark.parametrize("raw,want", [("", None), ("-", None), ("--", None), ("NaN", None), (" none ", None), ("NULL", None), ("0", "0"), (" x ", "x"), (" \x1c", None)])
def test_nullify(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(tx.nullify(F.col("t"))).first()[0] == want


@pytest.mark.parametrize("raw,want", [("총 1,234 건", 1234), ("검색결과 12건", 12), ("결과 7 건", 7), ("총 , 건", None), ("none", None), (None, None)])
def test_total_count(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(tx.total_count(F.col("t"))).first()[0] == want


@pytest.mark.parametrize(
    "raw,first,joined,n",
    [('["a"," b ",""]', "a", "a | b", 3), ("[]", None, None, 0), ("plain", "plain", "plain", 1), (None, None, None, 0), ('["x",null]', "x", "x", 2), ('[" "]', " ", None, 1)],
)
def test_scalar_or_list(spark, raw, first, joined, n):
    c = F.col("t")
    row = spark.createDataFrame([(raw,)], "t string").select(first_or_none(c), join_list(c), count_items(c)).first()
    assert tuple(row) == (first, joined, n)


def test_null_item_can_be_written(spark):
    assert spark.createDataFrame([('["x",null]',)], "t string").select(join_list(F.col("t"), null_text="None")).first()[0] == "x | None"


def test_compatibility_form_of_every_character(spark):
    """Every assigned character, alone and in random company, in parts that combine and reorder."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    rng = random.Random(4)
    parts = [c for c in every if unicodedata.combining(c) or unicodedata.decomposition(c)]
    texts = every + ["".join(rng.choices(every, k=6)) for _ in range(5000)] + ["".join(rng.choices(parts, k=6)) for _ in range(5000)] + ["", None]
    rows = spark.createDataFrame(pd.DataFrame({"t": texts})).select("t", tx.nfkc(F.col("t")).alias("n")).toPandas()
    want = rows["t"].map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))
    assert [t for t, n, w in zip(rows["t"], rows["n"], want) if n != w] == []
    assert "Python" not in rows_plan(spark)


def rows_plan(spark):
    return spark.createDataFrame([("x",)], "t string").select(tx.basic(F.col("t")))._jdf.queryExecution().executedPlan().toString()
