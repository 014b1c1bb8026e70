import json
import random

from pyspark.sql import functions as F

from recordloom.operators import search
from recordloom.operators.search import search_many
from recordloom.sources import payload


def test_many_searches_equal_one_at_a_time(spark):
    rng = random.Random(3)
    words = ["sodium", "chloride", "chlorine", "so", "Über", "água", "x2", "2", "sodium2", "a-b"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 5))) for _ in range(60)] + [None, "", "  ", "-sodium-", "SODIUM/chloride"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, name string")
    queries = ["sodium", "Sodium  CHLOR*", "so*", "sodium sodium", "chlor* so* x*", "*", "", None, "nothing", "a-b", "über", "* sodium", "**", "so* zz*", "á*", "2 x2", "so*"]
    got = {(r.query_text, r.id) for r in search_many(rows, spark.createDataFrame([(q,) for q in queries], "query_text string"), "id", "name").collect()}
    want = {(q, r.id) for q in queries for r in rows.where(payload.search_predicate(q, "name")).collect()}
    assert got == want and len({q for q, _ in want}) == 13
    assert search_many(rows.where("false"), spark.createDataFrame([("*",)], "query_text string"), "id", "name").collect() == []
    assert search_many(rows, spark.createDataFrame([], "query_text string"), "id", "name").collect() == []


def test_searches_in_many_blocks_shuffle_no_pairs(spark, monkeypatch):
    for name, value in (("ROWS", 16), ("QUERIES", 2), ("BYTES", 8), ("PAIRS", 16)):
        monkeypatch.setattr(search, name, value)
    rows = spark.range(200).select("id", F.concat(F.lit("the "), F.when(F.col("id") % 2 == 0, "then ").otherwise(""), F.concat(F.lit("w"), F.col("id") % 7)).alias("name"))
    texts = {r.id: r.name.split() for r in rows.collect()}
    queries = ["the th*", "the then", "w1 the", "w* then", "*", "no the"]
    out = search_many(rows, spark.createDataFrame([(q,) for q in queries], "query_text string"), "id", "name")
    met = lambda w, ws: any(x.startswith(w[:-1]) for x in ws) if w.endswith("*") else w in ws
    want = sorted((q, k) for q in queries for k, ws in texts.items() if q == "*" or all(met(w, ws) for w in q.split()))
    assert sorted((r.query_text, r.id) for r in out.collect()) == want
    # rows and queries meet in their blocks: no join whose rows are pairs is shuffled
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_one_id_are_judged_apart(spark):
    rows = spark.createDataFrame([(1, "red ball"), (1, "blue bat")], "id long, name string")
    asked = spark.createDataFrame([("red bat",), ("b*",)], "query_text string")
    assert sorted((r.query_text, r.id) for r in search_many(rows, asked, "id", "name").collect()) == [("b*", 1), ("b*", 1)]


def test_unknown_fields_are_listed(spark):
    pages = [
        json.dumps({"apiVersion": "1", "new": {"a": 1}, "results": [{"reference": "r", "score": 2, "metadata": {"inciName": ["x"], "odd field": None}}, {"metadata": {"inciName": "y", "odd field": 1}}]}),
        json.dumps({"apiVersion": 1, "results": None}), "[1]", "broken {", None,
    ]
    got = {(r.level, r.field): (r.known, r.n, r.kinds) for r in payload.field_report(spark.createDataFrame([(p,) for p in pages], "payload string")).collect()}
    assert got[("page", "apiVersion")] == (True, 2, "BIGINT STRING") and got[("page", "new")] == (False, 1, "OBJECT")
    assert got[("result", "score")] == (False, 1, "BIGINT") and got[("result", "reference")] == (True, 1, "STRING")
    assert got[("metadata", "inciName")] == (True, 2, "ARRAY STRING") and got[("metadata", "odd field")] == (False, 2, "BIGINT VOID")
    assert {k for k, v in got.items() if not v[0]} == {("page", "new"), ("result", "score"), ("metadata", "odd field")}
