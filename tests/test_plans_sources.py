import collections
import http.server
import json
import random
import re
import threading

import pytest
from pyspark.sql import functions as F

from recordloom.functions.values import run_date
from recordloom.operators.validate import ValidationError, gate, require_columns, validate
from recordloom.plans import crawl, prefixes
from recordloom.plans.reconcile import bronze_from_pages, bronze_from_payloads, run_and_save
from recordloom.queries import left_registry, right_registry
from recordloom.sources import fetch, html, payload, tables
from recordloom.streaming.incremental import each_arrival


def worklist(n: dict, limit: int, depth: int, alphabet: str):
    final, over, todo = set(), set(), list(alphabet)
    while todo:
        p = todo.pop()
        if not n.get(p):
            continue
        if n[p] <= limit:
            final.add(p)
        elif len(p) == depth + 1:
            over.add(p)
        else:
            todo += [p + c for c in alphabet]
    return final, over


def test_plan_equals_the_worklist(spark):
    rng = random.Random(3)
    for _ in range(5):
        words = ["".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(60)]
        n = {}
        for w in words:
            for k in range(1, min(len(w), 4) + 1):
                n[w[:k]] = n.get(w[:k], 0) + 1
        plan = prefixes.split_plan(spark.createDataFrame(list(n.items()), "prefix string, n long"), 6, 3, "abc").collect()
        final, over = worklist(n, 6, 3, "abc")
        assert {r.prefix for r in plan if r.status == "final"} == final and {r.prefix for r in plan if r.status == "oversized"} == over


def test_plan_edges(spark):
    counts = spark.createDataFrame([("a", 10), ("aa", 10), ("b", 11), ("ba", 4), ("c", 0)], "prefix string, n long")
    assert {r.prefix for r in prefixes.split_plan(counts, 10).collect()} == {"a", "ba"}
    assert {r.prefix for r in prefixes.split_plan(counts, 10, max_seeds=1).collect()} == {"a"}
    assert prefixes.residual(counts, 10).first().residual == 7


PAGE = """<html><head><title> T&amp;x </title></head><table><tr><td>menu</td></tr></table>
<table><tr><th>번호</th><th>INCI</th></tr>
<tr><td>1,234</td><td>가 나</td><td>A &amp; B</td><td></td><td>old</td><td>x</td><td>2024.01.05</td><td>2025-01-01</td></tr>
<tr><td>x1</td><td>no</td></tr><tr><td>7<td>short</tr><tr><td>8</td><td>INCI name</td></tr></table></html>"""


def test_result_table(spark):
    title, rows = html.read_page(PAGE)
    assert title == "T&x" and rows[1][:3] == ["1,234", "가 나", "A & B"]
    got = html.table_rows(spark.createDataFrame([(1, PAGE), (2, None), (3, "<title>gone</title>")], "page_id long, html string")).orderBy("row").collect()
    assert [tuple(r)[2:] for r in got] == [("1234", "가 나", "A & B", None, "old", "2024-01-05"), ("7", "short", None, None, None, None)]
    assert html.read_page("<title>gone</title>") == ("gone", None)
    with pytest.raises(Exception, match="its title: gone"):
        html.table_rows(spark.createDataFrame([(3, "<title>gone</title>")], "page_id long, html string"), strict=True).collect()


def test_further_pages(spark):
    first = spark.createDataFrame([(1, PAGE + "<p>총 7 건</p>"), (2, PAGE + "<p>총 2 건</p>")], "page_id long, html string")
    assert [tuple(r) for r in crawl.further_pages(first).orderBy("page").collect()] == [(1, 7, 2, 4, 2), (1, 7, 2, 4, 3), (1, 7, 2, 4, 4)]
    with pytest.raises(Exception, match="no total on page 1"):
        crawl.further_pages(spark.createDataFrame([(1, PAGE)], "page_id long, html string")).collect()


def test_prefix_counts_of_odd_tokens(spark):
    words = ["", "a", "ab", "aba", "abab", "ababab", "abé", "é", "éa", "b\U0001f600a", "\U0001f600", "\U0001f600\U0001f600b", "B", " a", None]
    rng = random.Random(3)
    rows = [(i, rng.choices(words, k=rng.randint(0, 9))) for i in range(200)] + [(200, None)]
    seeds, following = "abé\U0001f600", "ab\U0001f600"
    want = collections.Counter()
    for _, tokens in rows:
        heads = [re.match(f"[{seeds}][{following}]{{0,3}}", t) for t in tokens or () if t is not None]
        want.update({h[0][:k] for h in heads if h for k in range(1, len(h[0]) + 1)})
    for unique in (True, False):
        got = prefixes.prefix_counts(spark.createDataFrame(rows, "id long, tokens array<string>"), "id", "tokens", 4, seeds, following, unique)
        assert {r.prefix: r.n for r in got.collect()} == want
    again = prefixes.prefix_counts(spark.createDataFrame(rows + rows, "id long, tokens array<string>"), "id", "tokens", 4, seeds, following)
    assert {r.prefix: r.n for r in again.collect()} == want


def test_collection_stops_at_oversized_queries(spark):
    rows = spark.createDataFrame([(i, ["same"]) for i in range(5)], "id long, tokens array<string>")
    plan = prefixes.split_plan(prefixes.prefix_counts(rows, "id", "tokens"), 3, 3)
    with pytest.raises(ValidationError, match="oversized queries remain: 1"):
        crawl.collect_by_plan(rows, "id", "tokens", plan, 4)
    whole = prefixes.split_plan(prefixes.prefix_counts(rows, "id", "tokens"), 5, 3)
    got = crawl.collect_by_plan(rows, "id", "tokens", whole, 4, page_size=2)
    assert [(r.query_text, r.id, r.page, r.nth) for r in got.orderBy("id").collect()] == [("s*", i, i // 2 + 1, i) for i in range(5)]
    assert tuple(crawl.collection_stats(got, whole).first()) == (1, 0, 3, 5)


@pytest.fixture
def server():
    """Answers /page with a page of Korean text, /search with the query it was sent; each fails first."""
    seen = collections.Counter()

    class Answers(http.server.BaseHTTPRequestHandler):
        def reply(self, body: bytes, kind: str) -> None:
            seen[self.path] += 1
            self.send_response(503 if seen[self.path] == 1 else 404 if "gone" in self.path else 200)
            self.send_header("Content-Type", kind)
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self) -> None:
            self.reply(f"총 1 건 {self.headers['User-Agent']}".encode("cp949"), "text/html; charset=iso-8859-1")

        def do_POST(self) -> None:
            sent = self.rfile.read(int(self.headers["Content-Length"]))
            self.reply(sent.split(b"\r\n\r\n")[1].split(b"\r\n")[0], "application/json")

        def log_message(self, *_) -> None:
            pass

    running = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=running.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{running.server_port}", seen
    running.shutdown()


def test_fetching(spark, server):
    url, seen = server
    how = fetch.Patience(attempts=2, longest=0.01, jitter=0.01)
    asked = spark.createDataFrame([(1,), (2,)], "page int").withColumns({"url": F.lit(f"{url}/page"), "params": fetch.page_params(F.col("page")), "headers": F.create_map(*[F.lit(x) for kv in fetch.page_headers("me").items() for x in kv])})
    assert {(r.page, r.response) for r in fetch.responses(asked, how).collect()} == {(1, "총 1 건 me"), (2, "총 1 건 me")}
    assert sorted(seen.values()) == [2, 2] and any("skind=ALL&sword=&sword2=&page=2" in k for k in seen)
    found = fetch.responses(fetch.search_requests(spark.createDataFrame([("ab*", 3)], "query_text string, page int"), f"{url}/search", "key", 100, "me", "inciName", "ingredient"), how)
    assert json.loads(found.first().response) == {"bool": {"must": [{"text": {"query": "ab*", "fields": ["inciName"], "defaultOperator": "AND"}}, {"term": {"itemType": "ingredient"}}]}}
    with pytest.raises(RuntimeError, match="no answer"):
        fetch.ask(f"{url}/gone", None, None, None, how)
    assert 2 <= fetch.Patience().wait(1) <= 2.7 and fetch.Patience().wait(9) <= 20.7
    assert fetch.search_body("*", "f") == {"bool": {"must": []}}


def test_small_parts(spark, tmp_path):
    assert tables.count_key("a*") == "a*" and tables.count_key("a*", {"b": 1, "a": 2}) == "a*__FORM__[('a', 2), ('b', 1)]"
    assert spark.range(1).select(run_date().alias("d")).first().d == spark.sql("select cast(current_date() as string) d").first().d
    (tmp_path / "x.txt").write_text("text")
    tables.copy_object(spark, f"file://{tmp_path}/x.txt", f"file://{tmp_path}/y.txt")
    assert (tmp_path / "y.txt").read_text() == "text"
    for name in ("a", "b"):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}.csv").write_text("k,v\n" + "".join(f"{name}{i},1\n" for i in range(3)))
    rows = tables.with_order(tables.read_csv(spark, f"{tmp_path}/in"))
    assert [r.k for r in rows.orderBy("_ord").collect()] == ["a0", "a1", "a2", "b0", "b1", "b2"]


def test_bronze_lands_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(t):
        seen.add(1)
        return t

    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string").withColumn("html", told("html"))
    assert bronze_from_pages(pages, "a", "2024-01-05", 2, landing=f"{tmp_path}/landing").count() == 2
    assert seen.value == 1


def test_bronze_from_pages(spark):
    pages = spark.createDataFrame([(2, PAGE.replace("가 나", "late")), (1, PAGE)], "page_id long, html string")
    rows = bronze_from_pages(pages, "a", "2024-01-05", 4).collect()
    assert {(r.ingredient_code, r.std_name_ko) for r in rows} == {("1234", "가 나"), ("7", "short")}
    assert {r.batch_id for r in rows} == {"a_2024-01-05"}
    with pytest.raises(ValidationError, match="expected 5, got 4"):
        bronze_from_pages(pages, "a", "2024-01-05", 5)


def test_bronze_from_payloads(spark):
    item = {"reference": "r", "database": "d", "weight": 1.5, "metadata": {"inciName": [" aqua "], "functionName": ["solvent", " ", "x"], "itemType": "ingredient", "annexNo": []}}
    pages = [("a*", json.dumps({"apiVersion": "1", "totalResults": 2, "results": [item, {"reference": "s", "metadata": None}]})), ("b*", json.dumps({"results": None})), ("c*", "{}")]
    frame = spark.createDataFrame(pages, "query_text string, payload string")
    rows = {r.reference_uuid: r for r in bronze_from_payloads(frame, "b", "2024-01-05", 2).collect()}
    assert len(rows["r"]) == 44
    assert (rows["r"].inci_name, rows["r"].function_names, rows["r"].function_count, rows["r"].item_type, rows["r"].annex_no) == ("aqua", "solvent | x", 3, "ingredient", None)
    assert rows["s"].inci_name is None and rows["s"].function_count == 0 and rows["s"].total_results == 2
    with pytest.raises(ValidationError):
        bronze_from_payloads(frame, "b", "2024-01-05", 3)


def test_validation_order(spark):
    rows = spark.range(3)
    assert validate(spark.range(0), 3).first().message == "no rows"
    assert validate(rows, 4).first().message == "count mismatch: expected 4, got 3"
    assert validate(rows, 4, strict=False).first().is_valid
    assert "missing columns: x" in validate(rows, 3, required=["x"]).first().message
    gate(validate(rows, 3))
    with pytest.raises(ValidationError):
        gate(validate(rows, 2))
    with pytest.raises(ValidationError):
        require_columns(rows, ["nope"])


def test_search_predicate(spark):
    rows = spark.createDataFrame([("Sodium Chloride", "ingredient"), ("Chlorine", "ingredient"), ("Sodium", "other")], "n string, item_type string")
    find = lambda *a, **k: rows.where(payload.search_predicate(*a, **k)).count()
    assert (find("chlor*", "n"), find("sodium chlor*", "n"), find("*", "n"), find("sodium", "n", "other"), find(None, "n", extra=(F.col("n") == "Sodium",))) == (2, 1, 3, 1, 1)


def test_csv_round_trip_and_latest(spark, tmp_path):
    path = tmp_path / "in"
    (path / "ingest_date=2024-01-01").mkdir(parents=True)
    (path / "ingest_date=2024-01-01" / "x.CSV").write_text('﻿ingredient_name,functions,extra\n"a ""q""\nb",NA,1\n', encoding="utf-8")
    assert tables.latest_file(spark, str(path), "2024-01-01").endswith("x.CSV")
    with pytest.raises(FileNotFoundError):
        tables.latest_file(spark, str(path), "2031")
    row = tables.load_right(tables.read_csv(spark, tables.locate(spark, "store", str(path)))).first()
    assert (row.inci_name, row.function_names, row.cas_no) == ('a "q"\nb', None, None)
    other = spark.createDataFrame([("n", "7")], "inci_name string, x_ing_id string")
    assert tables.load_right(other).first().substance_id is None
    assert tables.load_right(other, tables.RIGHT_ALIASES | {"substance_id": ("substance_id", "x_ing_id")}).first().substance_id == "7"
    with pytest.raises(ValidationError):
        tables.load_left(spark.createDataFrame([("1",)], "ingredient_code string"))
    with pytest.raises(ValueError):
        tables.locate(spark, "else", "x")


def test_run_and_save(spark, sf_dir, tmp_path):
    left_registry(spark, sf_dir).drop("_ord").coalesce(1).write.csv(str(tmp_path / "l"), header=True)
    right_registry(spark, sf_dir).drop("_ord").coalesce(1).write.csv(str(tmp_path / "r"), header=True)
    paths = run_and_save(spark, str(tmp_path / "l"), str(tmp_path / "r"), str(tmp_path / "out"))
    read = {k: spark.read.csv(p, header=True) for k, p in paths.items()}
    assert [len(read[k].columns) for k in ("matched", "review", "unmatched", "graph")] == [22, 16, 6, 15]
    s = read["summary"].first()
    assert int(s.left_total) == sum(read[k].count() for k in ("matched", "review", "unmatched"))


def test_bronze_partitions(spark, tmp_path):
    rows = spark.createDataFrame([("1", "d1"), ("2", "d2")], "x string, ingest_date string")
    tables.write_bronze(rows, str(tmp_path / "b"))
    tables.write_bronze(rows.where("ingest_date = 'd1'").withColumn("x", F.lit("9")), str(tmp_path / "b"))
    assert {(r.x, r.ingest_date) for r in spark.read.parquet(str(tmp_path / "b")).collect()} == {("9", "d1"), ("2", "d2")}


def test_recorded_counts(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"a*": 3, "ab*": 2}')
    assert {(r.prefix, r.n) for r in tables.read_counts(spark, str(tmp_path / "c.json")).collect()} == {("a", 3), ("ab", 2)}


def test_arrivals(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    go = lambda: each_arrival(spark, str(tmp_path / "in"), spark.range(0).schema, lambda d: d.selectExpr("id * 2 AS id"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    go()
    spark.range(3, 5).write.mode("append").parquet(str(tmp_path / "in"))
    go()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 2, 4, 6, 8]
