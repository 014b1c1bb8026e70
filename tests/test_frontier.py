"""The split plan against a service: what is asked, what is kept, and that the plan is the closed form's."""

import collections
import http.server
import json
import os
import random
import re
import threading
import urllib.parse

import pytest
from pyspark.sql import functions as F

from recordloom import queries
from recordloom.plans import frontier, prefixes
from recordloom.sources import fetch, store, tables
from recordloom.sources.counts import CountLog


def recursion(count, seeds, following, limit, depth):
    """The plan and everything that is asked, by plain recursion."""
    plan, asked = {}, []

    def visit(prefix):
        n = count(prefix)
        asked.append(prefix)
        if 0 < n <= limit:
            plan[prefix] = (n, "final")
        elif n > limit and len(prefix) == depth + 1:
            plan[prefix] = (n, "oversized")
        elif n > limit:
            for c in following:
                visit(prefix + c)

    for s in seeds:
        visit(s)
    return plan, asked


def forest(seed, trees=100, depth=3):
    """A hundred independent inputs, each below a seed of its own: rows of words over few letters."""
    rng = random.Random(seed)
    rows = []
    for k in range(trees):
        head = chr(0x4E00 + k)
        for _ in range(rng.choice((0, 1, 5, 40, 120))):
            rows.append([head + "".join(rng.choices("abc", weights=(6, 2, 1), k=rng.randint(0, depth + 1))) for _ in range(rng.randint(1, 3))])
    return "".join(chr(0x4E00 + k) for k in range(trees)), rows


def counts_of(rows):
    n = collections.Counter()
    for words in rows:
        n.update({w[:k] for w in words for k in range(1, len(w) + 1)})
    return n


def told(spark, counts, seen):
    """A service that knows these counts and notes in a file what it is asked."""

    def ask(df):
        def run(batches):
            for batch in batches:
                with open(seen, "a") as f:
                    f.write("".join(p + "\n" for p in batch["prefix"]))
                yield batch.assign(n=[counts.get(p, 0) for p in batch["prefix"]])[["prefix", "n"]]

        return df.mapInPandas(run, "prefix string, n long")

    return ask


def lines(path):
    return path.read_text().split() if path.exists() else []


def test_plan_and_requests_equal_the_recursion(spark, tmp_path):
    seeds, rows = forest(5)
    counts = dict(counts_of(rows))
    want, asked = recursion(lambda p: counts.get(p, 0), seeds, "abc", 7, 3)
    assert {s for _, s in want.values()} == {"final", "oversized"} and len(asked) > 300
    log = CountLog(spark, f"file://{tmp_path}/log")
    plan = frontier.split_plan_by_asking(told(spark, counts, tmp_path / "seen"), log, 7, 3, seeds, "abc", batch=60)
    assert {r.prefix: (r.n, r.status) for r in plan.collect()} == want
    assert sorted(lines(tmp_path / "seen")) == sorted(asked)
    by = {r.level: (r.asked, r.over) for r in frontier.requests_by_level(frontier.recorded(log), 7).collect()}
    assert by == {k: (sum(len(p) == k for p in asked), sum(len(p) == k and counts.get(p, 0) > 7 for p in asked)) for k in range(1, 5)}
    # the closed form over all counts gives the same, and a second run asks nothing
    closed = prefixes.split_plan(spark.createDataFrame(list(counts.items()), "prefix string, n long"), 7, 3, seeds)
    assert {r.prefix: (r.n, r.status) for r in closed.collect()} == want
    frontier.split_plan_by_asking(told(spark, counts, tmp_path / "again"), log, 7, 3, seeds, "abc")
    assert lines(tmp_path / "again") == []
    few = frontier.split_plan_by_asking(told(spark, counts, tmp_path / "again"), log, 7, 3, seeds, "abc", max_seeds=10)
    assert {r.prefix: (r.n, r.status) for r in few.collect()} == {p: v for p, v in want.items() if p[0] in seeds[:10]}


def test_a_level_does_not_hold_those_above_it(spark, tmp_path):
    seeds, rows = forest(7, 10)
    counts, sizes = dict(counts_of(rows)), []
    answer = told(spark, counts, tmp_path / "seen")

    def ask(df):
        sizes.append(len(df._jdf.queryExecution().optimizedPlan().toString().splitlines()))
        return answer(df)

    frontier.ask_frontier(ask, CountLog(spark, f"file://{tmp_path}/log"), 3, 3, seeds, "abc")
    assert len(sizes) == 4 and len(set(sizes)) == 1


def test_the_counting_service_sends_no_pairs(spark, sf_dir):
    wanted = spark.createDataFrame([("a",), ("th",), ("the",), ("zzzzzzz",)], "prefix string")
    found = queries.counting_service(spark, sf_dir)(wanted)
    assert "doc_id" not in found._jdf.queryExecution().toString()  # counts alone, not documents by prefix
    words = [set(re.split("[^a-z0-9]+", (r.text or "").lower())) for r in queries.table(spark, sf_dir, "documents").collect()]
    assert {r.prefix: r.n or 0 for r in found.collect()} == {p: sum(any(w.startswith(p) for w in ws) for ws in words) for p in ("a", "th", "the", "zzzzzzz")}


def test_counts_survive_a_run_that_is_killed(spark, tmp_path):
    seeds, rows = forest(6, 40)
    counts = dict(counts_of(rows))
    want, asked = recursion(lambda p: counts.get(p, 0), seeds, "abc", 3, 3)
    log, bad = CountLog(spark, f"file://{tmp_path}/log"), next(p for p in asked if len(p) == 3)

    def breaks(df):
        answer = told(spark, counts, tmp_path / "first")(df)
        return answer.withColumn("n", F.when(F.col("prefix") == bad, F.raise_error("gone").cast("long")).otherwise(F.col("n")))

    with pytest.raises(Exception, match="gone"):
        frontier.split_plan_by_asking(breaks, log, 3, 3, seeds, "abc", batch=8)
    kept = {r.prefix for r in frontier.recorded(log).collect()}
    assert any(len(p) == 3 for p in kept) and bad not in kept  # of the level that broke, too
    plan = frontier.split_plan_by_asking(told(spark, counts, tmp_path / "second"), log, 3, 3, seeds, "abc", batch=8)
    assert {r.prefix: (r.n, r.status) for r in plan.collect()} == want
    assert sorted(lines(tmp_path / "second")) == sorted(set(asked) - kept)


def test_log_keeps_the_last_count(spark, tmp_path):
    log = CountLog(spark, f"file://{tmp_path}/log")
    read = lambda: {r.key: r.n for r in log.known().collect()}
    assert read() == {}
    add = lambda at, **n: log.append(spark.createDataFrame([(k, v) for k, v in n.items()], "key string, n long"), at)
    add(5, a=1, b=2)
    add(9, b=0, c=4)
    add(7, a=3, c=9)
    want = {"a": 3, "b": 0, "c": 4}
    assert read() == want
    log.compact()
    assert read() == want and len(store.folders(spark, log.path)) == 1
    add(6, a=8, d=1)  # older than what is known of a
    assert read() == want | {"d": 1}
    # killed after writing, before removing: both are there
    rows = spark.read.parquet(log.path).select("key", "n", "at")
    rows.write.parquet(f"{log.path}/run=copy")
    assert read() == want | {"d": 1}


def test_counts_of_other_form_fields_are_others(spark, tmp_path):
    log = CountLog(spark, f"file://{tmp_path}/log")
    fields = {"item_type": "x"}
    for f, n in ((None, 5), (fields, 50)):
        frontier.ask_frontier(lambda df, n=n: df.withColumn("n", F.lit(n)), log, 10, 0, "ab", "ab", fields=f)
    assert {(r.key, r.n) for r in log.known().collect()} == {(k + t, n) for k in "ab" for t, n in (("*", 5), ("*__FORM__[('item_type', 'x')]", 50))}
    assert {(r.prefix, r.n) for r in frontier.recorded(log, fields).collect()} == {("a", 50), ("b", 50)}
    assert {(r.prefix, r.n) for r in frontier.recorded(log).collect()} == {("a", 5), ("b", 5)}


def test_export_passes_in_order(spark, tmp_path):
    counts = {"ab": 3, "a": 10, 'q"\\': 0, "ü": 7}
    tables.write_counts(spark.createDataFrame(list(counts.items()), "prefix string, n long"), f"{tmp_path}/out")
    (file,) = [f for f in os.listdir(tmp_path / "out") if f.startswith("part")]
    assert json.loads((tmp_path / "out" / file).read_text()) == {k + "*": v for k, v in counts.items()}
    for text in (json.dumps({k + "*": v for k, v in counts.items()}, indent=2), json.dumps({k + "*": v for k, v in counts.items()}), (tmp_path / "out" / file).read_text()):
        (tmp_path / "c.json").write_text(text)
        assert {r.prefix: r.n for r in tables.read_counts(spark, f"{tmp_path}/c.json").collect()} == counts
    tables.write_counts(spark.createDataFrame([], "prefix string, n long"), f"{tmp_path}/none")
    assert tables.read_counts(spark, f"{tmp_path}/none").collect() == []


NAMES = [w for w in ("aqua", "alcohol", "almond oil", "beeswax", "zinc oxide", "zinc", "alum", "alanine", "b2")]


@pytest.fixture
def service():
    """A search service over ``NAMES``: busy at first, gone for one query."""
    seen = collections.Counter()

    class Answers(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            said = urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query)
            text = said["text"][0]
            self.rfile.read(int(self.headers["Content-Length"]))
            seen[text] += 1
            code = 404 if text == "q*" else 503 if seen[text] == 1 and text == "al*" else 200
            found = sum(any(w.startswith(text[:-1]) for w in re.split(r"\s", n)) for n in NAMES)
            body = json.dumps({"totalResults": found, "results": [{}] * int(said["pageSize"][0])}).encode()
            self.send_response(code)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    running = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=running.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{running.server_port}/search", seen
    running.shutdown()


def test_against_a_search_service(spark, tmp_path, service):
    url, seen = service
    how = fetch.Patience(attempts=3, longest=0.01, jitter=0.0, only=fetch.BUSY)
    ask = frontier.search_counts(url, "key", "me", "inciName", how=how)
    plan = frontier.split_plan_by_asking(ask, CountLog(spark, f"file://{tmp_path}/log"), 2, 3, "abz", "abcdefghijklmnopqrstuvwxyz2")
    count = lambda p: sum(any(w.startswith(p) for w in n.split()) for n in NAMES)
    want, asked = recursion(count, "abz", "abcdefghijklmnopqrstuvwxyz2", 2, 3)
    assert {r.prefix: (r.n, r.status) for r in plan.collect()} == want
    assert seen == collections.Counter([p + "*" for p in asked] + ["al*"])  # the busy answer was asked for again
    seen.clear()
    with pytest.raises(Exception, match="no answer"):
        ask(spark.createDataFrame([("q",)], "prefix string")).collect()
    assert fetch.SEARCHING.only == (429, 500, 502, 503, 504)
