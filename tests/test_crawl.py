"""Whole crawls against services on this machine: pages, retries, rows and statistics."""

import collections
import http.server
import json
import threading
import urllib.parse

import pytest

from recordloom.plans import crawl
from recordloom.plans.reconcile import bronze_from_payloads
from recordloom.sources import fetch, html, pages, payload
from recordloom.sources.counts import CountLog

ROWS = [(k, f"name {k}") for k in range(1, 48)]
NAMES = [f"{a}{b}" for a in ("aqua", "al", "be", "zi") for b in ("", "um", "ox 2", "na", "nb", "nc")]


def page_of(number, size=10, total=None):
    shown = ROWS[(number - 1) * size : number * size]
    body = "".join(f"<tr><td>{k:,}</td><td>국 &amp; {k}</td><td>{n}</td></tr>" for k, n in shown)
    return f"<title>p{number}</title><p>총 {total if total is not None else len(ROWS)} 건</p><table><tr><th>번호</th><th>INCI</th></tr>{body}</table>"


@pytest.fixture
def service():
    """Answers GET with pages of a registry, POST with pages of a search; every third answer is busy, some are not found."""
    seen, held = collections.Counter(), {"total": None, "n": 0}

    class Answers(http.server.BaseHTTPRequestHandler):
        def say(self, text, kind, code=200):
            held["n"] += 1
            code = 503 if code == 200 and held["n"] % 3 == 0 else code
            seen[self.path, code] += 1
            body = text.encode()
            self.send_response(code)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def said(self):
            return {k: v[0] for k, v in urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query, keep_blank_values=True).items()}

        def do_GET(self):
            said = self.said()
            assert (said["skind"], said["sword"], said["sword2"]) == ("ALL", "", "")
            self.say(page_of(int(said["page"]), total=held["total"]) if "none" not in self.path else "<p>nothing</p>", "text/html; charset=utf-8", 404 if "gone" in self.path else 200)

        def do_POST(self):
            said, sent = self.said(), self.rfile.read(int(self.headers["Content-Length"]))
            asked = json.loads(sent.split(b"\r\n\r\n")[1].split(b"\r\n")[0])["bool"]["must"]
            assert asked == [{"text": {"query": said["text"], "fields": ["inciName"], "defaultOperator": "AND"}}, {"term": {"itemType": "ingredient"}}]
            size, number = min(int(said["pageSize"]), 3), int(said["pageNumber"])  # the service has a size of its own
            found = [n for n in NAMES if n.startswith(said["text"].rstrip("*"))]
            results = [{"reference": n, "metadata": {"inciName": [n], "itemType": ["ingredient"]}} for n in found[(number - 1) * size : number * size]]
            self.say(json.dumps({"totalResults": len(found), "pageSize": size, "pageNumber": number, "results": results}), "application/json", 404 if "gone" in self.path else 200)

        def log_message(self, *_):
            pass

    running = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=running.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{running.server_port}", seen, held
    running.shutdown()


FAST = {"longest": 0.01, "jitter": 0.0, "attempts": 6}


def good(seen):
    return collections.Counter({p: n for (p, code), n in seen.items() if code == 200})


@pytest.mark.parametrize("span", [1, 2, 50])
def test_a_whole_registry(spark, service, tmp_path, span):
    url, seen, _ = service
    found, rows = crawl.crawl_registry(spark, f"{url}/list", f"{tmp_path}/pages", span=span, **FAST)
    assert {(int(r.ingredient_code), r.std_name_ko, r.std_name_en, r.page) for r in rows.collect()} == {(k, f"국 & {k}", n, (k - 1) // 10 + 1) for k, n in ROWS}
    assert tuple(found.stats.first()) == (47, 47)
    # the same as asking for a list of pages
    assert {r.page: r.html for r in found.pages.collect()} == {p: page_of(p) for p in range(1, 6)}
    assert sorted(good(seen).values()) == [1] * 5 and any(code == 503 for _, code in seen)


def test_partitions_are_ranges_of_pages(service):
    url, seen, held = service
    reader = pages.RegistryReader({"url": f"{url}/list", "span": "2", "longest": "0.01", "jitter": "0"})
    assert [(p.first, p.last, p.text is not None) for p in reader.partitions()] == [(1, 1, True), (2, 3, False), (4, 5, False)]
    held["total"] = 0
    assert len(reader.partitions()) == 1
    with pytest.raises(ValueError, match="no total"):
        pages.RegistryReader({"url": f"{url}/none", "longest": "0.01", "jitter": "0"}).partitions()
    with pytest.raises(RuntimeError, match="no answer"):
        pages.RegistryReader({"url": f"{url}/gone", "attempts": "2", "longest": "0.01", "jitter": "0"}).partitions()
    with pytest.raises(ValueError, match="url"):
        pages.RegistryReader({})
    # a search that is not found is not asked for again
    before = sum(n for (p, code), n in seen.items() if "gone" in p and code == 404)
    with pytest.raises(RuntimeError, match="no answer"):
        pages.SearchReader({"url": f"{url}/gone", "text": "a*", "item_type": "ingredient", "attempts": "6", "longest": "0.01"}).partitions()
    assert sum(n for (p, code), n in seen.items() if "gone" in p and code == 404) == before + 1


def test_search_pages(spark, service):
    url, seen, _ = service
    pages.register(spark)
    options = {"url": f"{url}/search", "api_key": "k", "text": "al*", "item_type": "ingredient", "page_size": "5", "span": "1", "longest": "0.01", "jitter": "0"}
    got = spark.read.format("search_pages").options(**options).load().orderBy("page").collect()
    assert [r["reference"] for p in got for r in json.loads(p.payload)["results"]] == [n for n in NAMES if n.startswith("al")]
    assert len(got) == 2


def test_a_whole_extraction(spark, service, tmp_path):
    url, seen, _ = service
    api = crawl.Search(f"{url}/search", "k", "me", page_size=50, how=fetch.Patience(attempts=6, longest=0.01, jitter=0.0, only=fetch.BUSY))
    log = CountLog(spark, f"file://{tmp_path}/log")
    done = crawl.extract_search(api, log, 5, 4, "abz", "abeilmnoquxz", folder=f"{tmp_path}/x")
    rows = bronze_from_payloads(done.pages, "b", "2024-01-05").collect()
    plan = {r.prefix + "*" for r in spark.read.parquet(f"{tmp_path}/x/plan").collect()}
    want = collections.Counter((q, n) for q in plan for n in NAMES if n.startswith(q[:-1]))
    assert collections.Counter((r.query_text, r.inci_name) for r in rows) == want and len(plan) > 5
    n_pages = sum(-(-sum(n.startswith(q[:-1]) for n in NAMES) // 3) for q in plan)
    assert tuple(done.stats.first()) == (len(plan), 0, n_pages, sum(want.values()))
    paged = [p for p in good(seen).elements() if "pageSize=1&" not in p]
    assert len(paged) == n_pages  # each page once
    few = crawl.extract_search(api, log, 5, 4, "abz", "abeilmnoquxz", max_queries=2)
    assert {r.query_text for r in few.pages.collect()} == set(sorted(plan)[:2])
    with pytest.raises(Exception, match="oversized queries remain"):
        crawl.extract_search(api, log, 1, 1, "az", "alqi")
    none = crawl.extract_search(api, log, 5, 4, "q", "q")
    assert none.pages.count() == 0 and tuple(none.stats.first()) == (0, 0, 0, 0)


def test_python_and_columns_read_pages_alike(spark):
    from pyspark.sql import functions as F

    from recordloom.functions.text import total_count

    texts = [page_of(1), page_of(9), "", "총 , 건", "결과 1,200 건", "검색결과 7건 총 8 건", "총 총 3 건", "<table><tr><td>1</td></tr><tr><td>x</td></tr><tr></tr></table>"]
    rows = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string")
    assert [r.t for r in rows.select(total_count(F.col("html")).alias("t"), "page_id").orderBy("page_id").collect()] == [html.stated_total(t) for t in texts]
    counts = {r.page_id: r["count"] for r in html.table_rows(rows).groupBy("page_id").count().collect()}
    assert [counts.get(k, 0) for k in range(len(texts))] == [html.count_records(t) for t in texts]


def test_columns_stand_in_their_order(spark):
    rows = bronze_from_payloads(spark.createDataFrame([("a*", '{"results": [{"reference": "x"}]}')], "q string, payload string").withColumnRenamed("q", "query_text"), "b", "2024-01-05")
    assert tuple(rows.columns) == payload.COLUMNS and len(payload.COLUMNS) == 44
