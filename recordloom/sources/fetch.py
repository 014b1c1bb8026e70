"""Request rows to response rows: an HTTP source in Arrow batches, with retries.

Requests are data: a frame with ``url``, and if wanted ``params`` and ``headers`` (maps of text)
and ``body`` (bytes, sent by POST).  Every other column passes through, so pages keep the
query and the page number that asked for them.
"""

from __future__ import annotations

import json
import random
import re
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Headers of page requests, beside the caller's user agent.
PAGE_HEADERS = {
    "Accept-Language": "ko-KR,ko;q=0.9,en;q=0.8",
    "Accept": "text/html,application/xhtml+xml,application/xml;q=0.9,*/*;q=0.8",
    "Connection": "keep-alive",
}
#: Answers that are worth another attempt.
BUSY = (429, 500, 502, 503, 504)


@dataclass(frozen=True)
class Patience:
    """Attempts at a request; seconds for each, between them, and after each answer."""

    attempts: int = 5
    timeout: float = 30.0
    longest: float = 20.0
    jitter: float = 0.7
    pause: float = 0.0
    #: Answers to try again; None tries again whatever fails.
    only: tuple[int, ...] | None = None

    def wait(self, attempt: int) -> float:
        return min(2.0**attempt, self.longest) + random.uniform(0, self.jitter)


#: For the search service: only answers that say "busy", and requests without an answer, are tried again.
SEARCHING = Patience(jitter=0.0, only=BUSY)


def page_headers(user_agent: str) -> dict[str, str]:
    return {"User-Agent": user_agent} | PAGE_HEADERS


def page_params(page: Column) -> Column:
    """Parameters that ask for one page of the whole registry."""
    return F.create_map(*[F.lit(x) for x in ("skind", "ALL", "sword", "", "sword2", "", "page")], page.cast("string"))


def decoded(body: bytes, content_type: str | None) -> str:
    """Text in the charset that the answer or the page names; western defaults are not believed."""
    stated = re.search(r"charset=[\"']?([\w-]+)", content_type or "", re.I)
    inside = re.search(rb"charset=[\"']?([\w-]+)", body[:4096], re.I)
    names = [stated and stated[1], inside and inside[1].decode("ascii"), "utf-8", "cp949"]
    for name in names:
        if name and name.lower() != "iso-8859-1":
            try:
                return body.decode(name)
            except (LookupError, UnicodeDecodeError):
                continue
    return body.decode("utf-8", "replace")


def ask(url: str, params: Mapping[str, str] | None, headers: Mapping[str, str] | None, body: bytes | None, how: Patience) -> str:
    """One answer; raises after the last attempt."""
    whole = f"{url}?{urllib.parse.urlencode(dict(params))}" if params else url
    problem: Exception | None = None
    for attempt in range(1, how.attempts + 1):
        try:
            request = urllib.request.Request(whole, data=body, headers=dict(headers or {}))
            with urllib.request.urlopen(request, timeout=how.timeout) as answer:
                text = decoded(answer.read(), answer.headers.get("Content-Type"))
            time.sleep(how.pause)
            return text
        except (OSError, ValueError) as e:
            problem = e
            if how.only is not None and isinstance(e, urllib.error.HTTPError) and e.code not in how.only:
                break
            if attempt < how.attempts:
                time.sleep(how.wait(attempt))
    raise RuntimeError(f"no answer from {url} after {how.attempts} attempts: {problem}")


def responses(requests: DataFrame, how: Patience = Patience(), out: str = "response") -> DataFrame:
    """``requests`` with the text of each answer; a request that fails for good fails the run."""
    kept = [c for c in requests.columns if c != out]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            column = lambda c: batch[c] if c in batch else [None] * len(batch)
            batch[out] = [ask(u, dict(p) if p is not None else None, dict(h) if h is not None else None, b, how) for u, p, h, b in zip(batch["url"], column("params"), column("headers"), column("body"))]
            yield batch[[*kept, out]]

    frame = requests.select(*kept)
    return frame.mapInPandas(run, T.StructType([*frame.schema.fields, T.StructField(out, T.StringType())]))


def search_body(text: str, field: str, item_type: str | None = None, extra: tuple[dict, ...] = ()) -> dict:
    """A conjunction as the search service reads it (fixed values of its wire format): words of ``text`` in ``field``, the type, and more clauses."""
    words = [{"text": {"query": text, "fields": [field], "defaultOperator": "AND"}}] if text and text != "*" else []
    kind = [{"term": {"itemType": item_type}}] if item_type else []
    return {"bool": {"must": [*words, *kind, *extra]}}


def search_form(
    text: str, page: int, page_size: int, api_key: str, user_agent: str, field: str, item_type: str | None = None, extra: tuple[dict, ...] = (), edge: str = ""
) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Parameters, headers and body of one search: the query as a JSON part of a form."""
    edge = edge or uuid.uuid4().hex
    part = f'--{edge}\r\nContent-Disposition: form-data; name="query"; filename="blob"\r\nContent-Type: application/json\r\n\r\n'
    body = (part + json.dumps(search_body(text, field, item_type, extra), ensure_ascii=False) + f"\r\n--{edge}--\r\n").encode()
    headers = {"Accept": "application/json, text/plain, */*", "User-Agent": user_agent, "Content-Type": f"multipart/form-data; boundary={edge}"}
    return {"apiKey": api_key, "text": text, "pageSize": str(page_size), "pageNumber": str(page)}, headers, body


def search_requests(
    queries: DataFrame, url: str, api_key: str, page_size: int | Column, user_agent: str, field: str, item_type: str | None = None, extra: tuple[dict, ...] = ()
) -> DataFrame:
    """Requests for (``query_text``, ``page``)."""
    edge = uuid.uuid4().hex

    @F.pandas_udf(T.BinaryType())
    def form(text: pd.Series) -> pd.Series:
        return text.map(lambda t: search_form(t, 1, 1, "", "", field, item_type, extra, edge)[2])

    texts = {"apiKey": F.lit(api_key), "text": F.col("query_text"), "pageSize": (page_size if isinstance(page_size, Column) else F.lit(page_size)).cast("string"), "pageNumber": F.col("page").cast("string")}
    headers = search_form("", 1, 1, "", user_agent, field, edge=edge)[1]
    return queries.withColumns({
        "url": F.lit(url), "params": F.create_map(*[x for k, v in texts.items() for x in (F.lit(k), v)]),
        "headers": F.create_map(*[F.lit(x) for kv in headers.items() for x in kv]), "body": form("query_text"),
    })
