"""The columns that the contracts fix, of queries whose other columns SQL cannot express, held against SQL."""

import zlib

import pandas as pd
import pytest

from recordloom.llm import queries, urlfilter

from ..oracle import connect

#: Leftmost matches, dealt into gaps and hits so that places are sums of lengths in code points.
KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(string_split(hit, '.'), lambda p: p::DOUBLE > 255)) = 0"),
    "card": (r"[0-9]([\x20-]?[0-9])+", "length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(string_split(reverse(digits), ''), lambda c, i: CASE WHEN i % 2 = 1 THEN c::INT ELSE c::INT * 2 - CASE WHEN c::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "length(digits) BETWEEN 10 AND 15"),
}


def _found(place, kind, pattern, check):
    return f"""SELECT doc_id, {place} AS place, '{kind}' AS kind, start, start + length(hit) AS upto FROM (
      SELECT doc_id, hits[k] AS hit, regexp_replace(hits[k], '[^0-9]', '', 'g') AS digits, coalesce(list_sum(list_transform(gaps[1:k], lambda g: length(g))), 0) + coalesce(list_sum(list_transform(hits[1:k - 1], lambda h: length(h))), 0) AS start
      FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS k FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS hits, regexp_split_to_array(text, '{pattern}') AS gaps FROM documents WHERE text IS NOT NULL)))
    WHERE {check}"""


FOUND = " UNION ALL ".join(_found(i, k, p, c) for i, (k, (p, c)) in enumerate(KINDS.items()))
SQL = {
    "op3_byte_bpe": "SELECT doc_id, sha256(coalesce(text, '')) AS decoded_sha256 FROM documents",
    "op5_syncmer_fingerprint": """
      WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first(coalesce(text, '')) OVER (ORDER BY doc_id)) AS behind FROM documents)
      SELECT doc_id, length(t) AS n_chars, sha256(left(t, length(t) - length(t) // 2) || left(behind, length(t) // 2)) AS edited_sha256 FROM d""",
    "op7_pii": f"""
      WITH f AS ({FOUND})
      SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in KINDS)}, sha256(coalesce(string_agg(concat_ws(':', kind, start, upto), ',' ORDER BY start, place), '')) AS base_sha256
      FROM documents LEFT JOIN f USING (doc_id) GROUP BY doc_id""",
    "op8_quality_classifier": "SELECT doc_id, crc % 3 = 1 AS held_out FROM documents JOIN folds USING (doc_id)",
    "op9_ppm_score": rf"""
      WITH d AS MATERIALIZED (SELECT doc_id, crc % 5 = 1 AS held_out, list_append(regexp_extract_all(translate(coalesce(text, ''), '{urlfilter.UPPER}', '{urlfilter.LOWER}'), '[^\x20\x09-\x0D]+'), ' ') AS w FROM documents JOIN folds USING (doc_id)),
      said AS MATERIALIZED (SELECT doc_id, held_out, unnest(w) AS word FROM d),
      known AS MATERIALIZED (SELECT word, count(*) AS c FROM said WHERE NOT held_out GROUP BY 1),
      total AS (SELECT sum(c)::BIGINT AS n, count(*) AS v FROM known)
      SELECT doc_id, any_value(held_out) AS held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens, sum(log10((coalesce(c, 0) + 0.5) / (n + 0.5 * (v + 1)))) AS base_score
      FROM said LEFT JOIN known USING (word), total GROUP BY doc_id""",
    "op10_language_id": r"SELECT doc_id, crc % 4 = 2 AS held_out FROM documents JOIN folds USING (doc_id)",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    con = connect(sf_dir)
    ids = [i for (i,) in con.sql("SELECT doc_id FROM documents").fetchall()]
    con.register("folds", pd.DataFrame({"doc_id": ids, "crc": [zlib.crc32(str(i).encode()) for i in ids]}))
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_fixed_columns_equal_sql(spark, con, sf_dir, name):
    want = con.sql(SQL[name]).df().sort_values("doc_id", ignore_index=True)
    got = queries.QUERIES[name](spark, sf_dir).select(*want.columns).toPandas().sort_values("doc_id", ignore_index=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-9)


def test_language_is_undetermined_without_letters(spark, con, sf_dir):
    want = con.sql(r"SELECT doc_id FROM documents WHERE text IS NULL OR NOT regexp_matches(text, '\p{L}') ORDER BY 1").fetchall()
    got = queries.op10_language_id(spark, sf_dir).where("lang_pred = 'und'").orderBy("doc_id").collect()
    assert [(r.doc_id,) for r in got] == want
