"""The ``opN_*`` queries and the pipeline, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, dialogue, infill, language, media, ngram_join, pii, ppm, quality, substrings, syncmers, urlfilter
from .common import fold, table


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), ngram_join.Link(4, 85, 100))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document outside 20-word windows that stand earlier elsewhere."""
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"), 20, digest=True)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of every document under the multilingual byte-level vocabulary."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).drop("text")


#: The rules of op4.
RULES = [
    urlfilter.Rule("com", "/", "allow"),
    urlfilter.Rule("example.com", "/en/", "block"),
    urlfilter.Rule("www.example.com", "/en/", "allow"),
    urlfilter.Rule("net", "/es/", "block"),
    urlfilter.Rule("net", "/fr/", "block"),
]
#: The blocked domains of op4: each name under each of the three domains of the corpus, and every host of the pages
#: whose md5 begins with a digit below ``LISTED`` (a quarter), as a list of a fair share of the corpus.
LISTED = "4"
BLOCKED = [f"{name}.example.{top}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: the rules first, then the blocked domains."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = pages.select(urlfilter.host_of(F.col("url")).alias("key")).where((F.col("key") != "") & (F.left(F.md5("key"), F.lit(1)) < LISTED))
    listed = spark.createDataFrame([(k,) for k in BLOCKED], "key string").union(hosts)
    return urlfilter.judge_urls(pages, RULES, listed).drop("url")


OP4_SQL = rf"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(host, path, verdict) AS (VALUES {", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)}),
blocked(k) AS MATERIALIZED (SELECT * FROM (VALUES {", ".join(f"('{k}')" for k in BLOCKED)}) UNION SELECT host FROM parts WHERE host <> '' AND left(md5(host), 1) < '{LISTED}'),
named AS (
  SELECT page_id, p.host, p.path,
         (SELECT max(struct_pack(n := length(r.host || r.path), name := r.host || r.path, verdict := r.verdict)) FROM rules r
          WHERE (p.host = r.host OR suffix(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS best
  FROM parts p)
SELECT page_id, host, path, best.name AS rule,
       coalesce(best.verdict, CASE WHEN EXISTS (SELECT 1 FROM blocked WHERE host = k OR suffix(host, '.' || k)) THEN 'block' ELSE 'allow' END) AS verdict
FROM named
"""


def op5_syncmer_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return syncmers.fingerprint(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item."""
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "spans")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans and what the labelers add."""
    return pii.report(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from rows whose fold is not 1 of 3."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    rows = quality.training_rows(docs, labels, fold(F.col("doc_id"), 3) != 1)
    net = quality.fit([t for t, _ in rows], [y for _, y in rows])
    scored = quality.score_documents(docs, net).drop("text")
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by a byte trie and a word baseline, learned from rows whose fold is not 1 of 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = ppm.score_documents(docs, fold(F.col("doc_id"), 5) != 1)
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows whose fold is not 2 of 4."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    known = language.learn(docs, fold(F.col("doc_id"), 4) != 2)
    named = language.identify(docs.select("doc_id", "text"), known)
    return named.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into lines, its middle moved to the end, and rebuilt from that."""
    return infill.report(table(spark, sf_dir, "documents"))


def op12_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as a GIF picture, read back, with its colour histogram."""
    return media.report(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every conversation, after faults were dealt out among its rows."""
    return dialogue.repair(dialogue.damage(table(spark, sf_dir, "conversations"))).conversations


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_url_filter": op4_url_filter,
    "op5_syncmer_fingerprint": op5_syncmer_fingerprint,
    "op6_decontamination": op6_decontamination,
    "op7_pii": op7_pii,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_ppm_score": op9_ppm_score,
    "op10_language_id": op10_language_id,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_gif_media": op12_gif_media,
    "op13_conversation_repair": op13_conversation_repair,
}

OP1_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{urlfilter.UPPER}', '{urlfilter.LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[k:k + 3], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
link AS MATERIALIZED (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * shared >= 85 * (na.n + nb.n - shared)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(reach.b) AS component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id
"""

OP2_SQL = r"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, k, array_to_string(w[k:k + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS k FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY g ORDER BY doc_id, k) AS nth FROM windows) WHERE nth > 1),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS p FROM later),
said AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT s.doc_id, string_agg(word, ' ' ORDER BY s.p) AS text FROM said s ANTI JOIN gone g ON g.doc_id = s.doc_id AND g.p = s.p GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(r.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1) r ON r.doc_id = d.doc_id
"""

_SAID = rf"regexp_extract_all(translate(coalesce(text, ''), '{urlfilter.UPPER}', '{urlfilter.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP6_SQL = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, {_SAID} AS w FROM documents),
i AS (SELECT item_id, {_SAID} AS w FROM benchmark),
win AS MATERIALIZED (SELECT DISTINCT item_id::VARCHAR AS item, array_to_string(w[k:k + 9], ' ') AS g, least(len(w), 10) AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
spots AS (SELECT doc_id, w, s, unnest(range(1, len(w) - s + 2)) AS k FROM d, (SELECT DISTINCT s FROM win) WHERE len(w) >= s),
hit AS MATERIALIZED (SELECT doc_id, k, spots.s, item FROM spots JOIN win ON win.s = spots.s AND win.g = array_to_string(w[k:k + spots.s - 1], ' ')),
places AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(k, k + s)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS l FROM hit GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(l), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN places ON places.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(u[1:least(x, y)], '') AS pre, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS mid, array_to_string(u[greatest(x, y) + 1:], '') AS suf FROM k)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


def _edit(way: str, cost: str, edit: str, line: str | None = None) -> str:
    """A way (cost, edits, lines) with one more edit; null stays null."""
    lines = f"list_append({way}.l, {line})" if line else f"{way}.l"
    return f"CASE WHEN {way} IS NOT NULL THEN struct_pack(c := {way}.c + {cost}, a := {way}.a || '{edit}', l := {lines}) END"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _stays(before: str, initial: str, role: str) -> list[str]:
    """Ways by which a row follows the state ``before``: kept with the right initial, or with another role."""
    keep = f"CASE WHEN left(role, 1) = '{initial}' AND f NOT IN (1, 2) THEN {_edit(before, 'extra', 'K', chr(39).join(['role || ', ':', ' || text']))} END"
    return [keep] + ([f"CASE WHEN f NOT IN (1, 2) THEN {_edit(before, '1 + extra', 'R', f'{chr(39)}{role}:{chr(39)} || text')} END"] if role else [])


#: crc32 bit by bit; then the four states' cheapest ways row after row (n: nothing, s: system, u: user, a: assistant).
OP13_SQL = rf"""
WITH RECURSIVE fated AS MATERIALIZED (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::UBIGINT)),
      lambda acc, x: list_reduce(list_concat([xor(acc, x)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda b, z: CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384::UBIGINT) ELSE b >> 1 END)), 4294967295::UBIGINT) % 20 AS fate
  FROM conversations),
said AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM fated WHERE fate <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM said),
r AS MATERIALIZED (
  SELECT *, CASE f WHEN 3 THEN 5 ELSE 0 END AS extra, left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair FROM (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                   WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS f FROM placed)),
ways(conv_id, i, n, s, u, a) AS (
  SELECT conv_id, 0::BIGINT, struct_pack(c := 0::BIGINT, a := '', l := []::VARCHAR[]), NULL::STRUCT(c BIGINT, a VARCHAR, l VARCHAR[]), NULL::STRUCT(c BIGINT, a VARCHAR, l VARCHAR[]), NULL::STRUCT(c BIGINT, a VARCHAR, l VARCHAR[]) FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {_edit("n", "2", "D")}, {_least(_edit("s", "2", "D"), *_stays("n", "s", ""))}, {_least(_edit("u3", "2", "D"), *_stays("n", "u", "user"), *_stays("s", "u", "user"), *_stays("a2", "u", "user"))}, {_least(_edit("a2", "2", "D"), *_stays("u3", "a", "assistant"))}
  FROM (SELECT *, {_least("u2", _edit("a2", "5", "I", "'user:'"))} AS u3 FROM (SELECT *, {_least("a", _edit("u2", "5", "I", "'assistant:'"))} AS a2 FROM (
    SELECT w.conv_id, r.i, r.role, r.text, r.f, r.extra, w.n, w.s, w.a, {_least("w.u", _edit("w.n", "5", "I", "'user:'"), _edit("w.s", "5", "I", "'user:'"), _edit("w.a", "5", "I", "'user:'"))} AS u2
    FROM ways w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1)))),
best AS (
  SELECT conv_id, {_least("n", "a", _edit("u", "5", "I", "'assistant:'"), "CASE WHEN s IS NOT NULL THEN struct_pack(c := s.c + 10, a := s.a || 'II', l := s.l || ['user:', 'assistant:']) END")} AS b
  FROM ways w WHERE i = (SELECT count(*) FROM r WHERE r.conv_id IS NOT DISTINCT FROM w.conv_id)),
sums AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (f = 1) AS blank, count(*) FILTER (f = 2) AS duplicate, count(*) FILTER (f = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY 1)
SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, b.c::BIGINT AS cost, b.a AS audit, sha256(array_to_string(b.l, chr(10))) AS repaired_sha256
FROM (SELECT conv_id, unnest([b]) AS b FROM best) b LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM b.conv_id
"""

ORACLES: dict[str, str] = {"op1_ngram_jaccard": OP1_SQL, "op2_substring_dedup": OP2_SQL, "op4_url_filter": OP4_SQL, "op6_decontamination": OP6_SQL, "op11_fill_in_middle": OP11_SQL, "op13_conversation_repair": OP13_SQL}
