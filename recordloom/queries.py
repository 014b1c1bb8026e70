"""Every operator of the engine as a query on the driver's tables, with SQL for DuckDB beside it.

Two registries are derived from ``part``: the right one names parts, the left one names the
same parts in ten ways, each meant for another stage of the match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as tx
from .functions.similarity import similarity
from .functions.values import count_items, first_or_none, flag, join_list, run_date
from .operators import match, project
from .operators.dedupe import first_by_key
from .operators.search import search_many
from .operators.validate import ValidationError, count_verdict
from .plans import crawl, frontier, prefixes, publish
from .plans.reconcile import Reconciliation, publish_pages, publish_payloads, reconcile, run_and_save
from .sources import fetch, html, payload, tables
from .sources.counts import CountLog
from .sources.store import landed, scratch
from .streaming.incremental import Standing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DATE = "2024-01-05"


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is one."""

    def take(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return take


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The registries -------------------------------------------------------------------------

FULL_NAME = "concat(p_name, ' ', replace(p_brand, '#', ' '), ' ', p_type, ' ', cast(p_size as {text}))"


def _left_columns(text: str, turned: str) -> dict[str, str]:
    b = FULL_NAME.format(text=text)
    turned = turned.format(b=b)
    key = f"cast(p_partkey as {text})"
    name = f"""CASE p_partkey % 10
      WHEN 0 THEN concat('zq ', {key}, ' vx') WHEN 1 THEN upper(replace({b}, ' ', '  ')) WHEN 2 THEN concat(replace({b}, ' ', '-'), ' (grade a)')
      WHEN 3 THEN concat(substr({b}, 1, instr({b}, ' ') - 1), '. ', substr({b}, instr({b}, ' ') + 1)) WHEN 4 THEN {turned}
      WHEN 5 THEN concat(substr({turned}, 1, instr({turned}, ' ') - 1), ' & ', substr({turned}, instr({turned}, ' ') + 1))
      WHEN 6 THEN concat(substr({b}, 1, 4), substr({b}, 6)) WHEN 7 THEN concat(substr({b}, 1, 3), substr({b}, 8))
      WHEN 8 THEN concat('unrelated item ', cast(p_partkey * 7919 as {text})) END"""
    cas = f"CASE WHEN p_partkey % 10 = 0 THEN concat('CAS No. ', cast(1000 + p_partkey as {text}), '-11-', cast(p_partkey % 10 as {text})) ELSE '-' END"
    return {
        "_ord": "p_partkey", "ingredient_code": key, "std_name_ko": f"concat('name ', {key})", "std_name_en": name, "cas_no": cas, "old_name_ko": f"cast(null as {text})",
        "as_of_date": f"'{DATE}'", "source": "'a'", "ingest_date": f"'{DATE}'", "batch_id": f"'a_{DATE}'",
    }


def _right_columns(text: str) -> dict[str, str]:
    b, none = FULL_NAME.format(text=text), f"cast(null as {text})"
    cas = f"CASE WHEN p_partkey % 2 = 0 THEN concat(cast(1000 + p_partkey as {text}), '-11-', cast(p_partkey % 10 as {text})) ELSE '-' END"
    return {
        "_ord": "p_partkey", "inci_name": f"CASE WHEN p_partkey % 30 <> 0 THEN {b} END", "substance_id": f"concat('S', cast(p_partkey as {text}))", "cas_no": cas, "function_names": "p_type",
        "cosmetic_restriction": none, "other_restrictions": "p_brand", "identified_ingredient": none, "status": "'Active'", "source": "'b'", "ingest_date": f"'{DATE}'", "batch_id": f"'b_{DATE}'",
    }


def _listed(columns: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in columns.items())


def left_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*[f"{v} AS {k}" for k, v in _left_columns("string", "array_join(reverse(split({b}, ' ')), ' ')").items()])


def right_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where("p_partkey % 11 <> 5").selectExpr(*[f"{v} AS {k}" for k, v in _right_columns("string").items()])


TURNED_SQL = "array_to_string(list_reverse(string_split({b}, ' ')), ' ')"
LEFT_SQL = f"SELECT {_listed(_left_columns('varchar', TURNED_SQL))} FROM part"
RIGHT_SQL = f"SELECT {_listed(_right_columns('varchar'))} FROM part WHERE p_partkey % 11 <> 5"

# Keys in DuckDB's dialect ------------------------------------------------------------------

SPACE = r"[\s\x{00A0}\x{3000}]"


def _squeezed(x: str) -> str:
    return rf"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"


def _stripped(x: str) -> str:
    return rf"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_basic(x: str) -> str:
    return f"nullif({_squeezed(f'''lower(CASE WHEN upper({_stripped(x)}) = 'NIACINAMIDE' THEN 'NICOTINAMIDE' ELSE {_stripped(x)} END)''')}, '')"


def _separated(x: str) -> str:
    return _squeezed(rf"regexp_replace({x}, '[/,\-]+', ' ', 'g')")


def _unbracketed(x: str) -> str:
    return _squeezed(rf"regexp_replace({x}, '(?s)\(.*?\)', '', 'g')")


def sql_full(x: str) -> str:
    return f"nullif({_separated(_unbracketed(x))}, '')"


def sql_paren(x: str) -> str:
    for pattern, options in ((r"^\(?[+\-]\)?\s*", ""), (r"^\(?dl\)?\s*[-]?\s*", "i"), (r"^\(?[drls]\)?\s*[-]?\s*", "i")):
        x = f"regexp_replace({x}, '{pattern}', '', '{options}')" if options else f"regexp_replace({x}, '{pattern}', '')"
    x = rf"""regexp_replace({_unbracketed(x)}, '["''`.]', ' ', 'g')"""
    return f"nullif({_separated(f'''regexp_replace({x}, '&+', ' and ', 'g')''')}, '')"


def sql_sorted(x: str) -> str:
    return f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"


def sql_strict(x: str) -> str:
    return rf"nullif(array_to_string(list_sort(list_filter(regexp_split_to_array({x}, '[\s/,\-]+'), lambda w: w <> 'and' AND w <> '')), ' '), '')"


def sql_cas(x: str) -> str:
    bare = _stripped(f"replace(replace({_stripped(x)}, 'CAS No.', ''), 'CAS No', '')")
    return f"CASE WHEN lower({bare}) NOT IN ({', '.join(repr(t) for t in tx.NULL_LIKE)}) THEN regexp_replace({bare}, '{SPACE}+', '', 'g') END"


def _keyed(source: str, name: str, cas: str) -> str:
    """A SELECT with the six keys, one level for each step."""
    return (
        f"SELECT *, {sql_sorted('key_full')} AS key_sorted, {sql_strict('key_paren_removed')} AS key_sorted_strict FROM (SELECT *, {sql_full('key_basic')} AS key_full, {sql_paren('key_basic')} AS key_paren_removed "
        f"FROM (SELECT *, {sql_basic(name)} AS key_basic, {sql_cas(cas)} AS key_cas FROM ({source})))"
    )


BOTH = f"l AS MATERIALIZED ({_keyed(LEFT_SQL, 'std_name_en', 'cas_no')}), r AS MATERIALIZED ({_keyed(RIGHT_SQL, 'inci_name', 'cas_no')})"
LOOKUPS = ", ".join(f"k{i} AS (SELECT {key} AS k, arg_min(_ord, _ord) AS o FROM r WHERE {key} IS NOT NULL GROUP BY 1)" for i, key in enumerate(match.KEYS))
HITS = ", ".join(f"n{i} AS (SELECT k, o FROM k{i} JOIN r ON r._ord = o WHERE inci_name IS NOT NULL)" for i in range(len(match.KEYS)))
CHOICE = "CASE " + " ".join(f"WHEN n{i}.o IS NOT NULL THEN {{{i}}}" for i in range(len(match.KEYS))) + " END"
EXACT = (
    f"exact AS MATERIALIZED (SELECT l.*, {CHOICE.format(*[f'n{i}.o' for i in range(6)])} AS o, {CHOICE.format(*[repr(t) for _, t in match.STAGES])} AS match_type FROM l "
    + " ".join(f"LEFT JOIN n{i} ON n{i}.k = l.{key}" for i, key in enumerate(match.KEYS))
    + ")"
)
CASCADE = f"WITH {BOTH}, {LOOKUPS}, {HITS}, {EXACT}"
#: Levenshtein distance is never above the indel distance, so it may thin the pairs out first.
FUZZY = f"""
WITH RECURSIVE {BOTH}, {LOOKUPS}, {HITS}, {EXACT},
a AS (SELECT DISTINCT key_full AS a FROM exact WHERE o IS NULL AND key_full IS NOT NULL),
b AS (SELECT key_full AS b, min(_ord) AS o FROM r WHERE key_full IS NOT NULL GROUP BY 1),
pairs AS MATERIALIZED (SELECT a, b, o FROM a JOIN b ON abs(length(a) - length(b)) <= (length(a) + length(b)) * 0.1 + 1e-6 WHERE levenshtein(a, b) <= (length(a) + length(b)) * 0.1 + 1e-6),
steps(a, b, i, line) AS (
  SELECT a, b, 0, list_transform(range(length(b) + 1), lambda x: 0) FROM pairs
  UNION ALL
  SELECT a, b, i + 1, list_reduce(list_transform(range(length(b) + 1), lambda j: [j]), lambda acc, x:
    CASE WHEN x[1] = 1 THEN [0, CASE WHEN b[1] = a[i + 1] THEN line[1] + 1 ELSE greatest(line[2], 0) END]
    ELSE list_append(acc, CASE WHEN b[x[1]::INT] = a[i + 1] THEN line[x[1]::INT] + 1 ELSE greatest(line[x[1]::INT + 1], acc[-1]) END) END)
  FROM steps WHERE i < length(a)),
scored AS (SELECT s.a, s.b, p.o, (1 - (length(s.a) + length(s.b) - 2 * line[-1]) / (length(s.a) + length(s.b))::DOUBLE) * 100 AS score FROM steps s JOIN pairs p ON p.a = s.a AND p.b = s.b WHERE i = length(s.a)),
best AS MATERIALIZED (SELECT a, arg_max(b, (score, -o)) AS candidate, max(score) AS score, arg_max(o, (score, -o)) AS o FROM scored WHERE score >= 90 GROUP BY a),
routed AS MATERIALIZED (
  SELECT e.*, best.candidate, best.score, best.o AS fo,
         CASE WHEN e.o IS NOT NULL OR score >= 95 THEN 'matched' WHEN score >= 90 THEN 'review' ELSE 'unmatched' END AS route
  FROM exact e LEFT JOIN best ON e.o IS NULL AND e.key_full = best.a)
"""

# Text -----------------------------------------------------------------------------------------


def keyed_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.with_keys(left_registry(spark, sf_dir), "std_name_en", "cas_no")


def keyed_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.with_keys(right_registry(spark, sf_dir), "inci_name", "cas_no")


@query(f"SELECT c_custkey, nullif({_stripped('c_name')}, '') AS c_name, nullif({_stripped('''CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE concat(' ', c_mktsegment, ' ') END''')}, '') AS segment, 'a' AS source, '{DATE}' AS ingest_date, 'a_{DATE}' AS batch_id FROM customer")
def clean_strings_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    padded = F.when(F.col("c_custkey") % 3 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")))
    return project.with_lineage(rows.select("c_custkey", tx.clean(F.col("c_name")).alias("c_name"), tx.clean(padded).alias("segment")), "a", DATE)


TOKENS = "CASE event_id % 8 WHEN 0 THEN '-' WHEN 1 THEN ' -- ' WHEN 2 THEN 'NaN' WHEN 3 THEN ' none ' WHEN 4 THEN 'NULL' WHEN 5 THEN '' WHEN 6 THEN '0' ELSE concat(' ', event_type, ' ') END"


@query(f"SELECT event_id, CASE WHEN lower(trim(t)) NOT IN ('', '-', '--', 'nan', 'none', 'null') THEN trim(t) END AS value FROM (SELECT event_id, {TOKENS} AS t FROM events)")
def nullify_null_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", tx.nullify(F.expr(TOKENS)).alias("value"))


@query(f"SELECT event_id, CASE WHEN t NOT IN ({', '.join(repr(t) for t in tx.NA_TOKENS)}) THEN t END AS value FROM (SELECT event_id, {TOKENS} AS t FROM events)")
def na_tokens_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", tx.na_to_null(F.expr(TOKENS)).alias("value"))


@query("SELECT doc_id, lang, source, md5(text) AS digest FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents WHERE text IS NOT NULL) WHERE n = 1")
def dedupe_first_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.md5("text").alias("digest"))
    return first_by_key(rows, "digest", "doc_id")


def _key_query(key: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return keyed_left(spark, sf_dir).select("ingredient_code", key)

    QUERIES[key], ORACLES[key] = run, f"WITH {BOTH} SELECT ingredient_code, {key} FROM l"


for _key in match.KEYS:
    _key_query(_key)


@query(f"WITH t AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS nth FROM documents), b AS (SELECT doc_id, nth, {sql_basic('line')} AS key_basic FROM t) SELECT doc_id, nth, key_basic, {sql_full('key_basic')} AS key_full, {sql_paren('key_basic')} AS key_paren_removed FROM b")
def keys_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of free text: every line of each document."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("nth", "line"))
    rows = lines.select("doc_id", F.col("nth").cast("bigint").alias("nth"), tx.basic(F.col("line")).alias("key_basic"))
    return rows.select("doc_id", "nth", "key_basic", tx.full(F.col("key_basic")).alias("key_full"), tx.paren_removed(F.col("key_basic")).alias("key_paren_removed"))


@query("SELECT p_partkey, CASE WHEN upper(p_type) = 'STANDARD' THEN 'plain' WHEN upper(p_type) = 'PROMO' THEN 'offer' ELSE trim(p_type) END AS kind FROM part")
def alias_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", tx.apply_alias(F.col("p_type"), {"STANDARD": "plain", "PROMO": "offer"}).alias("kind"))


DATES = "CASE o_orderkey % 3 WHEN 0 THEN {iso} WHEN 1 THEN concat('of ', replace({iso}, '-', '.')) ELSE 'no date' END"


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN replace({DATES.format(iso='''strftime(o_orderdate, '%Y-%m-%d')''')}, '.', '-') END AS as_of_date FROM orders")
def as_of_date_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = "date_format(o_orderdate, 'yyyy-MM-dd')"
    cells = F.array(*[F.lit(f"c{i} 2020-01-01") for i in range(5)], F.lit("x"), F.expr(DATES.format(iso=iso)), F.lit("y"))
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.as_of_date(cells).alias("as_of_date"))


# Matching ---------------------------------------------------------------------------------------


@query(f"{CASCADE} SELECT ingredient_code, n1.o IS NOT NULL AS found, r.substance_id, CASE WHEN n1.o IS NOT NULL THEN 100.0::DOUBLE END AS match_score FROM l LEFT JOIN n1 ON n1.k = l.key_basic LEFT JOIN r ON r._ord = n1.o")
def exact_match_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match.exact_match(keyed_left(spark, sf_dir), keyed_right(spark, sf_dir), "key_basic", "exact_basic", "inci_name", project.PAYLOAD)
    return rows.select("ingredient_code", F.col("hit").isNotNull().alias("found"), F.col("hit.substance_id").alias("substance_id"), "match_score")


@query(f"{CASCADE} SELECT ingredient_code, match_type, CASE WHEN match_type IS NOT NULL THEN 100.0::DOUBLE END AS match_score, r.substance_id, r.inci_name FROM exact e LEFT JOIN r ON r._ord = e.o")
def match_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match.cascade(keyed_left(spark, sf_dir), keyed_right(spark, sf_dir), "inci_name", project.PAYLOAD)
    return rows.select("ingredient_code", "match_type", "match_score", F.col("hit.substance_id").alias("substance_id"), F.col("hit.inci_name").alias("inci_name"))


@query(f"{CASCADE} SELECT ingredient_code, std_name_en FROM exact WHERE o IS NULL")
def cascade_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match.cascade(keyed_left(spark, sf_dir), keyed_right(spark, sf_dir), "inci_name", project.PAYLOAD)
    return rows.where("hit IS NULL").select("ingredient_code", "std_name_en")


@query(f"{CASCADE} SELECT coalesce(match_type, 'none') AS match_type, count(*) AS n FROM exact GROUP BY 1")
def match_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = match.cascade(keyed_left(spark, sf_dir), keyed_right(spark, sf_dir), "inci_name", project.PAYLOAD)
    return rows.groupBy(F.coalesce("match_type", F.lit("none")).alias("match_type")).agg(F.count("*").alias("n"))


@query(f"{FUZZY} SELECT a AS key, candidate, score FROM best")
def fuzzy_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = keyed_left(spark, sf_dir), landed(keyed_right(spark, sf_dir))  # read by each step
    rest = left.join(match.cascade_keys(left, right, "inci_name"), "_ord", "left_anti").select(F.col("key_full").alias("key"))
    return match.best_fuzzy(rest, right.select(F.col("key_full").alias("key"), "_ord"), 90).drop("_right_ord")


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.routed(keyed_left(spark, sf_dir), keyed_right(spark, sf_dir), "inci_name", project.PAYLOAD)


@query(f"{FUZZY} SELECT ingredient_code, route AS status, coalesce(match_type, CASE WHEN score >= 95 THEN 'fuzzy_auto' END) AS match_type, CASE WHEN route = 'review' THEN score END AS candidate_score FROM routed")
def fuzzy_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed(spark, sf_dir).select("ingredient_code", "status", "match_type", "candidate_score")


@query(f"{FUZZY} SELECT ingredient_code, route AS status, coalesce(match_type, CASE WHEN score >= 95 THEN 'fuzzy_auto' END) AS match_type, CASE WHEN route = 'review' THEN score END AS candidate_score, r.substance_id FROM routed x LEFT JOIN r ON r._ord = coalesce(x.o, CASE WHEN route <> 'unmatched' THEN x.fo END)")
def incremental_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same routes from three arrivals: the right side by ranges of its order, the left side mixed."""
    left, right, standing = left_registry(spark, sf_dir), right_registry(spark, sf_dir), Standing(spark, scratch(spark))
    last = right.agg(F.max("_ord")).first()[0]
    for k in range(3):
        standing.arrive(k, left.where(F.col("_ord") % 3 == k), right.where((F.col("_ord") * 3 > k * last) & (F.col("_ord") * 3 <= (k + 1) * last)))
    rows = standing.routed(project.PAYLOAD)
    return rows.select("ingredient_code", "status", "match_type", "candidate_score", F.col("hit.substance_id").alias("substance_id"))


#: Where the summary says its inputs come from.
INPUTS = {"left_source_mode": "local", "left_input_path": "part", "left_store_key": "", "right_source_mode": "store", "right_input_path": "in/part", "right_store_key": "part"}


def silver(spark: SparkSession, sf_dir: str) -> Reconciliation:
    return reconcile(left_registry(spark, sf_dir), right_registry(spark, sf_dir), inputs=INPUTS)


GRAPH_COLUMNS = """x.ingredient_code, x.std_name_ko, x.std_name_en, x.old_name_ko, CASE WHEN x.o IS NOT NULL THEN x.cas_no END AS left_cas_no, r.inci_name AS canonical_inci_name, r.substance_id AS right_substance_id,
  r.cas_no AS right_cas_no, r.function_names, r.cosmetic_restriction, r.other_restrictions, r.identified_ingredient, r.status, coalesce(x.match_type, 'fuzzy_auto') AS match_type, coalesce(CASE WHEN x.o IS NOT NULL THEN 100.0::DOUBLE END, x.score) AS match_score"""
MATCHED = "FROM routed x JOIN r ON r._ord = coalesce(x.o, x.fo) WHERE route = 'matched'"


@query(f"{FUZZY} SELECT {GRAPH_COLUMNS}, x.source AS left_source, x.ingest_date AS left_ingest_date, x.batch_id AS left_batch_id, CASE WHEN x.o IS NOT NULL THEN r.source END AS right_source, CASE WHEN x.o IS NOT NULL THEN r.ingest_date END AS right_ingest_date, CASE WHEN x.o IS NOT NULL THEN r.batch_id END AS right_batch_id, x.as_of_date {MATCHED}")
def silver_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).matched


@query(f"""{FUZZY} SELECT x.ingredient_code, x.std_name_ko, x.std_name_en, x.old_name_ko, cast(null as varchar) AS left_cas_no, r.inci_name AS candidate_inci_name, r.substance_id AS right_substance_id, r.cas_no AS right_cas_no, x.score AS candidate_score,
  r.function_names, r.cosmetic_restriction, r.other_restrictions, r.identified_ingredient, r.status, 'pending' AS review_decision, x.candidate AS fuzzy_key_review FROM routed x JOIN r ON r._ord = x.fo WHERE route = 'review'""")
def silver_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).review


@query(f"{FUZZY} SELECT ingredient_code, std_name_ko, std_name_en, old_name_ko, cast(null as varchar) AS left_cas_no, as_of_date FROM routed WHERE route = 'unmatched'")
def silver_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).unmatched


@query(f"{FUZZY} SELECT {GRAPH_COLUMNS} {MATCHED}")
def graph_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).graph


@query(f"""{FUZZY} SELECT {", ".join(f"'{v}' AS {k}" for k, v in INPUTS.items())}, count(*) AS left_total, (SELECT count(*) FROM r) AS right_total, count(*) FILTER (route = 'matched') AS matched_final_total, count(*) FILTER (route = 'unmatched') AS unmatched_left_total,
  count(*) FILTER (route = 'review') AS fuzzy_review_total, round(count(*) FILTER (route = 'matched') / nullif(count(*), 0)::DOUBLE * 100, 2) AS match_rate_vs_left, 95::INT AS fuzzy_auto_threshold, 90::INT AS fuzzy_review_threshold FROM routed""")
def mapping_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).summary


@query(f"""{FUZZY} SELECT unnest(['matched', 'review', 'unmatched', 'graph', 'summary']) AS name, unnest([count(*) FILTER (route = 'matched'), count(*) FILTER (route = 'review'), count(*) FILTER (route = 'unmatched'), count(*) FILTER (route = 'matched'), 1]) AS n,
  unnest([sum(o) FILTER (route = 'matched' AND o IS NOT NULL) + sum(fo) FILTER (route = 'matched' AND o IS NULL), sum(fo) FILTER (route = 'review'), 0, sum(o) FILTER (route = 'matched' AND o IS NOT NULL) + sum(fo) FILTER (route = 'matched' AND o IS NULL), 0])::BIGINT AS substances FROM routed""")
def saved_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both registries as CSV files, reconciled and saved; rows of each table read again, and the sum of the right side's numbers in it."""
    folder = scratch(spark)
    for name, rows in (("left", left_registry(spark, sf_dir)), ("right", right_registry(spark, sf_dir))):
        tables.write_csv(rows.orderBy("_ord").drop("_ord"), f"{folder}/{name}", single=True, render=False)
    out = None
    for name, path in run_and_save(spark, f"{folder}/left", f"{folder}/right", f"{folder}/out", mode="store").items():
        rows = tables.read_csv(spark, path)
        number = F.regexp_extract("right_substance_id", "[0-9]+", 0).cast("bigint") if "right_substance_id" in rows.columns else F.lit(0).cast("bigint")
        counted = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(number), F.lit(0)).alias("substances")).select(F.lit(name).alias("name"), "n", "substances")
        out = counted if out is None else out.unionByName(counted)
    return out


def _rendered_sql(column: str) -> str:
    return f"CASE WHEN lower(trim({column}::VARCHAR)) NOT IN ({', '.join(repr(t) for t in tx.NULL_LIKE)}) THEN trim({column}::VARCHAR) END"


@query(f"SELECT {_rendered_sql('event_id')} AS event_id, {_rendered_sql('t')} AS value FROM (SELECT event_id, {TOKENS} AS t FROM events)")
def null_like_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.rendered(table(spark, sf_dir, "events").select("event_id", F.expr(TOKENS).alias("value")))


@query("""WITH RECURSIVE pairs AS MATERIALIZED (SELECT DISTINCT p_name AS a, concat(p_type, ' ', p_brand) AS b FROM part),
steps(a, b, i, line) AS (
  SELECT a, b, 0, list_transform(range(length(b) + 1), lambda x: 0) FROM pairs
  UNION ALL
  SELECT a, b, i + 1, list_reduce(list_transform(range(length(b) + 1), lambda j: [j]), lambda acc, x:
    CASE WHEN x[1] = 1 THEN [0, CASE WHEN b[1] = a[i + 1] THEN line[1] + 1 ELSE greatest(line[2], 0) END]
    ELSE list_append(acc, CASE WHEN b[x[1]::INT] = a[i + 1] THEN line[x[1]::INT] + 1 ELSE greatest(line[x[1]::INT + 1], acc[-1]) END) END)
  FROM steps WHERE i < length(a))
SELECT a, b, (1 - (length(a) + length(b) - 2 * line[-1]) / (length(a) + length(b))::DOUBLE) * 100 AS score FROM steps WHERE i = length(a)""")
def similarity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "part").select(F.col("p_name").alias("a"), F.concat_ws(" ", "p_type", "p_brand").alias("b")).distinct()
    return pairs.select("a", "b", similarity("a", "b").alias("score"))


# Planning ---------------------------------------------------------------------------------------


def document_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.array_distinct(F.split(F.lower("text"), r"[^a-z0-9]+")).alias("tokens"))
    return prefixes.prefix_counts(rows, "doc_id", "tokens", unique=True)


PREFIX_COUNTS = "SELECT prefix, count(DISTINCT doc_id) AS n FROM (SELECT doc_id, w[1:k] AS prefix FROM (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS w FROM documents), (SELECT unnest(range(1, 8)) AS k) WHERE k <= length(w) AND w <> '') GROUP BY 1"


@query(PREFIX_COUNTS)
def prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_prefixes(spark, sf_dir)


PLAN = f"""WITH c AS MATERIALIZED ({PREFIX_COUNTS}), p AS (SELECT c.prefix, c.n, (SELECT count(*) FROM documents) // 10 AS cap, length(c.prefix) AS k, up.n AS above FROM c LEFT JOIN c up ON up.prefix = c.prefix[1:length(c.prefix) - 1] AND length(c.prefix) > 1)
SELECT prefix, n, CASE WHEN n <= cap THEN 'final' ELSE 'oversized' END AS status FROM p WHERE (k = 1 OR above > cap) AND (n <= cap OR k = 7)"""


@query(PLAN)
def prefix_split_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    limit = table(spark, sf_dir, "documents").count() // 10
    return prefixes.split_plan(landed(document_prefixes(spark, sf_dir)), limit)  # read twice


@query(f"""WITH c AS MATERIALIZED ({PREFIX_COUNTS}) SELECT c.prefix, c.n, greatest(c.n - coalesce(d.below, 0), 0)::BIGINT AS residual FROM c LEFT JOIN (SELECT prefix[1:length(prefix) - 1] AS prefix, sum(n) AS below FROM c GROUP BY 1) d ON d.prefix = c.prefix
WHERE c.n > (SELECT count(*) FROM documents) // 10""")
def split_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a split of each prefix over the limit loses at least: rows with a word that ends there, and no longer one."""
    limit = table(spark, sf_dir, "documents").count() // 10
    return prefixes.residual(landed(document_prefixes(spark, sf_dir)), limit)


def counting_service(spark: SparkSession, sf_dir: str) -> frontier.Ask:
    """Answers as a search service would: from an index, made once, of how many documents have a word with a prefix."""
    index = landed(document_prefixes(spark, sf_dir))

    def ask(wanted: DataFrame) -> DataFrame:
        # the index is cut to what is asked before it meets it, so it is not shuffled while little is asked
        return wanted.join(index.join(wanted, "prefix", "left_semi"), "prefix", "left")

    return ask


@query(PLAN)
def remote_split_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same plan from a service that is asked for open prefixes only, level by level."""
    limit = table(spark, sf_dir, "documents").count() // 10
    return frontier.split_plan_by_asking(counting_service(spark, sf_dir), CountLog(spark, scratch(spark)), limit, batch=5000)


@query(f"""WITH c AS MATERIALIZED ({PREFIX_COUNTS}), o AS (SELECT length(prefix) AS level, count(*) AS over FROM c WHERE n > (SELECT count(*) FROM documents) // 10 GROUP BY 1)
SELECT k AS level, CASE WHEN k = 1 THEN 36 ELSE 36 * up.over END::BIGINT AS asked, coalesce(o.over, 0) AS over FROM (SELECT unnest(range(1, 8)) AS k) LEFT JOIN o ON o.level = k LEFT JOIN o up ON up.level = k - 1 WHERE k = 1 OR up.over > 0""")
def split_plan_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many prefixes a plan asks for, by length."""
    limit, log = table(spark, sf_dir, "documents").count() // 10, CountLog(spark, scratch(spark))
    frontier.ask_frontier(counting_service(spark, sf_dir), log, limit, batch=5000)
    return frontier.requests_by_level(frontier.recorded(log), limit)


@query("SELECT p_partkey::VARCHAR AS key, CASE WHEN p_partkey % 3 = 0 THEN p_partkey * 10 ELSE p_size END::BIGINT AS n FROM part")
def count_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of counts that are partly counted again, compacted; the last count of each key."""
    log, rows = CountLog(spark, scratch(spark)), table(spark, sf_dir, "part")
    log.append(rows.where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("key"), F.lit(1).alias("n")), 1)
    log.append(rows.where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("key"), F.col("p_size").alias("n")), 3)
    log.append(rows.where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("key"), (F.col("p_partkey") * 10).alias("n")), 2)
    log.compact()
    return log.known()


@query(f"SELECT prefix, n FROM ({PLAN}) WHERE status = 'final' ORDER BY prefix LIMIT 20")
def first_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty final prefixes: a limit on queries is what the operator does."""
    return prefixes.first_queries(prefix_split_plan(spark, sf_dir), 20).drop("status")


@query("SELECT source, total, pages, unnest(range(1, pages + 1)) AS page FROM (SELECT source, count(*) AS total, ceil(count(*) / 10.0)::BIGINT AS pages FROM documents GROUP BY 1)")
def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("total"))
    return prefixes.pages(totals.withColumn("pages", prefixes.page_count(F.col("total"), F.lit(0)).cast("bigint")), "pages")


def part_plan(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("tokens"))
    counts = prefixes.prefix_counts(rows, "p_partkey", "tokens", unique=True)
    return rows, landed(prefixes.split_plan(landed(counts), table(spark, sf_dir, "part").count() // 8))  # both are read more than once


PART_PLAN = """c AS MATERIALIZED (SELECT prefix, count(DISTINCT p_partkey) AS n FROM (SELECT p_partkey, w[1:k] AS prefix FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part), (SELECT unnest(range(1, 8)) AS k) WHERE k <= length(w)) GROUP BY 1),
f AS MATERIALIZED (SELECT c.prefix FROM c LEFT JOIN c up ON up.prefix = c.prefix[1:length(c.prefix) - 1] AND length(c.prefix) > 1, (SELECT count(*) // 8 AS cap FROM part) WHERE c.n <= cap AND (length(c.prefix) = 1 OR up.n > cap)),
g AS MATERIALIZED (SELECT p_partkey, concat(prefix, '*') AS query_text, row_number() OVER (PARTITION BY prefix ORDER BY p_partkey) - 1 AS nth FROM (SELECT DISTINCT p_partkey, prefix FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) JOIN f ON starts_with(w, f.prefix)))"""


@query(f"WITH {PART_PLAN} SELECT p_partkey, query_text, nth::INT AS nth, (nth // 100 + 1)::BIGINT AS page FROM g")
def collection_by_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, plan = part_plan(spark, sf_dir)
    return crawl.collect_by_plan(rows, "p_partkey", "tokens", plan, prefixes.DEPTH + 1).drop("tokens")


@query(f"WITH {PART_PLAN} SELECT (SELECT count(*) FROM f) AS final_query_count, 0::BIGINT AS oversized_query_count, count(DISTINCT (query_text, nth // 100)) AS raw_page_count, count(*) AS raw_result_count FROM g")
def collection_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, plan = part_plan(spark, sf_dir)
    return crawl.collection_stats(crawl.collect_by_plan(rows, "p_partkey", "tokens", plan, prefixes.DEPTH + 1), plan)


@query("SELECT p_partkey // 10 AS page_id, count(*) * 3 AS total, count(*) AS per_page, 3::BIGINT AS pages, unnest([2, 3])::BIGINT AS page FROM part GROUP BY 1")
def further_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What first pages promise that state three times as many rows as they show."""
    first = part_pages(spark, sf_dir)
    shown = F.size(F.regexp_extract_all("html", F.lit("<tr><td> [0-9]"), F.lit(0)))
    return crawl.further_pages(first.withColumn("html", F.concat("html", F.lit("<p>총 "), (3 * shown).cast("string"), F.lit(" 건</p>"))))


@query("SELECT page_id, 'ALL' AS skind, '' AS sword, '' AS sword2, page_id::VARCHAR AS page FROM pages")
def request_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "pages").select("page_id", fetch.page_params(F.col("page_id")).alias("p"))
    return asked.select("page_id", *[F.col("p")[k].alias(k) for k in ("skind", "sword", "sword2", "page")])


# Files ------------------------------------------------------------------------------------------


@query(f"SELECT _ord AS at, ingredient_code, std_name_ko, std_name_en, nullif(cas_no, '-') AS cas_no, source, batch_id FROM ({LEFT_SQL})")
def csv_sink_and_loader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The left registry written as CSV with a byte-order mark, read again as text, and loaded."""
    path = scratch(spark)
    rows = left_registry(spark, sf_dir).withColumnRenamed("_ord", "at")
    tables.write_csv(rows.select("ingredient_code", "at", *[c for c in rows.columns if c not in ("ingredient_code", "at")]), path, mark=True)
    read = tables.read_csv(spark, path)
    return tables.load_left(read).select(F.col("ingredient_code").cast("bigint").alias("at"), "ingredient_code", "std_name_ko", "std_name_en", "cas_no", "source", "batch_id")


@query("SELECT strftime(o_orderdate, '%Y-%m-01') AS ingest_date, o_orderkey, CASE WHEN year(o_orderdate) % 2 = 0 THEN o_orderstatus ELSE '?' END AS o_orderstatus FROM orders")
def bronze_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders by month, then the months of even years once more: a second run replaces its own dates only."""
    path = scratch(spark)
    rows = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-01").alias("ingest_date"), "o_orderkey", "o_orderstatus")
    tables.write_bronze(rows.withColumn("o_orderstatus", F.lit("?")), path)
    tables.write_bronze(rows.where(F.left("ingest_date", F.lit(4)).cast("int") % 2 == 0), path)
    return spark.read.schema("o_orderkey bigint, o_orderstatus string, ingest_date string").parquet(path).select("ingest_date", "o_orderkey", "o_orderstatus")


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name FROM nation")
def latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest CSV of a date: one of three, neither first nor last by name, among files of other dates and kinds."""
    folder = scratch(spark)
    for name in ("2024-01-05/a", "2024-01-05/c", "2024-01-05/b", "2024-01-06/d"):
        rows = table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.lit(name == "2024-01-05/b"), F.col("n_name")).otherwise(F.lit(name)).alias("n_name"))
        tables.write_csv(rows, f"{folder}/{name}", single=True)
    table(spark, sf_dir, "nation").coalesce(1).write.json(f"{folder}/2024-01-05/e")
    return tables.read_csv(spark, tables.locate(spark, "store", folder, "2024-01-05"))


@query(PREFIX_COUNTS)
def count_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts written as one JSON object and read again."""
    path = scratch(spark)
    tables.write_counts(document_prefixes(spark, sf_dir), path)
    return tables.read_counts(spark, path)


FLAGS = "CASE event_id % 6 WHEN 0 THEN ' Yes ' WHEN 1 THEN 'on' WHEN 2 THEN '0' WHEN 3 THEN 'TRUE' WHEN 4 THEN 'no' END"


@query(f"SELECT event_id, coalesce(lower(trim({FLAGS})) IN ('1', 'true', 'yes', 'y', 'on'), true) AS flag, '{DATE}' AS run_date FROM events")
def option_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", flag(F.expr(FLAGS), True).alias("flag"), run_date(DATE).alias("run_date"))


# Semi-structured sources ------------------------------------------------------------------------


@query("SELECT event_id, (props::JSON ->> 'k') AS first_k, (props::JSON ->> 'k') AS joined_k, CASE WHEN (props::JSON ->> 'k') IS NULL THEN 0 ELSE 1 END::INT AS n_k FROM events")
def json_array_first_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select("event_id", first_or_none(raw).alias("first_k"), join_list(raw).alias("joined_k"), count_items(raw).cast("int").alias("n_k"))


#: Fields of the search pages besides those that ``conversation_pages`` spells out: the name and the role of the turn.
PLAIN = [v for v in (*payload.FIRST.values(), *payload.JOINED.values()) if v not in ("inciName", "itemType", "functionName", "status", "casNo", "annexNo", "otherRestrictions", "substanceId")]
LABELS = [v for v in payload.ITEM.values() if v not in ("reference", "database", "weight")]


def _named(field: str) -> str:
    return f"concat('{field} ', role)"


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON search page for each conversation: its turns as results, the words of a text as functions, every field filled."""
    meta = {
        "inciName": F.array("text"), "itemType": F.lit("ingredient"), "functionName": F.split("text", " "), "status": F.col("role"), "casNo": F.array(F.concat("role", F.lit(" ")), F.lit("x")),
        "annexNo": F.array("role", "role"), "otherRestrictions": F.array().cast("array<string>"), "substanceId": F.col("turn").cast("string"),
    } | {v: F.expr(_named(v)) for v in PLAIN}
    labels = [F.expr(_named(v)).alias(v) for v in LABELS]
    item = F.struct(F.concat_ws("-", "conv_id", "turn").alias("reference"), F.col("role").alias("database"), F.lit(1.5).alias("weight"), *labels, F.struct(*[v.alias(k) for k, v in meta.items()]).alias("metadata"))
    pages = table(spark, sf_dir, "conversations").where("text IS NOT NULL").groupBy("conv_id").agg(F.collect_list(item).alias("results"))
    page = F.struct(
        F.lit("1.0").alias("apiVersion"), F.concat(F.col("conv_id").cast("string"), F.lit("*")).alias("terms"), F.lit(12).alias("responseTime"), F.size("results").alias("totalResults"), F.lit(1).alias("pageNumber"),
        F.lit(100).alias("pageSize"), F.lit("asc").alias("sort"), F.col("results"),
    )
    return pages.select(F.col("conv_id").cast("string").alias("query_text"), F.to_json(page).alias("payload"))


TURNS = rf"SELECT conv_id, turn, role, text, list_filter(list_transform(string_split(text, ' '), lambda w: regexp_replace(w, '^{SPACE}+|{SPACE}+$', '', 'g')), lambda w: w <> '') AS f, len(string_split(text, ' ')) AS k FROM conversations WHERE text IS NOT NULL"
#: Every one of the 44 columns; the one not named here is null in these pages, whose list is empty.
FLAT = {c: _named(v) for c, v in (*payload.FIRST.items(), *payload.JOINED.items(), *payload.ITEM.items()) if v in (*PLAIN, *LABELS)} | {
    "query_text": "conv_id::VARCHAR", "api_version": "'1.0'", "terms": "concat(conv_id, '*')", "response_time": "'12'", "page_number": "'1'", "page_size": "'100'", "sort": "'asc'", "total_results": "count(*) OVER (PARTITION BY conv_id)",
    "reference_uuid": "concat_ws('-', conv_id, turn)", "database": "role", "weight": "'1.5'", "inci_name": f"nullif({_stripped('text')}, '')", "function_names": "nullif(array_to_string(f, ' | '), '')", "function_count": "k::INT",
    "item_type": "'ingredient'", "status": "role", "cas_no": "role", "annex_no": "concat(role, ' | ', role)", "substance_id": "turn::VARCHAR", "source": "'b'", "ingest_date": f"'{DATE}'", "batch_id": f"'b_{DATE}'",
    "raw_metadata": "to_json(struct_pack(inciName := [text], itemType := 'ingredient', functionName := string_split(text, ' '), status := role, casNo := [concat(role, ' '), 'x'], annexNo := [role, role], otherRestrictions := []::VARCHAR[], substanceId := turn::VARCHAR, "
    + ", ".join(f'"{v}" := {_named(v)}' for v in PLAIN) + "))::VARCHAR",
}


@query("SELECT " + ", ".join(FLAT.get(c, "cast(null as varchar)") + f' AS "{c}"' for c in payload.COLUMNS) + f" FROM ({TURNS})")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload.bronze(conversation_pages(spark, sf_dir), "b", DATE)


@query("SELECT conv_id, count(*)::INT AS function_count FROM conversations WHERE text IS NOT NULL GROUP BY 1")
def function_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "conversations").where("text IS NOT NULL").groupBy("conv_id").agg(F.to_json(F.collect_list("text")).alias("raw"))
    return listed.select("conv_id", count_items(F.col("raw")).cast("int").alias("function_count"))


@query(r"""SELECT page_id, i - 1 AS nth, regexp_extract(x, 'href="([^"]*)"', 1) AS href, regexp_extract(x, '(?s)">(.*?)</a>', 1) AS label FROM (SELECT page_id, unnest(m) AS x, generate_subscripts(m, 1) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li><a href="[^"]*">.*?</a></li>') AS m FROM pages))""")
def html_list_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(html.list_links(F.col("html"))).alias("nth", "link"))
    return rows.select("page_id", F.col("nth").cast("bigint").alias("nth"), "link.href", "link.label")


@query(rf"SELECT page_id, nullif({_squeezed('''regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)''')}, '') AS title FROM pages")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html.page_title(F.col("html")).alias("title"))


STATED = "CASE page_id % 4 WHEN 0 THEN concat('총 ', {n}, ' 건') WHEN 1 THEN concat('검색결과 1,', {n}, '건') WHEN 2 THEN concat('결과 ', {n}, ' 건') ELSE '총 , 건' END"


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN 100 + page_id % 900 WHEN 1 THEN 1000 + 100 + page_id % 900 WHEN 2 THEN 100 + page_id % 900 END::BIGINT AS total FROM pages")
def html_total_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The total that each page states, after all else that stands on it."""
    stated = STATED.format(n="cast(100 + page_id % 900 as string)")
    return table(spark, sf_dir, "pages").select("page_id", tx.total_count(F.concat(F.coalesce("html", F.lit("")), F.lit("<p>"), F.expr(stated), F.lit("</p>"))).alias("total"))


def part_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML result pages of ten parts each."""
    cells = F.concat(*[F.concat(F.lit("<td> "), c, F.lit("</td>")) for c in (F.format_number("p_partkey", 0), F.lit("가&amp;나"), F.col("p_name"), F.lit(""), F.col("p_brand"), F.lit("2024.01.05"))])
    row = F.struct("p_partkey", F.concat(F.lit("<tr>"), cells, F.lit("</tr>")).alias("tr"))
    grouped = table(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / 10).alias("page_id")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    body = F.array_join(F.transform("rows", lambda r: r["tr"]), "\n")
    return grouped.select("page_id", F.concat(F.lit("<html><title>x</title><table><tr><td>menu</td></tr></table><table><tr><th>번호</th><th>INCI</th></tr>"), body, F.lit("</table></html>")).alias("html"))


@query("SELECT p_partkey // 10 AS page_id, p_partkey::VARCHAR AS ingredient_code, '가&나' AS std_name_ko, p_name AS std_name_en, cast(null as varchar) AS cas_no, p_brand AS old_name_ko, '2024-01-05' AS as_of_date FROM part")
def html_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.table_rows(part_pages(spark, sf_dir)).drop("row")


@query("""SELECT o_orderkey, expected, got, message IS NULL AS is_valid, coalesce(message, 'OK') AS message FROM (SELECT o_orderkey, 4::BIGINT AS expected, count(l_orderkey) AS got,
  CASE WHEN count(l_orderkey) = 0 THEN 'no rows' WHEN count(l_orderkey) <> 4 THEN concat('count mismatch: expected 4, got ', count(l_orderkey)) END AS message FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)""")
def validate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("got"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey").join(lines, "o_orderkey", "left").select("o_orderkey", F.lit(4).cast("bigint").alias("expected"), F.coalesce("got", F.lit(0)).alias("got"))
    problem = count_verdict(F.col("got"), F.col("expected"))
    return rows.select("o_orderkey", "expected", "got", problem.isNull().alias("is_valid"), F.coalesce(problem, F.lit("OK")).alias("message"))


@query("""SELECT p_partkey::VARCHAR AS ingredient_code, '가&나' AS std_name_ko, p_name AS std_name_en, cast(null as varchar) AS cas_no, p_brand AS old_name_ko, '2024-01-05' AS as_of_date, 'a' AS source, '2024-01-05' AS ingest_date, 'a_2024-01-05' AS batch_id,
  (SELECT concat('count mismatch: expected ', count(*) + 1, ', got ', count(*)) FROM part) AS refused FROM part""")
def published_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages published under a date in one pass; a run for another date that misses its count leaves no row and this message."""
    path, pages, n = scratch(spark), part_pages(spark, sf_dir), table(spark, sf_dir, "part").count()
    publish_pages(pages, path, "a", DATE, n)
    refused = None
    try:
        publish_pages(pages, path, "a", "2024-01-06", n + 1)
    except ValidationError as e:
        refused = str(e)
    return publish.read_published(spark, path).withColumn("refused", F.lit(refused))


@query(f"""SELECT concat_ws('-', conv_id, turn) AS reference_uuid, nullif({_stripped('text')}, '') AS inci_name, 'ingredient' AS item_type, '{DATE}' AS ingest_date, 'b_{DATE}' AS batch_id,
  'no rows' AS empty, (SELECT concat('count mismatch: expected 0, got ', count(*)) FROM conversations WHERE text IS NOT NULL) AS differs, 'missing columns: item_type' AS without FROM conversations WHERE text IS NOT NULL""")
def published_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search pages published under a date, and the messages of three runs that are refused: empty, miscounted, without a column."""
    path, pages = scratch(spark), conversation_pages(spark, sf_dir)
    publish_payloads(pages, path, "b", DATE, table(spark, sf_dir, "conversations").where("text IS NOT NULL").count())
    rows = publish.read_published(spark, path)
    tries = {
        "empty": lambda: publish_payloads(pages.where("false"), path, "b", "2024-01-06", 0),
        "differs": lambda: publish_payloads(pages, path, "b", "2024-01-07", 0),
        "without": lambda: publish.publish(rows.drop("item_type"), path, "2024-01-08", required=("inci_name", "item_type", "source")),
    }
    refused = {}
    for name, run in tries.items():
        try:
            run()
        except ValidationError as e:
            refused[name] = str(e)
    return publish.read_published(spark, path).select("reference_uuid", "inci_name", "item_type", "ingest_date", "batch_id", *[F.lit(refused.get(k)).alias(k) for k in tries])


@query("SELECT p_name AS inci_name, p_partkey::VARCHAR AS substance_id, cast(null as varchar) AS cas_no, p_type AS function_names, cast(null as varchar) AS status FROM part")
def alias_schema_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = table(spark, sf_dir, "part").select(F.col("p_name").alias("ingredient_name"), F.col("p_partkey").cast("string").alias("ingredient_id"), F.col("p_type").alias("functions"), F.lit("x").alias("other"))
    return tables.load_right(renamed).select("inci_name", "substance_id", "cas_no", "function_names", "status")


@query("SELECT conv_id, turn FROM conversations WHERE role = 'user' AND len(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: starts_with(w, 'th'))) > 0")
def search_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").where(payload.search_predicate("th*", "text", "user", "role")).select("conv_id", "turn")


#: A query for each conversation: the first word of its first text, and the beginning of the next one.
ASKED = """SELECT DISTINCT concat(w[1], ' ', {left}(w[2], 2), '*') AS query_text FROM (SELECT {words} AS w FROM conversations WHERE turn = 0 AND text IS NOT NULL) WHERE {size}(w) > 1 AND w[1] <> '' AND w[2] <> ''"""
WORDS_SQL = "regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')"


@query(f"""WITH q AS ({ASKED.format(words=WORDS_SQL, left='left', size='len')} UNION SELECT '*'), r AS (SELECT DISTINCT conv_id * 1000 + turn AS id, {WORDS_SQL} AS w FROM conversations)
SELECT q.query_text, r.id FROM q JOIN r ON q.query_text = '*' OR (list_contains(r.w, string_split(q.query_text, ' ')[1]) AND len(list_filter(r.w, lambda x: starts_with(x, rtrim(string_split(q.query_text, ' ')[2], '*')))) > 0)""")
def search_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns that each of many queries of two words finds, the second by its beginning; and one query that finds all."""
    rows = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text", "turn")
    first = rows.where("turn = 0 AND text IS NOT NULL").select(F.split(F.lower("text"), r"[^\p{L}\p{N}]+").alias("w")).where("size(w) > 1 AND w[0] <> '' AND w[1] <> ''")
    asked = first.select(F.concat(F.col("w")[0], F.lit(" "), F.left(F.col("w")[1], F.lit(2)), F.lit("*")).alias("query_text"))
    once = rows.withColumn("w", F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).dropDuplicates(["id", "w"]).select("id", "text")
    return search_many(once, asked.union(spark.createDataFrame([("*",)], "query_text string")), "id", "text")


#: (level, field, known, how many, kinds) of the fields of ``conversation_pages`` and one more.
FIELDS = [("page", f, True, "c", k) for f, k in (("apiVersion", "STRING"), ("terms", "STRING"), ("responseTime", "BIGINT"), ("totalResults", "BIGINT"), ("pageNumber", "BIGINT"), ("pageSize", "BIGINT"), ("sort", "STRING"), ("results", "ARRAY"))]
FIELDS += [("page", "tookMs", False, "odd", "BIGINT"), *[("result", f, True, "n", k) for f, k in (("reference", "STRING"), ("database", "STRING"), ("weight", "DECIMAL"), ("metadata", "OBJECT"), *[(v, "STRING") for v in LABELS])]]
FIELDS += [("metadata", f, True, "n", "ARRAY") for f in ("inciName", "functionName", "casNo", "annexNo", "otherRestrictions")] + [("metadata", f, True, "n", "STRING") for f in ("itemType", "status", "substanceId", *PLAIN)]


@query(
    "WITH t AS (SELECT count(*) AS n, count(DISTINCT conv_id) AS c, count(DISTINCT conv_id) FILTER (conv_id % 7 = 0) AS odd FROM conversations WHERE text IS NOT NULL) "
    + " UNION ALL ".join(f"SELECT '{level}' AS level, '{field}' AS field, {known} AS known, {n} AS n, '{kinds}' AS kinds FROM t" for level, field, known, n, kinds in FIELDS)
)
def payload_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of all search pages by level, one of them unknown and only on some pages."""
    pages = conversation_pages(spark, sf_dir)
    extra = F.when(F.col("query_text").cast("bigint") % 7 == 0, F.regexp_replace("payload", r"^\{", '{"tookMs":3,')).otherwise(F.col("payload"))
    return payload.field_report(pages.withColumn("payload", extra))
