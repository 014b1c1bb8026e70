"""Pages of a JSON search result, flattened to one row a result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean
from ..functions.values import count_items, first_or_none, join_list

#: Output column <- JSON name.
ENVELOPE = {
    "api_version": "apiVersion", "terms": "terms", "response_time": "responseTime", "page_number": "pageNumber",
    "page_size": "pageSize", "total_results": "totalResults", "sort": "sort",
}
ITEM = {
    "reference_uuid": "reference", "database": "database", "database_label": "databaseLabel", "language": "language",
    "content_type": "contentType", "weight": "weight",
}
FIRST = {
    "substance_id": "substanceId", "inci_name": "inciName", "common_ingredient_name": "nameOfCommonIngredientsGlossary", "inn_name": "innName",
    "inci_usa_name": "inciUsaName", "chemical_name": "chemicalName", "chemical_description": "chemicalDescription", "cas_no": "casNo", "ec_no": "ecNo",
    "classification_information": "classificationInformation", "item_type": "itemType", "status": "status",
    "official_journal_publication": "officialJournalPublication", "perfuming": "perfuming", "ph_eur_name": "phEurName",
    "es_ingest_date": "esDA_IngestDate", "es_queue_date": "esDA_QueueDate", "current_version": "currentVersion",
    "corporate_search_version": "corporate-search-version",
}
JOINED = {
    "function_names": "functionName", "cosmetic_restriction": "cosmeticRestriction", "other_restrictions": "otherRestrictions",
    "maximum_concentration": "maximumConcentration", "annex_no": "annexNo", "identified_ingredient": "identifiedIngredient",
}

#: The columns of the flattened table in their order; files of it are read by place.
COLUMNS = (
    "reference_uuid", "database", "database_label", "language", "content_type", "weight", "substance_id", "inci_name", "common_ingredient_name", "inn_name",
    "inci_usa_name", "chemical_name", "chemical_description", "cas_no", "ec_no", "function_names", "function_count", "cosmetic_restriction", "other_restrictions",
    "maximum_concentration", "annex_no", "identified_ingredient", "classification_information", "item_type", "status", "official_journal_publication", "perfuming",
    "ph_eur_name", "es_ingest_date", "es_queue_date", "current_version", "corporate_search_version", "raw_metadata",
    "query_text", "api_version", "terms", "response_time", "page_number", "page_size", "total_results", "sort", "source", "ingest_date", "batch_id",
)


def results(pages: DataFrame, payload: str = "payload", query: str = "query_text") -> DataFrame:
    """One row a result: query, envelope fields, and the result as JSON text.  Pages without results give none."""
    fields = ", ".join(f"`{k}`:string" for k in (*ENVELOPE.values(), "results"))
    page = pages.withColumn("_p", F.from_json(payload, f"struct<{fields}>"))
    total = F.coalesce(F.col("_p.totalResults").try_cast("bigint"), F.lit(0))
    envelope = [total.alias(k) if k == "total_results" else F.col(f"_p.{v}").alias(k) for k, v in ENVELOPE.items()]
    return page.select(query, *envelope, F.explode(F.from_json("_p.results", "array<string>")).alias("item"))


def flatten(rows: DataFrame, null_text: str | None = None, scalar_length: bool = False) -> DataFrame:
    """The 33 fields of each result.  ``null_text`` and ``scalar_length`` keep two ways of counting and joining for compatibility."""
    item = rows.withColumn("_i", F.from_json("item", "struct<" + ", ".join(f"`{k}`:string" for k in (*ITEM.values(), "metadata")) + ">"))
    names = (*FIRST.values(), *JOINED.values())
    item = item.withColumn("_m", F.from_json(F.col("_i.metadata"), "struct<" + ", ".join(f"`{k}`:string" for k in names) + ">"))
    meta = lambda v: F.col(f"_m.`{v}`")
    return item.select(
        *[c for c in rows.columns if c != "item"], *[F.col(f"_i.{v}").alias(k) for k, v in ITEM.items()], *[clean(first_or_none(meta(v))).alias(k) for k, v in FIRST.items()],
        *[join_list(meta(v), null_text=null_text).alias(k) for k, v in JOINED.items()], count_items(meta("functionName"), scalar_length).alias("function_count"), F.col("_i.metadata").alias("raw_metadata"),
    )


def bronze(pages: DataFrame, source: str, ingest_date: str, payload: str = "payload", query: str = "query_text") -> DataFrame:
    """44 columns: the flattened result with its page and its lineage."""
    flat = flatten(results(pages, payload, query).withColumnRenamed(query, "query_text"))
    return flat.withColumns({"source": F.lit(source), "ingest_date": F.lit(ingest_date), "batch_id": F.lit(f"{source}_{ingest_date}")}).select(*COLUMNS)


def field_report(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Every field that occurs, by ``level`` (page, result, metadata): how often, its kinds, and whether the flattened table knows it.

    A page is parsed once, to a variant, and its levels are unfolded from there.  Drift shows as
    rows that are not ``known``.  Pages that are no JSON objects count under no field.
    """
    tvf = pages.sparkSession.tvf

    def unfolded(rows: DataFrame, value: str) -> DataFrame:
        fields = rows.lateralJoin(tvf.variant_explode(F.col(value).outer())).where("key IS NOT NULL")
        return fields.select(F.col("key").alias("field"), F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0).alias("kind"))

    page = pages.select(F.try_parse_json(payload).alias("v"))
    item = page.select(F.explode(F.try_variant_get("v", "$.results", "array<variant>")).alias("v"))
    meta = item.select(F.try_variant_get("v", "$.metadata", "variant").alias("v"))
    known = {"page": {*ENVELOPE.values(), "results"}, "result": {*ITEM.values(), "metadata"}, "metadata": {*FIRST.values(), *JOINED.values()}}
    out = None
    for level, rows in (("page", page), ("result", item), ("metadata", meta)):
        seen = unfolded(rows, "v").select(F.lit(level).alias("level"), "field", "kind", F.col("field").isin(*known[level]).alias("known"))
        out = seen if out is None else out.unionByName(seen)
    return out.groupBy("level", "field", "known").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("kind")), " ").alias("kinds"))


def search_predicate(text: str | None, field: str, item_type: str | None = None, kind: str = "item_type", extra: tuple = ()):
    """A conjunction: every word of ``text`` in ``field`` (a trailing ``*`` asks for a prefix of some word), the type, and more."""
    condition = F.lit(True)
    if text and text != "*":
        words = F.split(F.lower(field), r"[^\p{L}\p{N}]+")
        for word in text.lower().split():
            stem = word.rstrip("*")
            condition = condition & _some(words, stem, word.endswith("*"))
    if item_type:
        condition = condition & (F.col(kind) == item_type)
    for clause in extra:
        condition = condition & clause
    return condition


def _some(words, stem: str, prefix: bool):
    return F.exists(words, lambda w: w.startswith(stem) if prefix else w == stem)
