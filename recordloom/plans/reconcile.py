"""The whole runs: two bronze tables and the reconciliation of the registries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean
from ..operators import match, project
from ..operators.dedupe import first_by_key
from ..operators.validate import gate, validate
from ..sources import html, payload, tables
from ..sources.store import landed
from .publish import counted, publish


@dataclass(frozen=True)
class Reconciliation:
    matched: DataFrame
    review: DataFrame
    unmatched: DataFrame
    graph: DataFrame
    summary: DataFrame

    #: What all five filter, and the keyed sides that it is made of, kept in memory and on disk until ``close``.
    kept: tuple[DataFrame, ...]

    def items(self):
        return ((k, v) for k, v in self.__dict__.items() if k != "kept")

    def close(self) -> None:
        """Release what is kept; the tables can still be read, at the cost of matching again."""
        for rows in self.kept:
            rows.unpersist()

    def __enter__(self) -> Reconciliation:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def _landed(rows: DataFrame, folder: str | None) -> DataFrame:
    """``rows``, written to a folder and read from there, if one is given: what made them then runs once."""
    return rows if folder is None else landed(rows, folder)


def _cleaned(rows: DataFrame, source: str, ingest_date: str) -> DataFrame:
    """First row of each code, blank text null, with lineage."""
    ordered = rows.withColumn("_ord", F.struct("page_id", "row"))
    first = first_by_key(ordered, "ingredient_code").select(*[clean(F.col(f)).alias(f) for f in html.FIELDS])
    return project.with_lineage(first, source, ingest_date)


def bronze_from_pages(pages: DataFrame, source: str, ingest_date: str, expected: int | None = None, strict: bool = True, landing: str | None = None) -> DataFrame:
    """Rows of HTML result pages: counted before dedupe, first row of each code, blank text null, with lineage.

    Pages are parsed for the count and again for the result, or once into the folder ``landing``.
    """
    rows = _landed(html.table_rows(pages, strict=True), landing)
    gate(validate(rows, expected if expected is not None else -1, strict and expected is not None))
    return _cleaned(rows, source, ingest_date)


def publish_pages(pages: DataFrame, path: str, source: str, ingest_date: str, expected: int | None = None, strict: bool = True) -> int:
    """Publish the rows of HTML result pages under their date, in one pass; the rows on the pages are counted, before dedupe."""
    raw = counted(html.table_rows(pages, strict=True))
    return publish(_cleaned(raw[0], source, ingest_date), path, ingest_date, expected, strict, raw=raw)


#: Columns that a result table must have.
BRONZE_REQUIRED = ("inci_name", "item_type", "source", "ingest_date", "batch_id")


def bronze_from_payloads(pages: DataFrame, source: str, ingest_date: str, expected: int | None = None, strict: bool = True, landing: str | None = None) -> DataFrame:
    """Flattened results of JSON pages, validated; parsed once if there is a folder ``landing``."""
    rows = _landed(payload.bronze(pages, source, ingest_date), landing)
    gate(validate(rows, expected if expected is not None else -1, strict and expected is not None, BRONZE_REQUIRED))
    return rows


def publish_payloads(pages: DataFrame, path: str, source: str, ingest_date: str, expected: int | None = None, strict: bool = True) -> int:
    """Publish the flattened results of JSON pages under their date, in one pass."""
    return publish(payload.bronze(pages, source, ingest_date), path, ingest_date, expected, strict, BRONZE_REQUIRED)


def reconcile(left: DataFrame, right: DataFrame, limits: match.Thresholds = match.Thresholds(), keep_lineage: bool = False, fold: bool = True, inputs: dict[str, str] | None = None) -> Reconciliation:
    """Five tables from two registries with ``_ord``; the routed frame is persisted, as all five filter it."""
    keyed = match.with_keys(left, "std_name_en", "cas_no", fold).persist()
    other = match.with_keys(right, "inci_name", "cas_no", fold).persist()
    rows = match.routed(keyed, other, "inci_name", project.PAYLOAD, limits).persist()
    matched = project.matched(rows, keep_lineage=keep_lineage)
    return Reconciliation(
        matched, project.review(rows, keep_lineage=keep_lineage), project.unmatched(rows, keep_lineage=keep_lineage), project.graph_map(matched),
        project.summary(rows, right, auto=limits.auto, least=limits.review, inputs=inputs), (rows, keyed, other),
    )


def run_and_save(
    spark: SparkSession, left_path: str, right_path: str, out: str, limits: match.Thresholds = match.Thresholds(), mode: str = "local", date: str | None = None
) -> dict[str, str]:
    """Read two CSV registries, reconcile them and write the five tables; name to path.

    The paths are files (``local``), or folders of a store whose newest CSV is taken, of a date if one is given.
    """
    found = {side: tables.located(spark, mode, path, date) for side, path in (("left", left_path), ("right", right_path))}
    left = tables.with_order(tables.load_left(tables.read_csv(spark, found["left"].path)))
    right = tables.with_order(tables.load_right(tables.read_csv(spark, found["right"].path)))
    inputs = {f"{side}_{what}": value for side, at in found.items() for what, value in (("source_mode", at.mode), ("input_path", at.path), ("store_key", at.key))}
    paths = {}
    with reconcile(left, right, limits, inputs=inputs) as result:
        for name, rows in result.items():
            paths[name] = f"{out}/{name}"
            tables.write_csv(rows, paths[name], render=name != "summary")
    return paths
