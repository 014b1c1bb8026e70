"""Tables that become visible whole or not at all: rows are counted while they are written aside, gated, then named in a manifest.

A manifest is one small file that maps keys (an ingest date, say) to folders.  Readers take the
folders of the newest manifest, so a run that fails or is killed leaves nothing to see, and a
key is replaced at once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import ValidationError, missing_columns
from ..sources import store


def counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """``rows``, and their number once something has read them to the end."""
    seen = Observation()
    return rows.observe(seen, F.count("*").alias("n")), seen


def problem(rows: DataFrame, n: int, expected: int | None, strict: bool = True, required: Iterable[str] = ()) -> str | None:
    """What is wrong first: no rows, not as many as expected, missing columns; or None."""
    if not n:
        return "no rows"
    if strict and expected is not None and n != expected:
        return f"count mismatch: expected {expected}, got {n}"
    if missing := missing_columns(rows, required):
        return f"missing columns: {', '.join(missing)}"
    return None


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number and folders of the newest manifest; 0 and none where nothing was published."""
    known = [int(f.partition(".")[0]) for f in store.files(spark, f"{path}/manifest") if f.endswith(".json")]
    return (max(known), json.loads(store.read_text(spark, f"{path}/manifest/{max(known):010d}.json"))) if known else (0, {})


def publish(
    rows: DataFrame, path: str, key: str, expected: int | None = None, strict: bool = True, required: Iterable[str] = (), raw: tuple[DataFrame, Observation] | None = None
) -> int:
    """Write ``rows`` under ``key``, replacing what stood there, if they pass; their number.

    ``raw`` (from ``counted``) is the frame that ``rows`` is made of, where its rows are the
    ones to be counted (before duplicates go, say); else the rows themselves are.  One pass writes and
    counts.  A task that runs twice, as after a lost executor, can count its rows twice, so a count that
    is not the expected one is taken again before it fails the run.  A run that fails raises
    ``ValidationError`` and leaves nothing.
    """
    spark = rows.sparkSession
    source, seen = raw or counted(rows)
    name = uuid.uuid4().hex
    aside = f"{path}/aside/{name}"
    (rows if raw else source).write.parquet(aside)
    n = seen.get["n"]
    if strict and expected is not None and n != expected:
        n = source.count()
    if wrong := problem(rows, n, expected, strict, required):
        store.remove(spark, aside)
        raise ValidationError(wrong)
    store.make_folder(spark, f"{path}/data")
    store.make_folder(spark, f"{path}/manifest")
    store.move(spark, aside, f"{path}/data/{name}")
    while True:  # another run may publish at the same time: the number that is free decides
        number, folders = _manifest(spark, path)
        store.write_text(spark, f"{path}/aside/{name}-{number}.json", json.dumps(folders | {key: name}, ensure_ascii=False))
        if store.move(spark, f"{path}/aside/{name}-{number}.json", f"{path}/manifest/{number + 1:010d}.json"):
            return n


def read_published(spark: SparkSession, path: str, keys: Iterable[str] | None = None) -> DataFrame:
    """The rows of all keys, or of some, as of now."""
    _, folders = _manifest(spark, path)
    chosen = [f for k, f in sorted(folders.items()) if keys is None or k in set(keys)]
    if not chosen:
        raise FileNotFoundError(f"nothing published in {path}")
    return spark.read.parquet(*[f"{path}/data/{f}" for f in chosen])


def published_keys(spark: SparkSession, path: str) -> list[str]:
    return sorted(_manifest(spark, path)[1])


def sweep(spark: SparkSession, path: str) -> list[str]:
    """Remove folders that no manifest of today names and what unfinished runs have left; no run may be under way."""
    kept = set(_manifest(spark, path)[1].values())
    gone = [f for f in store.folders(spark, f"{path}/data") if f not in kept]
    for folder in gone:
        store.remove(spark, f"{path}/data/{folder}")
    store.remove(spark, f"{path}/aside")
    return gone
