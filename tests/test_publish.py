"""Publishing whole tables or nothing, and scratch space."""

import os

import pytest
from pyspark.sql import functions as F

from recordloom.operators.validate import ValidationError
from recordloom.plans import publish
from recordloom.plans.reconcile import publish_pages
from recordloom.sources import store, tables

from .test_plans_sources import PAGE


def rows(spark, n, tag="x"):
    return spark.range(n).select("id", F.lit(tag).alias("tag"))


def seen(spark, path):
    return sorted((r.id, r.tag) for r in publish.read_published(spark, path).collect())


def test_a_key_is_replaced_at_once_and_only_by_runs_that_pass(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, path)
    for bad, kind in ((rows(spark, 0), {}), (rows(spark, 3), {"expected": 4}), (rows(spark, 3), {"required": ["none"]})):
        with pytest.raises(ValidationError):
            publish.publish(bad, path, "d1", **kind)
    assert publish.published_keys(spark, path) == [] and store.folders(spark, f"{path}/data") == [] and store.folders(spark, f"{path}/aside") == []
    assert publish.publish(rows(spark, 3), path, "d1", 3) == 3
    assert publish.publish(rows(spark, 2, "y"), path, "d2", 9, strict=False) == 2
    assert seen(spark, path) == [(0, "x"), (0, "y"), (1, "x"), (1, "y"), (2, "x")]
    before = publish.read_published(spark, path, ["d1"])
    with pytest.raises(ValidationError, match="expected 5, got 1"):
        publish.publish(rows(spark, 1, "z"), path, "d1", 5)
    publish.publish(rows(spark, 1, "z"), path, "d1")
    assert before.count() == 3  # a reader keeps what it has begun to read
    assert publish.published_keys(spark, path) == ["d1", "d2"] and seen(spark, path) == [(0, "y"), (0, "z"), (1, "y")]
    assert len(publish.sweep(spark, path)) == 1 and seen(spark, path) == [(0, "y"), (0, "z"), (1, "y")]


def test_runs_at_one_time_both_count(spark, tmp_path, monkeypatch):
    """Another run publishes between reading the manifest and writing the next one."""
    path, real, once = f"file://{tmp_path}/t", store.move, []

    def meanwhile(spark, source, target):
        if "manifest" in target and not once:
            once.append(1)
            publish.publish(rows(spark, 1, "other"), path, "d2")
        return real(spark, source, target)

    monkeypatch.setattr(store, "move", meanwhile)
    publish.publish(rows(spark, 2), path, "d1")
    assert seen(spark, path) == [(0, "other"), (0, "x"), (1, "x")]


def test_pages_are_parsed_once_and_a_double_count_is_taken_again(spark, tmp_path):
    parsed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(t):
        parsed.add(1)
        return t

    pages = spark.createDataFrame([(2, PAGE.replace("가 나", "late")), (1, PAGE)], "page_id long, html string").withColumn("html", told("html"))
    path = f"file://{tmp_path}/t"
    assert publish_pages(pages, path, "a", "2024-01-05", 4) == 4
    assert parsed.value == 2
    got = publish.read_published(spark, path).collect()
    assert {(r.ingredient_code, r.std_name_ko) for r in got} == {("1234", "가 나"), ("7", "short")}
    with pytest.raises(ValidationError, match="expected 5, got 4"):
        publish_pages(pages, path, "a", "2024-01-06", 5)

    class Twice:
        get = {"n": 8}

    frame = rows(spark, 4)
    assert publish.publish(frame, path, "2024-01-07", 4, raw=(frame, Twice())) == 4


def test_scratch_is_shared_or_refused(spark, monkeypatch):
    assert store.scratch(spark).startswith(spark.conf.get("spark.checkpoint.dir"))

    class Settings:
        def get(self, key, default=None):
            return default if key == "spark.checkpoint.dir" else "file:/here"

    class Context:
        master = "spark://cluster:7077"
        _jsc, _jvm = spark.sparkContext._jsc, spark.sparkContext._jvm

    class Cluster:
        conf, sparkContext, _jsparkSession = Settings(), Context(), spark._jsparkSession

    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        with pytest.raises(RuntimeError, match="checkpoint"):
            store.scratch(Cluster())
        Context.master = "local[2]"
        assert store.scratch(Cluster()).startswith("file:/here/recordloom-")


def test_located(spark, tmp_path):
    (tmp_path / "in" / "d=1").mkdir(parents=True)
    for name, when in (("d=1/b.csv", 2_000_000), ("d=1/a.csv", 1_000_000), ("c.csv", 2_000_000)):
        (tmp_path / "in" / name).write_text("x\n1\n")
        os.utime(tmp_path / "in" / name, (when, when))
    at = tables.located(spark, "store", f"file://{tmp_path}/in", "d=1")
    assert (at.mode, at.key) == ("store", "d=1/b.csv") and at.path.endswith("/in/d=1/b.csv")
    assert tables.located(spark, "store", f"file://{tmp_path}/in/").key == "c.csv"  # of one time the first path
    assert tables.located(spark, "local", "x.csv") == tables.Located("local", "x.csv", "")
