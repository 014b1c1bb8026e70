"""Scratch tables go once nothing reads them; what others wrote stays."""

import os

from recordloom.llm.common import discard, materialize


def tables(folder):
    return {n for n in os.listdir(folder) if n.startswith("recordloom-")}


def test_discard_deletes_own_tables_only(spark, tmp_path):
    own, other = materialize(spark.range(5)), str(tmp_path / f"recordloom-{'0' * 32}")
    spark.range(5).write.parquet(f"{other}/t.parquet")
    both = own.join(spark.read.parquet(f"{other}/t.parquet"), "id")
    assert both.count() == 5
    discard(both)
    assert spark.read.parquet(f"{other}/t.parquet").count() == 5
    assert not any(os.path.exists(os.path.dirname(f.removeprefix("file://"))) for f in own.inputFiles())
    discard(both)  # once more is nothing
    discard(spark.range(3))


def test_pipeline_leaves_only_what_its_result_reads(spark, sf_dir):
    import corpus_pipeline as cp

    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = tables(folder)
    out = cp.run(spark, sf_dir)
    assert out.where("round_trip").count() == out.count() > 0
    assert len(tables(folder) - before) == 1
