"""Counts of queries as a log: appended task by task while they are asked for, the last one of a key holds."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

FORM = "key string, n bigint, at bigint"


@dataclass(frozen=True)
class CountLog:
    """An append-only table of (key, n, at) in folders, one for each append.

    A task's counts are visible as soon as the task is done, also if the run is killed later,
    so what has been asked is never asked again.
    """

    spark: SparkSession
    path: str

    def __post_init__(self) -> None:
        store.make_folder(self.spark, self.path)

    def _folder(self, at: int) -> str:
        return f"{self.path}/run={at:020d}-{uuid.uuid4().hex}"

    def _read(self, folders: list[str]) -> DataFrame:
        # folder by folder: Spark takes two scans of one path for the same, whatever was added between them
        return self.spark.read.schema(FORM).parquet(*[f"{self.path}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], FORM)

    def known(self) -> DataFrame:
        """``key`` and its last ``n``; of counts of one time the greatest.  Counts appended later are not in this frame."""
        return self._read(store.folders(self.spark, self.path)).groupBy("key").agg(F.max(F.struct("at", "n")).alias("m")).select("key", F.col("m.n").alias("n"))

    def append(self, counts: DataFrame, at: int | None = None) -> None:
        """Add counts (key, n), as of now unless ``at`` says otherwise (nanoseconds)."""
        at = time.time_ns() if at is None else at
        rows = counts.select(F.col("key").cast("string").alias("key"), F.col("n").cast("bigint").alias("n"), F.lit(at).cast("bigint").alias("at"))
        # with the second algorithm a task's file is in place when the task commits, not when the job does
        rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(self._folder(at))

    def compact(self) -> None:
        """One folder in place of all that are there now.

        Counts keep their times, so a run that is killed between writing and removing leaves
        the same answers, and so does one that appends meanwhile.
        """
        old = store.folders(self.spark, self.path)
        if len(old) < 2:
            return
        last = self._read(old).groupBy("key").agg(F.max(F.struct("at", "n")).alias("m")).select("key", F.col("m.n").alias("n"), F.col("m.at").alias("at"))
        last.hint("rebalance").write.parquet(self._folder(time.time_ns()))
        for folder in old:
            store.remove(self.spark, f"{self.path}/{folder}")
