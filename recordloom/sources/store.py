"""Folders in any store that Hadoop reaches: scratch space, small files, listing and removal."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def _at(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def make_folder(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.mkdirs(at)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below, in order."""
    fs, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()) if fs.exists(at) else []


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below, in order."""
    fs, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isFile()) if fs.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename within a store; false if there is something at the target already."""
    fs, at = _at(spark, source)
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    return not fs.exists(to) and fs.rename(at, to)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file; an error if it exists."""
    fs, at = _at(spark, path)
    out = fs.create(at, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def scratch(spark: SparkSession) -> str:
    """A new path that the driver and all executors share, removed when the session's process ends.

    It lies in ``spark.checkpoint.dir`` or the context's checkpoint directory.  Only where neither is
    set and everything runs in one process, the warehouse serves; on a cluster that is an error, as its
    default is a folder of the driver's own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext._jsc.sc()
        if context.getCheckpointDir().isDefined():
            root = context.getCheckpointDir().get()
        elif re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            root = spark.conf.get("spark.sql.warehouse.dir")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{root.rstrip('/')}/recordloom-{uuid.uuid4().hex}"
    fs, at = _at(spark, path)
    fs.deleteOnExit(at)
    return path


def landed(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows``, written once and read from there; what made them does not run again."""
    path = path or scratch(rows.sparkSession)
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
