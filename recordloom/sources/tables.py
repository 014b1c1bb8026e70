"""Files in and out: all-text CSV with schema resolution, latest snapshot, partitioned sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import na_to_null, nullify
from ..operators.validate import ValidationError

#: The columns of the two registries and the other names they come under.  Callers
#: whose files use further names pass their own table to ``load_right``.
LEFT_REQUIRED = ("ingredient_code", "std_name_ko", "std_name_en", "cas_no")
LEFT_OPTIONAL = ("old_name_ko", "as_of_date", "source", "ingest_date", "batch_id")
RIGHT_ALIASES: dict[str, tuple[str, ...]] = {
    "inci_name": ("inci_name", "std_name_en", "ingredient_name"),
    "substance_id": ("substance_id", "ingredient_id"),
    "cas_no": ("cas_no",),
    "function_names": ("function_names", "functions"),
    "cosmetic_restriction": ("cosmetic_restriction",),
    "other_restrictions": ("other_restrictions",),
    "identified_ingredient": ("identified_ingredient",),
    "status": ("status",),
    "source": ("source",),
    "ingest_date": ("ingest_date",),
    "batch_id": ("batch_id",),
}


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text; quoted line breaks and doubled quotes are read, a byte-order mark is not."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"', encoding="UTF-8")


def resolve(rows: DataFrame, aliases: Mapping[str, Sequence[str]], required: Sequence[str] = ()) -> DataFrame:
    """Canonical columns from the first alias that ``rows`` has; absent ones are null, NA tokens become null."""
    found = {name: next((c for c in options if c in rows.columns), None) for name, options in aliases.items()}
    if missing := [name for name in required if found[name] is None]:
        raise ValidationError(f"missing columns: {', '.join(missing)}")
    return rows.select(*[(na_to_null(F.col(f"`{c}`")) if c else F.lit(None).cast("string")).alias(name) for name, c in found.items()])


def load_left(rows: DataFrame) -> DataFrame:
    return resolve(rows, {c: (c,) for c in (*LEFT_REQUIRED, *LEFT_OPTIONAL)}, LEFT_REQUIRED)


def load_right(rows: DataFrame, aliases: Mapping[str, Sequence[str]] = RIGHT_ALIASES) -> DataFrame:
    """The registry under its canonical names; ``aliases`` has the names to look for, best first."""
    return resolve(rows, aliases, ("inci_name",))


def with_order(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_ord``: the file's path and the place in it, of files that are read whole.

    However files are packed into tasks, rows compare by path first and then as they stand.
    """
    return rows.withColumn("_ord", F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("place")))


def latest_file(spark: SparkSession, folder: str, date: str | None = None, suffix: str = ".csv") -> str:
    """Newest file below a folder whose name ends with ``suffix`` (any case); ties go to the first path."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "modificationTime")
    found = found.where(F.lower("path").endswith(suffix.lower()))
    if date:
        found = found.where(F.col("path").contains(date))
    row = found.orderBy(F.desc("modificationTime"), "path").first()
    if row is None:
        raise FileNotFoundError(f"no {suffix} under {folder}" + (f" for {date}" if date else ""))
    return row.path


@dataclass(frozen=True)
class Located:
    """An input: how it was found, the path to read, and its name below the folder of a store."""

    mode: str
    path: str
    key: str = ""


def located(spark: SparkSession, mode: str, path: str, date: str | None = None) -> Located:
    """The given path (``local``) or the newest object of a folder in a store (``store``)."""
    if mode == "local":
        return Located(mode, path)
    if mode == "store":
        newest = latest_file(spark, path, date)
        return Located(mode, newest, newest.rpartition(f"{path.rstrip('/').rpartition('/')[2]}/")[2])
    raise ValueError(f"unknown input mode {mode!r}")


def locate(spark: SparkSession, mode: str, path: str, date: str | None = None) -> str:
    return located(spark, mode, path, date).path


def write_csv(rows: DataFrame, path: str, single: bool = False, render: bool = True, mark: bool = False) -> None:
    """CSV with a header; ``render`` writes every way of saying "no value" as null, ``mark`` begins files with a byte-order mark."""
    out = rows.select(*[nullify(F.col(c)).alias(c) for c in rows.columns]) if render else rows
    if mark:
        out = out.withColumnRenamed(out.columns[0], "\ufeff" + out.columns[0])
    (out.coalesce(1) if single else out).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_bronze(rows: DataFrame, path: str, form: str = "parquet") -> None:
    """Under ``ingest_date=`` folders, replacing only the dates that ``rows`` has."""
    # few files a date, and a date of very many rows in several
    out = rows.hint("rebalance", "ingest_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date")
    out.csv(path, header=True, quote='"', escape='"') if form == "csv" else out.parquet(path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Recorded counts, a JSON object of ``prefix*`` to number, as rows; one entry a line, or all in one.

    Lines are read on their own, so a large file needs no task that holds it.
    """
    entry = F.concat(F.lit("{"), F.regexp_replace("value", r"^[{,\s]+|[},\s]+$", ""), F.lit("}"))
    raw = spark.read.text(path).select(F.explode(F.from_json(entry, "map<string,bigint>")).alias("query", "n"))
    return raw.select(F.regexp_replace("query", r"\*$", "").alias("prefix"), "n")


def write_counts(counts: DataFrame, path: str) -> None:
    """Counts (``prefix``, ``n``) as one JSON object in one file, an entry a line, for ``read_counts`` and other programs.

    The rows pass through one task in order, which keeps none of them.
    """
    spark = counts.sparkSession
    keyed = counts.select(F.concat("prefix", F.lit("*")).alias("query"), "n")
    first = keyed.agg(F.min("query").alias("first"))  # one row
    entry = F.regexp_replace(F.to_json(F.create_map("query", "n")), r"^\{|\}$", "")
    lines = keyed.crossJoin(F.broadcast(first)).select(F.lit(1).alias("part"), "query", F.concat(F.when(F.col("query") == F.col("first"), "").otherwise(","), entry).alias("value"))
    ends = spark.createDataFrame([(0, "", "{"), (2, "", "}")], "part int, query string, value string")
    lines.unionByName(ends).repartition(1).sortWithinPartitions("part", "query").select("value").write.mode("overwrite").text(path)


def count_key(query: str, fields: Mapping[str, object] | None = None) -> str:
    """The name under which a count is kept (a fixed form): the query, and the sorted form fields if there are any."""
    return f"{query}__FORM__{sorted(fields.items())}" if fields else query


def copy_object(spark: SparkSession, source: str, target: str) -> None:
    """Copy one file between any two stores that Hadoop reaches; frames are written to a store as they are."""
    jvm, conf = spark.sparkContext._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, True, conf)
