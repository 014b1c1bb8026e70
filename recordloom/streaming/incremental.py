"""Reconciling what arrives, arrival by arrival (an extension: the batch run stays the measure).

What is known after an arrival is kept in tables that only grow: left and right rows with their
keys, the first holder of each right key, exact hits, fuzzy hits and the keys that these were looked for.
Later rows of a table refine earlier ones by a least or greatest, so nothing is rewritten, and an
arrival that is repeated after a failure replaces its own folders.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import match
from ..operators.dedupe import first_by_key
from ..sources import store
from ..sources.tables import with_order


def each_arrival(spark: SparkSession, folder: str, schema: StructType, work: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, form: str = "parquet") -> StreamingQuery:
    """Run ``work`` on the files that have landed since the last run, then stop.

    Each micro-batch replaces its own output folder, so a batch that is repeated after a
    failure leaves no doubles.
    """

    def batch(rows: DataFrame, number: int) -> None:
        work(rows).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return _arrivals(spark, folder, schema, form, checkpoint, batch)


def _arrivals(spark: SparkSession, folder: str, schema: StructType, form: str, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    stream = spark.readStream.schema(schema).format(form).load(folder)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: The stage whose keys are also compared by likeness.
FULL = match.KEYS.index("key_full")


@dataclass(frozen=True)
class Standing:
    """A reconciliation that is kept up with arrivals, in the folder ``path``.

    Rows need an order column ``_ord`` within their arrival; among arrivals the earlier one is
    first.  A left row whose ``left_id`` is known already is not taken again.
    """

    spark: SparkSession
    path: str
    left_name: str = "std_name_en"
    right_name: str = "inci_name"
    cas: str = "cas_no"
    left_id: str = "ingredient_code"
    limits: match.Thresholds = match.Thresholds()

    def arrivals(self) -> list[int]:
        """Numbers of the arrivals that are complete."""
        return [int(f.partition(".")[0]) for f in store.files(self.spark, f"{self.path}/done")]

    def _table(self, name: str, numbers: list[int], schema: StructType) -> DataFrame:
        # folder by folder: Spark takes two scans of one path for the same, whatever was added between them
        paths = [f"{self.path}/{name}/arrival={n}" for n in numbers]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, name: str, number: int) -> DataFrame:
        return store.landed(rows, f"{self.path}/{name}/arrival={number}")

    def arrive(self, number: int, left: DataFrame, right: DataFrame) -> None:
        """Take in new rows of both sides (either may be empty).  A complete arrival is not taken in twice.

        Matched again is only what can change: left rows against keys that no right row held
        before, and left rows that are new against those that were held.  Likeness is
        computed for the same two pairs of sets.
        """
        before = self.arrivals()
        if number in before:
            return
        if before and number < max(before):
            raise ValueError(f"arrival {number} comes after {max(before)}")
        placed = lambda rows: rows.withColumn("_ord", F.struct(F.lit(number).cast("bigint").alias("arrival"), F.col("_ord").alias("place")))

        keyed = match.with_keys(first_by_key(placed(left), self.left_id), self.left_name, self.cas)
        known_left = self._table("left", before, keyed.schema)
        new_left = self._write(keyed.join(known_left.select(self.left_id), self.left_id, "left_anti").select(*keyed.columns), "left", number)
        new_right = self._write(match.with_keys(placed(right), self.right_name, self.cas), "right", number)

        holders = match.first_holders(new_right, self.right_name)
        old_first = self._table("first", before, holders.schema)
        new_first = self._write(holders.join(old_first, ["stage", "key"], "left_anti"), "first", number)
        spread = match.spread(known_left, "_ord"), match.spread(new_left, "_ord")
        again = match.first_hits(spread[0].unionByName(spread[1]), new_first)
        hits = self._write(match.least_hits(again.unionByName(match.first_hits(spread[1], old_first))), "hits", number)

        exact = self._table("hits", before, hits.schema).unionByName(hits)
        rest = known_left.unionByName(new_left).join(exact, "_ord", "left_anti").select(F.col("key_full").alias("key")).where("key IS NOT NULL").distinct()
        asked = self._table("asked", before, rest.schema)
        fresh = self._write(rest.join(asked, "key", "left_anti"), "asked", number)
        texts = lambda first: first.where(F.col("stage") == FULL).select("key", F.col("_right_ord").alias("_ord"))
        near = match.best_fuzzy(asked.unionByName(fresh), texts(new_first), self.limits.cutoff).unionByName(match.best_fuzzy(fresh, texts(old_first), self.limits.cutoff))
        self._write(near, "near", number)
        store.make_folder(self.spark, f"{self.path}/done")
        store.write_text(self.spark, f"{self.path}/done/{number}.json", "{}")

    def routed(self, payload: tuple[str, ...]) -> DataFrame:
        """The routed rows as of now, as ``match.routed`` gives them for all arrivals at once."""
        done = self.arrivals()
        if not done:
            raise ValueError("nothing has arrived")
        read = lambda name: self.spark.read.parquet(*[f"{self.path}/{name}/arrival={n}" for n in done])
        best = F.min_by(F.struct("candidate", "score", "_right_ord"), F.struct(-F.col("score"), F.col("_right_ord")))
        near = read("near").groupBy("key").agg(best.alias("m")).select("key", "m.*")
        return match.assembled(read("left"), read("right"), match.least_hits(read("hits")), near, self.right_name, payload, self.limits)

    def follow(self, side: str, folder: str, left: StructType, right: StructType, checkpoint: str, form: str = "parquet") -> StreamingQuery:
        """Take in the files of one side (``left`` or ``right``) that have landed in a folder since the last run, then stop.

        ``left`` and ``right`` are the schemas of both sides; rows without ``_ord`` go by file and place in it.
        One stream at a time: arrivals are numbered one after another.  A batch that the stream repeats
        after a failure is known by its number in the stream.
        """
        placed = lambda rows: rows if "_ord" in rows.columns else with_order(rows)

        def batch(rows: DataFrame, nth: int) -> None:
            notes, name = f"{self.path}/batches", f"{side}-{nth}.json"
            if name in store.files(self.spark, notes):
                number = int(store.read_text(self.spark, f"{notes}/{name}"))
            else:
                number = max(self.arrivals(), default=-1) + 1
                store.make_folder(self.spark, notes)
                store.write_text(self.spark, f"{notes}/{name}", str(number))
            sides = {"left": self.spark.createDataFrame([], left), "right": self.spark.createDataFrame([], right)} | {side: rows}
            self.arrive(number, placed(sides["left"]), placed(sides["right"]))

        return _arrivals(self.spark, folder, {"left": left, "right": right}[side], form, checkpoint, batch)
