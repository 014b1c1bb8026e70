"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import sys
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def ship(module: str) -> None:
    """Send this module's functions to Python workers by value.

    Workers then need no copy of the package on their own path.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder that the cluster names.

    That is ``spark.checkpoint.dir``, or the checkpoint directory of the context.  Only where
    neither is set and everything runs in one process (tests) a folder is chosen here; on a
    cluster each executor would write to its own disk, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext._jsc.sc()
        root = context.getCheckpointDir().get() if context.getCheckpointDir().isDefined() else None
        if not root and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = root or "file:///tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/recordloom-{uuid.uuid4().hex}"


#: Tables that ``materialize`` has written and ``discard`` has not deleted: paths by their last names.
_written: dict[str, str] = {}


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    _written[path.rpartition("/")[2]] = path
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete all tables of ``materialize`` that ``df`` reads; nothing may read them, or ``df``, again.

    Files that others have written stay, wherever they lie.
    """
    spark = df.sparkSession
    for name in {f.rsplit("/", 2)[-2] for f in df.inputFiles() if f.count("/") > 1}:
        path = _written.pop(name, None)
        if path:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more.

    It does so when the driver's garbage is collected, which may otherwise be long after the
    next phase has written its own.  One collection is not enough: what it takes away lets go of
    the shuffles only for the next one, and they are deleted beside it.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def fold(column: Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets into them; null reads as empty."""
    if array.null_count:
        array = array.fill_null("")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    wide = pa.types.is_large_string(array.type)
    _, offsets, data = array.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def texts(array: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each row; null reads as empty."""
    data, at = utf8(array)
    raw = memoryview(data)
    return [bytes(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, after which a worker gives back the memory of its task: the process outlives the task."""

    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # not every C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def append_columns(
    df: DataFrame,
    make: Callable[[], Callable[[pa.Array], list]],
    fields: list[T.StructField],
    text: str = "text",
    most: int = 4 << 20,
) -> DataFrame:
    """``df`` with columns computed from its text column, slice by slice.

    ``make`` runs once in each task and gives the function that maps the texts of a slice
    to the new columns' arrays.  A slice holds about ``most`` bytes of text (one row at
    least) and is sent on before the next is read, so memory follows ``most``, not the
    size of a batch.  Columns of ``df`` with the names of new ones are replaced.
    """
    names = {f.name for f in fields}
    kept = [c for c in df.columns if c not in names]
    spot = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for a, b in slices(utf8(batch.column(spot))[1], most):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, *compute(part.column(spot))], names=[*kept, *(f.name for f in fields)])

    frame = df.select(*kept)
    return frame.mapInArrow(tidy(run), T.StructType([*frame.schema.fields, *fields]))


def slices(at: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each (one row at least)."""
    first, n = 0, len(at) - 1
    while first < n:
        last = int(np.searchsorted(at, at[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHash(dict):
    """64-bit hashes of words, remembered; forgets everything when it grows too large."""

    def __init__(self, most: int = 200_000) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
