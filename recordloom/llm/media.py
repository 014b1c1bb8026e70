"""Media columns: texts stored as GIF pictures, pictures read back, timed frames with colour histograms.

Pictures are made and read in Arrow slices of bounded bytes; nothing is shuffled.  A row's
picture depends on its own text only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import gif
from .common import append_columns, materialize, ship, texts, tidy

ship(__name__)

#: Samples a row of a picture; a payload is a multiple of it.
WIDTH = 64
#: Rows a frame.
ROWS = 512
#: Bytes of pictures that are read at once: a code stream can stand for many times its size.
READ = 256 << 10


def payload(text: bytes) -> bytes:
    """A text's bytes, filled up with zeros to whole rows, one row at least."""
    return text + b"\0" * (-len(text) % WIDTH if text else WIDTH)


def store_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (of the text) and ``media``, a picture whose samples are the text's bytes.

    Null text counts as empty, and an empty text is a picture of one row.  Equal texts have equal
    pictures.  Columns of ``docs`` with the names of new ones are replaced.
    """

    def make() -> Callable[[pa.Array], list]:
        def compute(column: pa.Array) -> list:
            said = texts(column)
            return [pa.array([len(t) for t in said], pa.int64()), pa.array([gif.encode(payload(t), WIDTH, ROWS) for t in said], pa.binary())]

        return compute

    return append_columns(docs, make, [T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())], text)


def read_picture(picture: bytes) -> tuple:
    """Payload, frames, canvas, time and histogram of what frames have drawn; or the fault of a picture that cannot be read."""
    parts, hist, n, wide, high, time = [], np.zeros(64, np.int64), 0, 0, 0, 0
    try:
        for frame in gif.frames(picture):
            drawn = frame.drawn
            high, wide = frame.canvas.shape[:2]
            parts.append(gif.samples_of(drawn).tobytes())
            hist += gif.histogram(drawn)
            n, time = n + 1, frame.start + frame.delay
    except gif.BrokenPicture as e:
        return None, None, None, None, None, None, str(e)
    return b"".join(parts), n, wide, high, 10 * time, hist.tolist(), None


READ_FIELDS = "payload binary, n_frames long, width long, height long, duration_ms long, hist array<long>, fault string"


def read_pictures(rows: DataFrame, media: str = "media") -> DataFrame:
    """``rows`` with what is read back from ``media``, and from nothing else.

    ``payload`` has the samples of all frames in order, for pictures in the colours of ``gif.colours``; ``hist`` counts
    the drawn pixels by colour.  A null picture reads as one without bytes; one that cannot be read has a ``fault`` and
    nulls.  Columns of ``rows`` with the names of new ones are replaced.
    """
    fields = T._parse_datatype_string(READ_FIELDS).fields

    def make() -> Callable[[pa.Array], list]:
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string()]

        def compute(column: pa.Array) -> list:
            read = [read_picture(p) for p in texts(column)]
            return [pa.array([r[k] for r in read], kind) for k, kind in enumerate(kinds)]

        return compute

    return append_columns(rows, make, fields, media, READ)


FRAME_FIELDS = "frame long, start_ms long, delay_ms long, left long, top long, width long, height long, rgba binary, hist array<long>"


def timed_frames(rows: DataFrame, key: str, media: str = "media", most: int = 4 << 20) -> DataFrame:
    """A row for each frame of each picture: ``key``, place and time, the canvas as shown (``rgba``, rows of red, green,
    blue and opacity) and its colour histogram.

    Pictures that cannot be read give the frames before the fault; null ones give none.  Batches hold
    about ``most`` bytes of pixels, one frame at least, so long pictures are never held whole.
    """
    frame = rows.select(F.col(f"`{key}`").alias(key), F.col(f"`{media}`").alias("_media"))
    schema = T.StructType([frame.schema.fields[0], *T._parse_datatype_string(FRAME_FIELDS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def batch(made: list[tuple]) -> pa.RecordBatch:
            types = [kind, *[pa.int64()] * 7, pa.binary(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*made), types)], names=schema.names)

        for given in batches:
            kind = given.column(0).type
            made, held = [], 0
            for name, picture in zip(given.column(0), given.column(1)):
                try:
                    for f in gif.frames(picture.as_py() or b""):
                        high, wide = f.canvas.shape[:2]
                        made.append((name.as_py(), f.nth, 10 * f.start, 10 * f.delay, f.left, f.top, wide, high, f.canvas.tobytes(), gif.histogram(f.canvas).tolist()))
                        held += f.canvas.nbytes
                        if held >= most:
                            yield batch(made)
                            made, held = [], 0
                except gif.BrokenPicture:
                    continue
            if made:
                yield batch(made)

    return frame.mapInArrow(tidy(run), schema)


def report(docs: DataFrame) -> DataFrame:
    """Digests of every document's picture, written to the shared folder, and of what is read back from there.

    ``feature``: canvas, frames, milliseconds and the 64 counts of the colour histogram.
    """
    stored = materialize(store_texts(docs.select("doc_id", "text")).select("doc_id", "n_bytes", "media"))
    read = read_pictures(stored)
    canvas = F.format_string("%dx%d:%d:%d:", "width", "height", "n_frames", "duration_ms")
    return read.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr(f"substring(payload, -{WIDTH}, {WIDTH})")).alias("tail_crc32"), F.octet_length("media").cast("bigint").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        F.concat(canvas, F.array_join(F.col("hist").cast("array<string>"), ",")).alias("feature"),
    )
