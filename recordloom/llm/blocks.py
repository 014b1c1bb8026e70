"""Meeting of hash keys from all tasks without a row for each key.

Keys are dealt to blocks by their value.  A task packs what it sends to a block into one
binary row, so a shuffle moves arrays.  What a task sends is reduced to one entry a key
first wherever the callers can, so a frequent key is not a large block.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship

ship(__name__)


#: Most and least text that a block of keys stands for.  What a task sends to blocks is less than its text.
MOST_BYTES, LEAST_BYTES = 8 << 20, 256 << 10
FEWEST = 8


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts."""
    return int(docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("long").alias("n")).first().n)


def block_count(spark: SparkSession, size: int, spread: int = 3) -> int:
    """Blocks for the keys of ``size`` bytes of text.

    A block never stands for more than ``MOST_BYTES``, so at scale their number follows the
    input.  Smaller inputs get up to ``spread`` blocks a shuffle partition, so that all tasks
    have work, as long as a block stands for ``LEAST_BYTES``.
    """
    wanted = spread * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(FEWEST, -(-size // MOST_BYTES), min(wanted, -(-size // LEAST_BYTES)))


def deal(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of the keys by block, stable, and (block, begin, end) of each run in it."""
    block = (keys % np.uint64(blocks)).astype(np.int32)
    order = np.argsort(block, kind="stable")
    edges = np.flatnonzero(np.diff(block[order])) + 1
    begin, end = np.append(0, edges), np.append(edges, len(keys))
    return order, [(int(block[order[a]]), int(a), int(b)) for a, b in zip(begin, end)] if len(keys) else []
