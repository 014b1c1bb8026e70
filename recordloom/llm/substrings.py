"""Substring dedup by fixed-block anchors.

Reference blocks: the words of every document at places 0, BLOCK, 2 * BLOCK, ... cut into
blocks that do not overlap.  Probes: every rolling window of BLOCK words.  Any ``width``
consecutive words hold a whole reference block (2 * BLOCK - 1 <= width), so where such
words stand twice, a probe of the one meets a block of the other.  Those anchors are
extended to both sides as far as ``width`` words can reach, and the extended windows are
compared whole: a window that also starts earlier (smaller doc_id, or same document,
earlier start) covers its words.  Adjoining covered windows are the maximal exact repeats;
their words go.  Windows are judged on the input.

Probes and windows meet in blocks of hash keys.  A task sends each key at most once for
each chunk of text (once a text where texts of one doc_id have it at one place), so text that stands in a third of all documents is no large group.
Words enter by 64-bit hashes, windows are told apart by 96 bits.

Defined results: null text has no words; its kept text is empty.  Rows that repeat a
doc_id count as the same document: equal words at the same place of it do not remove each
other.  Each row loses only windows of its own text: rows are told apart by doc_id and a
64-bit hash of the text.  A null doc_id counts as the smallest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import block_count, deal, text_bytes
from .common import WordHash, discard, materialize, mix, release, ship, slices, texts, tidy, utf8
from .ngram_join import likely

ship(__name__)

BLOCK = 10
CHUNK_BYTES = 12 << 20
NOWHERE = -(2**63)
SENT = "block int, chunk long, kind int, a binary, b binary"
MET = "chunk long, kind int, a binary, b binary"


def grams(h: np.ndarray, width: int, salt: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words of one stretch of word hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, salt, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            out = mix(out ^ (h[j : n + j] + np.uint64((2 * j + 3) * 0x9E3779B97F4A7C15 % 2**64)))
    return out


def _chunks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(chunk id, rows, word hashes of all rows, where each row's words begin)."""
    from pyspark import TaskContext

    words, number = WordHash(), TaskContext.get().partitionId() << 32
    for batch in batches:
        _, at = utf8(batch.column(text))
        for a, b in slices(at, CHUNK_BYTES):
            rows = batch.slice(a, b - a)
            said = [words.of(t.split()) for t in texts(rows.column(text))]
            yield number, rows, np.concatenate([np.zeros(0, np.uint64), *said]), np.append(0, np.cumsum([len(s) for s in said])).astype(np.int64)
            number += 1


def _starts(begin: np.ndarray, width: int) -> np.ndarray:
    """Which places of a chunk begin ``width`` words of one document."""
    ok = np.zeros(begin[-1], bool)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        ok[a : max(a, b - width + 1)] = True
    return ok


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["block", "chunk", "kind", "a", "b"])


def _places(at: np.ndarray) -> bytes:
    """Ascending places as 16-bit steps where they fit, else as 32-bit numbers; a byte says which."""
    steps = np.diff(at, prepend=0)
    return b"\0" + at.astype("<u4").tobytes() if (steps >= 2**16).any() else b"\1" + steps.astype("<u2").tobytes()


def _read_places(raw: bytes) -> np.ndarray:
    if raw[0]:
        return np.cumsum(np.frombuffer(raw, "<u2", offset=1), dtype=np.int64)
    return np.frombuffer(raw, "<u4", offset=1).astype(np.int64)


def _table_row(chunk: int, ids: np.ndarray, tags: np.ndarray, begin: np.ndarray) -> tuple:
    return (-1 - chunk % 4096, chunk, 0, ids.tobytes() + tags.tobytes(), begin.tobytes())


def _rows(docs: DataFrame) -> DataFrame:
    """``at`` (document), ``text`` and ``tag``, which tells texts of one document apart."""
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NOWHERE)).alias("at"), "text", F.xxhash64("text").alias("tag"))


def _by_document(met: DataFrame) -> DataFrame:
    """From places in chunks to ``at`` and ``tag`` (a text of a document) and ``places`` in it."""

    def resolve(key: tuple, group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        table = next(r for r in rows if r["kind"] == 0)
        (ids, tags), begin = np.frombuffer(table["a"], np.int64).reshape(2, -1), np.frombuffer(table["b"], np.int64)
        places = np.sort(np.concatenate([np.zeros(0, np.int64), *(_read_places(r["a"]) for r in rows if r["kind"] == 1)]))
        cut = np.searchsorted(places, begin)
        out = [(int(ids[k]), int(tags[k]), (places[x:y] - begin[k]).astype("<u4").tobytes()) for k, (x, y) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if y > x]
        return pa.table({"at": pa.array([i for i, _, _ in out], pa.int64()), "tag": pa.array([t for _, t, _ in out], pa.int64()), "places": pa.array([p for _, _, p in out], pa.binary())})

    return met.groupBy("chunk").applyInArrow(resolve, "at long, tag long, places binary").groupBy("at", "tag").agg(F.collect_set("places").alias("places"))


def anchors(docs: DataFrame, blocks: int) -> DataFrame:
    """Texts (``at``, ``tag``) with the places of their words where an anchor begins."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows, h, begin in _chunks(batches, 1):
            place = np.flatnonzero(_starts(begin, BLOCK))
            if not len(place):
                continue
            key = grams(h, BLOCK, 1)[place]
            inside = place - np.repeat(begin[:-1], np.diff(begin))[place]
            order = np.argsort(key, kind="stable")
            fresh = np.append(True, key[order][1:] != key[order][:-1])
            group = np.empty(len(key), np.int64)
            group[order] = np.cumsum(fresh) - 1
            first = order[fresh]
            several = np.bincount(group) > 1
            out = [_table_row(chunk, *(rows.column(k).to_numpy(zero_copy_only=False) for k in (0, 2)), begin)]
            # what stands twice here is anchored at once; one entry of it goes out, as a block
            local = place[several[group]]
            if len(local):
                out.append((-1 - chunk % 4096, chunk, 1, _places(local), None))
            sent = np.sort(first)
            block = several[group[sent]] | (inside[sent] % BLOCK == 0)
            keys = key[sent]
            turn, runs = deal(keys, blocks)
            code = ((keys // np.uint64(blocks)) & np.uint64(0x7FFFFFFF)) << np.uint64(1) | block
            code, at = code[turn].astype("<u4"), place[sent][turn]
            out += [(k, chunk, 1, code[x:y].tobytes(), _places(at[x:y])) for k, x, y in runs]
            yield _batch(out)

    def meet(key: tuple, group: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return group.select(["chunk", "kind", "a", "b"])
        chunks, raw, where = group["chunk"].to_pylist(), group["a"].to_pylist(), group["b"].to_pylist()
        code = np.frombuffer(b"".join(raw), "<u4")
        names, spot = np.unique(code >> 1, return_inverse=True)
        n, marked = np.bincount(spot, minlength=len(names)), np.bincount(spot, code & 1, minlength=len(names))
        hit = ((n > 1) & (marked > 0))[spot]
        ends = np.append(0, np.cumsum([len(r) // 4 for r in raw]))
        found = [(c, _places(_read_places(w)[h])) for c, w, h in zip(chunks, where, np.split(hit, ends[1:-1])) if h.any()]
        return pa.table({"chunk": pa.array([c for c, _ in found], pa.int64()), "kind": pa.array([1] * len(found), pa.int32()), "a": pa.array([p for _, p in found], pa.binary()), "b": pa.nulls(len(found), pa.binary())})

    return _by_document(_rows(docs).select("at", "text", "tag").mapInArrow(tidy(send), SENT).groupBy("block").applyInArrow(meet, MET))


def repeats(rows: DataFrame, width: int, blocks: int) -> DataFrame:
    """Texts (``at``, ``tag``) with the starts of their windows that stand earlier elsewhere.

    ``rows`` has ``at``, ``text``, ``tag`` and ``places``, the anchors of that text.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, part, h, begin in _chunks(batches, 1):
            near = np.zeros(begin[-1] + 1, np.int64)
            for k, listed in enumerate(part.column(3).to_pylist()):
                for raw in listed or ():
                    p = np.frombuffer(raw, "<u4").astype(np.int64)
                    np.add.at(near, begin[k] + np.maximum(p - (width - BLOCK), 0), 1)
                    np.add.at(near, begin[k] + p + 1, -1)
            place = np.flatnonzero((np.cumsum(near)[:-1] > 0) & _starts(begin, width))
            if not len(place):
                continue
            ids, tags = (part.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            key, other = grams(h, width, 2)[place], (grams(h, width, 5)[place] >> np.uint64(32)).astype("<u4")
            owner = np.repeat(np.arange(len(ids)), np.diff(begin))[place]
            doc, start = ids[owner], place - begin[owner]
            order = np.lexsort([start, doc, other, key])
            k, o = key[order], other[order]
            fresh = np.append(True, (k[1:] != k[:-1]) | (o[1:] != o[:-1]))
            lead = order[fresh][np.cumsum(fresh) - 1]
            later = np.empty(len(key), bool)
            later[order] = (doc[order] != doc[lead]) | (start[order] != start[lead])
            out = [_table_row(chunk, ids, tags, begin)]
            if later.any():
                out.append((-1 - chunk % 4096, chunk, 1, _places(place[later]), None))
            first = order[~later[order]]
            if len(first) > fresh.sum():
                # other texts of one document have the window at the same place: each asks for itself
                tag = tags[owner[first]]
                turn = np.lexsort([tag, other[first], key[first]])
                first, tag = first[turn], tag[turn]
                first = first[np.append(True, (tag[1:] != tag[:-1]) | (other[first][1:] != other[first][:-1]) | (key[first][1:] != key[first][:-1]))]
            sent = np.sort(first)
            turn, runs = deal(key[sent], blocks)
            sent = sent[turn]
            made = np.empty(len(sent), RECORD)
            made["key"], made["other"], made["doc"], made["start"] = key[sent], other[sent], doc[sent], start[sent]
            out += [(b, chunk, 1, made[x:y].tobytes(), _places(place[sent[x:y]])) for b, x, y in runs]
            yield _batch(out)

    def meet(key: tuple, group: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return group.select(["chunk", "kind", "a", "b"])
        chunks, raw, where = group["chunk"].to_pylist(), group["a"].to_pylist(), group["b"].to_pylist()
        rec = np.frombuffer(b"".join(raw), RECORD)
        order = np.lexsort([rec["start"], rec["doc"], rec["other"], rec["key"]])
        s = rec[order]
        fresh = np.append(True, (s["key"][1:] != s["key"][:-1]) | (s["other"][1:] != s["other"][:-1]))
        lead = s[fresh][np.cumsum(fresh) - 1]
        later = np.empty(len(rec), bool)
        later[order] = (s["doc"] != lead["doc"]) | (s["start"] != lead["start"])
        ends = np.append(0, np.cumsum([len(r) // RECORD.itemsize for r in raw]))
        found = [(c, _places(_read_places(w)[x])) for c, w, x in zip(chunks, where, np.split(later, ends[1:-1])) if x.any()]
        return pa.table({"chunk": pa.array([c for c, _ in found], pa.int64()), "kind": pa.array([1] * len(found), pa.int32()), "a": pa.array([p for _, p in found], pa.binary()), "b": pa.nulls(len(found), pa.binary())})

    return _by_document(rows.mapInArrow(tidy(send), SENT).groupBy("block").applyInArrow(meet, MET))


RECORD = np.dtype([("key", "<u8"), ("other", "<u4"), ("start", "<u4"), ("doc", "<i8")])


def _kept(documents: list[bytes], listed: list, width: int) -> Iterator[tuple[int, int, bytes]]:
    """(words, words removed, what is kept) of each document."""
    for text, starts in zip(documents, listed):
        said = text.split()
        if not starts:
            yield len(said), 0, b" ".join(said)
            continue
        edge = np.zeros(len(said) + 1, np.int64)
        at = np.unique(np.concatenate([np.frombuffer(r, "<u4") for r in starts]).astype(np.int64))
        edge[at] += 1
        edge[at + width] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        yield len(said), int(gone.sum()), b" ".join([w for w, g in zip(said, gone.tolist()) if not g])


def dedup_substrings(docs: DataFrame, width: int = 20, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by spaces (``kept``), or with ``digest`` their sha256 (``kept_sha256``)."""
    if 2 * BLOCK - 1 > width:
        raise ValueError(f"windows of {width} words may hold no block of {BLOCK}")
    blocks = block_count(docs.sparkSession, text_bytes(docs))
    found = materialize(anchors(docs, blocks))
    release(docs.sparkSession)
    near = likely(_rows(docs).select("at", "text", "tag"), found.select("tag"), "tag").join(found, ["at", "tag"])
    # chunks count rows: in this order a task that is run again after a lost executor makes the same ones
    near = near.select("at", "text", "tag", "places").sortWithinPartitions("at", "tag")
    later = materialize(repeats(near, width, blocks))
    discard(near)
    release(docs.sparkSession)
    name = "kept_sha256" if digest else "kept"
    full = _rows(docs).join(later, ["at", "tag"], "left").select("doc_id", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = list(_kept(texts(batch.column(1)), batch.column(2).to_pylist(), width))
            kept = [hashlib.sha256(k).hexdigest() if digest else k.decode() for _, _, k in done]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _, _ in done], pa.int64()), pa.array([r for _, r, _ in done], pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", name])

    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField(name, T.StringType())]
    return full.mapInArrow(tidy(run), T.StructType([docs.schema["doc_id"], *fields]))
