"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A batch of documents is cut into pieces by the split pattern; the pieces that
have not been seen before form a small corpus.  An inverted index maps each
mergeable pair to its positions in that corpus, and the merges are replayed over
all of it in rank order.  A merge visits only the positions the index lists for
it and re-indexes only the two neighbours of each; words are never rescanned.

Defined results: null text encodes as the empty text (no ids, empty decoding);
rows are independent, so repeated rows repeat their result.  Extra columns pass
through; columns that carry an output's name are replaced.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import append_columns, ship, texts

ship(__name__)


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file (base64 token, space, rank per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class MergeReplay:
    """Encoder for pieces under one table of ranks."""

    #: From this many positions on, one merge is applied to all of them at once.
    MANY = 48

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        #: left id << 20 | right id -> rank of the joined bytes, which is also its id.
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 20 | right] = rank
        self.keys = np.array(sorted(self.pairs) or [-1], np.int64)
        self.values = np.array([self.pairs.get(k, -1) for k in self.keys.tolist()], np.int32)
        #: Symbols that can form a pair which comes before the merge that makes the symbol.
        self.unsteady = {x for key, rank in self.pairs.items() for x in (key >> 20, key & 0xFFFFF) if rank < x}

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 for none; a negative symbol pairs with nothing."""
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.values[at], -1)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each piece."""
        whole = [self.ranks.get(p) for p in pieces]
        rest = [p for p, known in zip(pieces, whole) if known is None]
        size = np.array([len(p) for p in rest], np.int64)
        first = 1 + np.cumsum(size + 1) - (size + 1)
        sym = np.full(int(size.sum()) + len(rest) + 2, -1, np.int32)
        body = np.ones(len(sym), bool)
        body[0] = body[-1] = False
        body[first + size] = False
        sym[body] = self.single[np.frombuffer(b"".join(rest), np.uint8)]
        self._replay(sym)
        keep = sym >= 0
        ends = np.cumsum(keep)
        raw, cut = memoryview(sym[keep].astype("<u4").view(np.uint8)), iter(zip((4 * ends[first - 1]).tolist(), (4 * ends[first + size]).tolist()))
        return [bytes(raw[slice(*next(cut))]) if known is None else known.to_bytes(4, "little") for known in whole]

    def _replay(self, sym: np.ndarray) -> None:
        """Apply every merge to ``sym`` in place; symbols that are merged away become -2."""
        after, before = np.arange(1, len(sym) + 1, dtype=np.int32), np.arange(-1, len(sym) - 1, dtype=np.int32)
        #: rank of the pair that begins at each position now, or -1
        current = np.append(self.ranks_of(sym[:-1], sym[1:]), np.int32(-1)).astype(np.int32)
        begin = np.flatnonzero(current >= 0).astype(np.int32)
        begin = begin[np.argsort(current[begin], kind="stable")]
        index: dict[int, list] = {}
        for part in np.split(begin, np.flatnonzero(np.diff(current[begin])) + 1) if len(begin) else []:
            index[int(current[part[0]])] = [part]
        queue = sorted(index)
        state = (sym, after, before, current)
        views = tuple(map(memoryview, state))
        while queue:
            rank = heappop(queue)
            listed = index.pop(rank, None)
            if listed is None:
                continue
            if sum(1 if isinstance(x, int) else len(x) for x in listed) >= self.MANY:
                spots = np.concatenate([[x] if isinstance(x, int) else x for x in listed]).astype(np.int32)
                spots = np.sort(spots[current[spots] == rank])
                spots = spots[np.append(True, spots[1:] != spots[:-1])] if len(spots) else spots
                if len(spots) and not (after[spots[:-1]] == spots[1:]).any() and not (rank in self.unsteady and self._disturbed(rank, spots, state)):
                    self._merge_all(rank, spots, state, index, queue)
                    continue
                spots = spots.tolist()
            else:
                spots = sorted({y for x in listed for y in ((x,) if isinstance(x, int) else x.tolist())})
            self._merge_each(rank, spots, views, index, queue)

    def _disturbed(self, rank: int, spots: np.ndarray, state) -> bool:
        """Whether one of these merges makes a pair that comes before the rest of them."""
        sym, after, before, current = state
        beyond = after[after[spots]]
        right, left = sym[beyond], sym[before[spots]]
        same = np.full(len(spots), rank, np.int32)
        made = [self.ranks_of(same, right), self.ranks_of(left, same), self.ranks_of(same, np.where(current[beyond] == rank, rank, right))]
        return any(((x >= 0) & (x < rank)).any() for x in made)

    def _merge_all(self, rank: int, spots: np.ndarray, state, index: dict, queue: list) -> None:
        """One merge at many positions that do not overlap."""
        sym, after, before, current = state
        gone = after[spots]
        beyond = after[gone]
        sym[spots], sym[gone] = rank, -2
        current[gone] = -1
        after[spots], before[beyond] = beyond, spots
        prior = before[spots]
        touched = np.concatenate([spots, prior])
        new = self.ranks_of(sym[touched], sym[np.concatenate([beyond, spots])])
        current[touched] = new
        good = np.flatnonzero(new >= 0)
        if not len(good):
            return
        good = good[np.argsort(new[good], kind="stable")]
        touched, new = touched[good], new[good]
        edges = np.flatnonzero(np.diff(new)) + 1
        for r, part in zip(new[np.append(0, edges)].tolist(), np.split(touched, edges)):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heappush(queue, r)

    def _merge_each(self, rank: int, spots: list[int], views, index: dict, queue: list) -> None:
        """One merge at positions from left to right, which may overlap."""
        sym, after, before, current = views
        find = self.pairs.get
        for turn, at in enumerate(spots):
            if current[at] != rank:
                continue
            gone = after[at]
            beyond, prior = after[gone], before[at]
            sym[at], sym[gone], current[gone] = rank, -2, -1
            after[at], before[beyond] = beyond, at
            lower = False
            for spot, left, right in ((at, rank, sym[beyond]), (prior, sym[prior], rank)):
                new = find(left << 20 | right) if left >= 0 and right >= 0 else None
                if new is None:
                    current[spot] = -1
                    continue
                current[spot] = new
                if new in index:
                    index[new].append(spot)
                else:
                    index[new] = [spot]
                    heappush(queue, new)
                lower = lower or new < rank
            if lower and turn + 1 < len(spots):
                # a better merge has appeared here: it comes before the rest of this one
                rest = spots[turn + 1 :]
                if rank in index:
                    index[rank].extend(rest)
                else:
                    index[rank] = rest
                    heappush(queue, rank)
                return


class Encoder:
    """Encodes documents; remembers the ids of chunks and pieces, about ``most`` bytes of each.

    A chunk is what stands between single spaces.  A space with no white space
    beside it always begins a new piece and nothing before it bears on what
    follows, so chunks can be encoded apart from their documents.
    """

    #: Bytes that an entry of a dictionary takes besides its text and ids.
    ENTRY = 200

    def __init__(self, ranks: dict[bytes, int], pattern: str, most: int = 24 << 20) -> None:
        import re

        import regex

        self.replay, self.pieces, self.most = MergeReplay(ranks), regex.compile(pattern).findall, most
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.held = [0, 0]
        self.beside = re.compile(r"\s\s").search
        self.cut = re.compile(r"(?<=\S) (?=\S)").split

    def parts(self, text: str) -> list[str]:
        uneven = text[0].isspace() or text[-1].isspace() or self.beside(text)
        found = self.cut(text) if uneven else text.split(" ")
        return found[:1] + [" " + x for x in found[1:]]

    def encode(self, documents: list[str]) -> list[bytes]:
        for k, known in enumerate((self.chunks, self.words)):
            if self.held[k] >= self.most:
                known.clear()
                self.held[k] = 0
        parts = [self.parts(t) if t else [] for t in documents]
        fresh = {c for p in parts for c in p}.difference(self.chunks)
        cut = {c: self.pieces(c) for c in fresh}
        words = list({w for p in cut.values() for w in p}.difference(self.words))
        self.words.update(zip(words, self.replay.encode([w.encode() for w in words])))
        self.held[1] += self.ENTRY * len(words) + sum(map(len, words))
        get = self.words.__getitem__
        self.chunks.update({c: get(p[0]) if len(p) == 1 else b"".join(map(get, p)) for c, p in cut.items()})
        self.held[0] += self.ENTRY * len(cut) + 3 * sum(map(len, cut))
        get = self.chunks.__getitem__
        return [b"".join(map(get, p)) for p in parts]


def decode(ids: bytes, vocabulary: list[bytes]) -> bytes:
    return b"".join(map(vocabulary.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _vocabulary(ranks: dict[bytes, int]) -> list[bytes]:
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


#: Documents are encoded this many bytes of text at a time; the parts of a batch take about ten times as much.
BATCH_BYTES = 2 << 20


def _encoded(docs: DataFrame, ranks_path: str, pattern: str, kinds: dict[str, T.DataType], shape) -> DataFrame:
    """``docs`` with the columns ``kinds``; ``shape`` gives their values from a document, its ids and their decoding."""
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))
    arrow = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary(), T.BooleanType(): pa.bool_()}

    def make():
        encoder, vocabulary = Encoder(shared.value, pattern), _vocabulary(shared.value)

        def compute(column: pa.Array) -> list[pa.Array]:
            documents = texts(column)
            coded = encoder.encode([t.decode() for t in documents])
            rows = [shape(text, ids, decode(ids, vocabulary)) for text, ids in zip(documents, coded)]
            return [pa.array([r[k] for r in rows], arrow[kind]) for k, kind in enumerate(kinds.values())]

        return compute

    return append_columns(docs, make, [T.StructField(name, kind) for name, kind in kinds.items()], most=BATCH_BYTES)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids`` (little-endian unsigned 32-bit) and ``decoded``, the text those ids give."""
    return _encoded(docs, ranks_path, pattern, {"ids": T.BinaryType(), "decoded": T.StringType()}, lambda text, ids, said: (ids, said.decode()))


def encode_verified(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` and ``round_trip``, whether the ids decode to the text.

    The decoding is compared where it is made and does not travel.
    """
    kinds = {"n_tokens": T.LongType(), "ids": T.BinaryType(), "round_trip": T.BooleanType()}
    return _encoded(docs, ranks_path, pattern, kinds, lambda text, ids, said: (len(ids) // 4, ids, said == text))


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs`` with the number of ids and digests of the ids and of their decoding.

    The digests are taken where the ids are made, so ids do not travel.
    """
    kinds = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    return _encoded(docs, ranks_path, pattern, kinds, lambda text, ids, said: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(said).hexdigest()))
