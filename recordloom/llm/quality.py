"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; learned filters eight bytes wide step over the text four bytes
at a time; their rectified outputs are max-pooled over chunks of 256 bytes that
overlap by 64 and cover the whole document.  The mean and the maximum over the
chunks feed one logistic unit.  The filters are learned on single chunks, the last
unit on whole documents.

Bound (a parameter of ``Training``): at most ``docs`` labelled rows, lowest hash of doc_id
first, are used to learn, each of them whole.  Scoring reads every byte of every document,
and a document's score depends on its own bytes alone.

Defined results: null or empty text scores as one chunk of zero bytes.  Labels with
null quality or doc_id are ignored; with fewer than two classes to learn from, every
score is the share of label 1 (0.5 without labels).  Repeated rows repeat their score;
extra columns pass through, columns named like an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, ship, utf8

ship(__name__)

STEP, WIDE, BLOCK, REACH, STRIDE = 4, 8, 64, 4, 3  # bytes, bytes, bytes, blocks a chunk, blocks between chunks


@dataclass(frozen=True)
class Training:
    docs: int = 1500
    filters: int = 16
    dims: int = 6
    epochs: int = 12
    rate: float = 0.01
    seed: int = 7


@dataclass
class Network:
    embedding: np.ndarray  # 256 x dims
    filters: np.ndarray  # WIDE * dims x filters
    bias: np.ndarray
    weights: np.ndarray  # 2 * filters
    offset: float
    centre: np.ndarray
    spread: np.ndarray
    constant: float | None = None

    def blocks(self, padded: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Max of each filter over each block; ``padded`` is whole blocks of bytes.

        ``ends`` are the last blocks of the documents: behind them a filter sees zero bytes,
        whatever document follows.  Sums run in a fixed order, so that a block's values do
        not depend on how many blocks there are.
        """
        f, per, dims = self.filters.shape[1], BLOCK // STEP, self.embedding.shape[1]
        by_byte = np.einsum("bd,kdf->kbf", self.embedding, self.filters.reshape(WIDE, dims, f)).astype(np.float32)
        steps, out = padded.reshape(-1, STEP), np.empty((len(padded) // BLOCK, f), np.float32)
        last, nothing = np.zeros(len(out), bool), by_byte[STEP:, 0].sum(0)
        last[ends] = True
        piece = 1 << 12
        for a in range(0, len(out), piece):
            b = min(a + piece, len(out))
            seen, behind = steps[a * per : b * per], steps[a * per + 1 : b * per + 1]
            z, then = by_byte[0][seen[:, 0]], by_byte[STEP][behind[:, 0]]
            for k in range(1, STEP):
                z += by_byte[k][seen[:, k]]
                then += by_byte[STEP + k][behind[:, k]]
            then = np.concatenate([then, np.zeros((len(z) - len(then), f), np.float32)])
            then.reshape(-1, per, f)[last[a:b], -1] = nothing
            out[a:b] = (z + then).reshape(-1, per, f).max(1)
        return np.maximum(out + self.bias.astype(np.float32), 0)

    def features(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Mean and maximum over the chunks of each document."""
        size = np.diff(at)
        n = np.maximum(-(-size // BLOCK), 1)
        first = np.concatenate([[0], np.cumsum(n)])
        padded = np.zeros(first[-1] * BLOCK, np.uint8)
        for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            padded[first[k] * BLOCK : first[k] * BLOCK + b - a] = data[a:b]
        pooled = self.blocks(padded, first[1:] - 1)
        top = np.maximum.reduceat(pooled, first[:-1], axis=0)
        chunks = np.maximum(-(-(n - REACH) // STRIDE), 0) + 1
        begin = np.concatenate([[0], np.cumsum(chunks)])
        start = (np.arange(begin[-1]) - np.repeat(begin[:-1], chunks)) * STRIDE + np.repeat(first[:-1], chunks)
        last = np.repeat(first[1:] - 1, chunks)
        best = pooled[start]
        for k in range(1, REACH):
            np.maximum(best, pooled[np.minimum(start + k, last)], out=best)
        return np.concatenate([np.add.reduceat(best, begin[:-1], axis=0) / chunks[:, None], top], axis=1)

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(at) - 1, self.constant)
        z = ((self.features(data, at) - self.centre) / self.spread * self.weights).sum(1) + self.offset
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def fit(documents: list[bytes], labels: list[int], how: Training = Training()) -> Network:
    """Learn from whole documents and their 0/1 labels."""
    rng = np.random.default_rng(how.seed)
    y = np.array(labels, np.float32)
    wide = WIDE * how.dims
    net = Network(
        rng.normal(0, 0.5, (256, how.dims)).astype(np.float32), rng.normal(0, wide**-0.5, (wide, how.filters)).astype(np.float32), np.zeros(how.filters, np.float32),
        np.zeros(2 * how.filters, np.float32), 0.0, np.zeros(2 * how.filters, np.float32), np.ones(2 * how.filters, np.float32),
    )
    if len(set(labels)) < 2:
        net.constant = float(y.mean()) if len(y) else 0.5
        return net
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    long = BLOCK * REACH
    windows = np.arange(0, long - WIDE + 1, STEP)[:, None] + np.arange(WIDE)
    head, shift = rng.normal(0, 0.3, how.filters).astype(np.float32), np.float32(0)
    params = [net.embedding, net.filters, net.bias, head]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    turn = 0
    for _ in range(how.epochs):
        order = rng.permutation(len(y))
        for part in np.array_split(order, max(1, len(order) // 64)):
            x = np.zeros((len(part), long), np.uint8)
            for row, k in enumerate(part):
                text = documents[k]
                a = int(rng.integers(0, max(1, len(text) - long + 1)))
                piece = np.frombuffer(text[a : a + long], np.uint8)
                x[row, : len(piece)] = piece
            seen = x[:, windows]  # rows, positions, WIDE
            patch = net.embedding[seen].reshape(len(part), len(windows), wide)
            z = patch @ net.filters + net.bias
            spot = z.argmax(1)  # rows, filters
            best = np.take_along_axis(z, spot[:, None, :], 1)[:, 0]
            h = np.maximum(best, 0)
            p = 1 / (1 + np.exp(-np.clip(h @ head + shift, -30, 30)))
            g = (p - y[part]) * weight[part] / len(part)
            dh = g[:, None] * head * (best > 0)
            chosen = patch[np.arange(len(part))[:, None], spot]  # rows, filters, wide
            into = np.einsum("rf,wf->rfw", dh, net.filters).reshape(-1, how.dims)
            d_embedding = np.zeros_like(net.embedding)
            np.add.at(d_embedding, seen[np.arange(len(part))[:, None], spot].reshape(-1), into)
            steps = [d_embedding, np.einsum("rf,rfw->wf", dh, chosen) + 1e-4 * net.filters, dh.sum(0), h.T @ g + 1e-3 * head]
            shift -= how.rate * g.sum()
            turn += 1
            for p_, d, (m, v) in zip(params, steps, moments):
                m += 0.1 * (d - m)
                v += 0.01 * (d * d - v)
                p_ -= (how.rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-7)).astype(np.float32)
    at = np.concatenate([[0], np.cumsum([len(t) for t in documents])])
    x = net.features(np.frombuffer(b"".join(documents), np.uint8), at).astype(np.float64)
    net.centre, net.spread = x.mean(0), x.std(0) + 1e-3
    x = np.c_[(x - net.centre) / net.spread, np.ones(len(y))]
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1]) * 0.5
    ridge[-1, -1] = 1e-6
    for _ in range(25):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    net.weights, net.offset = w[:-1], float(w[-1])
    return net


def training_rows(docs: DataFrame, labels: DataFrame, usable, how: Training = Training()) -> list[tuple[bytes, int]]:
    """The bounded sample: whole texts and labels of the rows that ``usable`` (a condition on doc_id) admits."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & usable).select("doc_id", F.col("quality").cast("int").alias("quality"), F.xxhash64("doc_id").alias("at"))
    total = known.count()
    share = min(1.0, 2.0 * how.docs / max(1, total))
    edge = min(int(share * 2**64) - 2**63, 2**63 - 1)
    near = known.where(F.col("at") <= edge).orderBy("at", "doc_id", "quality").limit(4 * how.docs)
    text = docs.select("doc_id", "text").where(F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (F.xxhash64("doc_id") <= edge))
    rows = text.join(F.broadcast(near), "doc_id").orderBy("at", "doc_id", "quality", "text").limit(how.docs).select("text", "quality").collect()
    return [(r.text.encode(), r.quality) for r in rows]


def score_documents(docs: DataFrame, net: Network, out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the network's probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        model = shared.value

        def compute(column: pa.Array) -> list[pa.Array]:
            return [pa.array(model.scores(*utf8(column)), pa.float64())]

        return compute

    return append_columns(docs, make, [T.StructField(out, T.DoubleType())])
