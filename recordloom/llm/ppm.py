"""Language-model scoring by prediction by partial matching over bytes, with a word baseline.

The byte-context trie holds how often each byte follows each context of up to ``ORDER``
bytes in the training texts, which are padded in front with zero bytes.  A byte is coded
in its longest known context; a context that has not seen it escapes with probability
D / (T + D) (T: occurrences, D: different bytes), and the next shorter context leaves out
the bytes that the longer one offered (symbol exclusion).  What no context offers is
uniform over the bytes left.  Texts do not change the trie (pretrained).

No gram is left out and no table of them is held in one place.  Groups of documents, dealt by
a hash of doc_id and text, of at most about ``MOST_BYTES`` of text each, ask for
the probability of each distinct run of ORDER + 1 bytes in them; what they ask with, and how
often the run stands in training texts, is counted in hash blocks.  The distinct runs are then
dealt by the two bytes before the last one, which all contexts of two bytes and more share,
so each deal holds those contexts whole; only the counts of single bytes and pairs of bytes
(at most 2^16) are broadcast.  The probabilities go back to the groups that asked.

The word baseline needs the count of every word of the corpus.  The same groups ask for the
counts of their distinct words by hash and get them back; words are told apart by 64-bit hashes.

Defined results: null counts as empty text, whose score is 0 and whose only token is the end.
Without training texts each byte has probability 1/256.  Repeated rows repeat their scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import block_count, deal, text_bytes
from .common import WordHash, discard, materialize, release, ship, slices, texts, utf8

ship(__name__)

ORDER = 4
END = b" "  # no word is a space


def codes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each byte, itself and the ORDER bytes before it in its document as one number."""
    data = data[at[0] : at[-1]]
    out = data.astype(np.uint64)
    inside = np.arange(len(data)) - np.repeat(at[:-1] - at[0], np.diff(at))
    for k in range(1, ORDER + 1):
        before = np.zeros(len(data), np.uint64)
        before[k:] = data[:-k]
        before[inside < k] = 0
        out |= before << np.uint64(8 * k)
    return out


@dataclass
class Trie:
    """``grams[k]``: sorted codes of k + 1 bytes; ``counts[k]``: their occurrences."""

    grams: list[np.ndarray]
    counts: list[np.ndarray]

    def __post_init__(self) -> None:
        self.contexts, self.total, self.kinds, self.offered = [], [], [], []
        for k, (g, n) in enumerate(zip(self.grams, self.counts)):
            context, begin = np.unique(g >> np.uint64(8), return_index=True)
            self.contexts.append(context)
            self.total.append(np.add.reduceat(n, begin) if len(g) else np.zeros(0, np.int64))
            self.kinds.append(np.diff(np.append(begin, len(g))))
            # what the next shorter context has seen of the bytes that this one offers
            shorter = self.counts[k - 1][np.searchsorted(self.grams[k - 1], g & np.uint64((1 << 8 * k) - 1))] if k and len(g) else np.zeros(len(g), np.int64)
            self.offered.append(np.add.reduceat(shorter, begin) if len(g) else np.zeros(0, np.int64))
        # a byte that its longest context has seen needs no other context
        spot = np.searchsorted(self.contexts[-1], self.grams[-1] >> np.uint64(8))
        kinds = self.kinds[-1][spot]
        self.direct = np.log10(self.counts[-1] / (self.total[-1][spot] + np.where(kinds == 256, 0, kinds))) if len(spot) else np.zeros(0)

    def log10(self, code: np.ndarray) -> np.ndarray:
        """log10 probability of each code's last byte after the bytes before it."""
        at, met = _find(self.grams[-1], code)
        out = np.zeros(len(code))
        out[met] = self.direct[at[met]]
        out[~met] = self._escaping(code[~met])
        return out

    def _escaping(self, code: np.ndarray) -> np.ndarray:
        out, alive = np.zeros(len(code)), np.ones(len(code), bool)
        left_out, seen = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        for k in range(len(self.grams) - 1, -1, -1):
            g = code & np.uint64((1 << 8 * (k + 1)) - 1)
            spot, known = _find(self.contexts[k], g >> np.uint64(8))
            at, met = _find(self.grams[k], g)
            if not len(self.contexts[k]):
                continue
            total, kinds = self.total[k][spot] - left_out, self.kinds[k][spot] - seen
            full = self.kinds[k][spot] == 256
            whole = total + np.where(full, 0, kinds)
            hit = alive & known & met
            out[hit] += np.log10(self.counts[k][at[hit]] / whole[hit])
            miss = alive & known & ~met & (kinds > 0)
            out[miss] += np.log10(kinds[miss] / whole[miss])
            alive &= ~hit
            left_out, seen = np.where(known, self.offered[k][spot], 0), np.where(known, self.kinds[k][spot], 0)
        out[alive] -= np.log10(256 - seen[alive])
        return out


def _find(table: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(what), np.int64), np.zeros(len(what), bool)
    at = np.minimum(np.searchsorted(table, what), len(table) - 1)
    return at, table[at] == what


def _key(code: np.ndarray) -> np.ndarray:
    return code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)


def _summed(names: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct names, sorted, and the sum of ``n`` of each."""
    names, spot = np.unique(names, return_inverse=True)
    total = np.zeros(len(names), np.int64)
    np.add.at(total, spot, n)
    return names, total


def _asked_grams(data: np.ndarray, at: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of these texts and their occurrences in those to learn from."""
    names, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in slices(at, 1 << 18):
        code, used = codes(data, at[a : b + 1]), np.repeat(learn[a:b], np.diff(at[a : b + 1]))
        for part, times in ((code[used], 1), (code[~used], 0)):
            name, n = np.unique(part, return_counts=True)
            names.append(name)
            counts.append(n * times)
    return _summed(np.concatenate(names), np.concatenate(counts))


class _Codes:
    """The codes of texts as numbers of distinct ones, so that what is known of these gives every text's sum."""

    def __init__(self, data: np.ndarray, at: np.ndarray) -> None:
        self.at, self.parts = at, []
        for a, b in slices(at, 1 << 18):
            names, spot = np.unique(codes(data, at[a : b + 1]), return_inverse=True)
            self.parts.append((a, b, names, spot.astype(np.uint32)))
        self.names = np.unique(np.concatenate([np.zeros(0, np.uint64), *(p[2] for p in self.parts)]))

    def sums(self, log10: np.ndarray) -> np.ndarray:
        """The sum of ``log10``, given for ``names``, over the codes of each text."""
        out = np.zeros(len(self.at) - 1)
        for a, b, names, spot in self.parts:
            each = np.append(0, np.cumsum(log10[np.searchsorted(self.names, names)][spot]))
            out[a:b] = each[self.at[a + 1 : b + 1] - self.at[a]] - each[self.at[a:b] - self.at[a]]
        return out


def gram_log10(asked: DataFrame, blocks: int) -> DataFrame:
    """``block``, ``code`` and ``log10`` (its probability) of each distinct code of ``asked``."""
    spark = asked.sparkSession

    def meet(key: tuple, group: pa.Table) -> pa.Table:
        names, total = _summed(np.frombuffer(b"".join(group["c"].to_pylist()), np.uint64), np.frombuffer(b"".join(group["d"].to_pylist()), "<u4"))
        return pa.table({"code": names.view(np.int64), "n": total})

    counted = materialize(asked.select("block", "c", "d").groupBy("block").applyInArrow(meet, "code long, n long"))
    pairs = counted.where("n > 0").groupBy(F.col("code").bitwiseAND(0xFFFF).alias("code")).agg(F.sum("n").alias("n")).toArrow()
    pair, n = _summed(pairs["code"].to_numpy().view(np.uint64), pairs["n"].to_numpy())
    byte, m = _summed(pair & np.uint64(0xFF), n)
    shared = spark.sparkContext.broadcast(([byte, pair], [m, n]))

    def judge(key: tuple, group: pa.Table) -> pa.Table:
        code, n = group["code"].to_numpy().view(np.uint64), group["n"].to_numpy()
        known, times = code[n > 0], n[n > 0]
        grams, counts = list(shared.value[0]), list(shared.value[1])
        for k in range(2, ORDER + 1):
            g, total = _summed(known & np.uint64((1 << 8 * (k + 1)) - 1), times)
            grams.append(g)
            counts.append(total)
        block = (_key(code) % np.uint64(blocks)).astype(np.int32)
        return pa.table({"block": block, "code": code.view(np.int64), "log10": Trie(grams, counts).log10(code)})

    dealt = counted.withColumn("deal", F.pmod(F.xxhash64(F.col("code").bitwiseAND(0xFFFF00)), F.lit(4 * blocks)))
    return dealt.groupBy("deal").applyInArrow(judge, "block int, code long, log10 double")


def score_documents(docs: DataFrame, training: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of each row; ``training`` is a condition on doc_id."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("learn"))
    # a row goes from each group to each block whose keys it has, and back; both are of a fixed size of text
    groups = blocks = block_count(spark, text_bytes(docs), 2)
    rows = rows.withColumn("grp", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int"))

    def said(column: pa.Array) -> list[np.ndarray]:
        """The words of each text and its end."""
        words = WordHash()
        return [np.append(words.of(text.lower().split()), np.uint64(words[END])) for text in texts(column)]

    def told(names: np.ndarray, by: np.ndarray, answers: dict[int, bytes], kind: type) -> np.ndarray:
        """The answers to ``names``, which were asked block by block in the order of ``deal``."""
        out = np.zeros(len(names), kind)
        order, runs = deal(by, blocks)
        for block, x, y in runs:
            out[order[x:y]] = np.frombuffer(answers[block], kind)
        return out

    def ask(key: tuple, group: pa.Table) -> pa.Table:
        found, learn = said(group["text"]), np.array(group["learn"].to_pylist())
        words = _summed(np.concatenate(found), np.repeat(learn, [len(x) for x in found]))
        out: dict[int, list[bytes]] = {}
        for k, (names, n) in enumerate((words, _asked_grams(*utf8(group["text"]), learn))):
            order, runs = deal(_key(names) if k else names, blocks)
            names, n = names[order], n[order].astype("<u4")
            for block, x, y in runs:
                out.setdefault(block, [b""] * 4)[2 * k : 2 * k + 2] = names[x:y].tobytes(), n[x:y].tobytes()
        a, b, c, d = (pa.array([r[k] for r in out.values()], pa.binary()) for k in range(4))
        return pa.table({"block": pa.array(list(out), pa.int32()), "grp": pa.array([key[0].as_py()] * len(out), pa.int32()), "a": a, "b": b, "c": c, "d": d})

    def meet(key: tuple, group: pa.Table, grams: pa.Table) -> pa.Table:
        asked, who, wanted = group["a"].to_pylist(), group["grp"].to_pylist(), group["c"].to_pylist()
        names, spot = np.unique(np.frombuffer(b"".join(asked), np.uint64), return_inverse=True)
        n = np.frombuffer(b"".join(group["b"].to_pylist()), "<u4")
        total = np.zeros(len(names), np.int64)
        np.add.at(total, spot, n)
        ends = np.append(0, np.cumsum([len(x) // 8 for x in asked]))
        replies = [total[s].tobytes() for s in np.split(spot, ends[1:-1])]
        code, log10 = grams["code"].to_numpy().view(np.uint64), grams["log10"].to_numpy()
        order = np.argsort(code)
        code, log10 = code[order], log10[order]
        judged = [log10[np.searchsorted(code, np.frombuffer(x, np.uint64))].tobytes() for x in wanted]
        none = len(replies)
        return pa.table({
            "grp": pa.array([*who, -1], pa.int32()), "block": pa.array([key[0].as_py()] * (none + 1), pa.int32()), "b": pa.array([*replies, b""], pa.binary()), "d": pa.array([*judged, b""], pa.binary()),
            "tokens": pa.array([0] * none + [int(total.sum())], pa.int64()), "kinds": pa.array([0] * none + [int((total > 0).sum())], pa.int64()),
        })

    asked = materialize(rows.groupBy("grp").applyInArrow(ask, "block int, grp int, a binary, b binary, c binary, d binary"))
    release(spark)
    judged = gram_log10(asked, blocks)
    # answers come without what they answer: a group knows what it has asked a block, in which order
    met = asked.drop("d").groupBy("block").cogroup(judged.groupBy("block")).applyInArrow(meet, "grp int, block int, b binary, d binary, tokens long, kinds long")
    replies = materialize(met)
    discard(met)
    del asked, judged, met
    release(spark)
    sums = replies.where("grp = -1").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("kinds"), F.lit(0)).alias("v")).first()
    total, kinds = int(sums.n), int(sums.v)

    def judge(key: tuple, group: pa.Table, got: pa.Table) -> pa.Table:
        counted, judged = (dict(zip(got["block"].to_pylist(), got[c].to_pylist())) for c in "bd")
        grams = _Codes(*utf8(group["text"]))
        trie = grams.sums(told(grams.names, _key(grams.names), judged, np.float64))
        found = said(group["text"])
        names = np.unique(np.concatenate(found))
        n = told(names, names, counted, np.int64)
        weight = np.log10(n + 0.5)
        tokens, known, base = [], [], []
        for text in found:
            spot = np.searchsorted(names, text)
            tokens.append(len(spot))
            known.append(int((n[spot] > 0).sum()))
            base.append(float(weight[spot].sum() - len(spot) * np.log10(total + 0.5 * (kinds + 1))))
        return pa.table({"doc_id": group["doc_id"], "n_tokens": pa.array(tokens, pa.int64()), "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array([total] * len(tokens), pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(trie, pa.float64())})

    fields = [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")] + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
    own = rows.select("grp", "doc_id", "text").groupBy("grp")
    return own.cogroup(replies.where("grp >= 0").select("grp", "block", "b", "d").groupBy("grp")).applyInArrow(judge, T.StructType([docs.schema["doc_id"], *fields]))
