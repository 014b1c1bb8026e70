"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

A conversation is put right by an A* search on the lattice of (rows read, state of the roles).
Long conversations are cut into chunks: each chunk is searched from every state that it can
begin in, the costs are chained over the chunks, and only the edits on the cheapest way are
applied.  So no task ever holds a conversation, whatever its length.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, ship, tidy

ship(__name__)

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: First faults of a row.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: What the roles so far are: nothing, a system row, up to a user row, up to an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NAMED = {"u": "user", "a": "assistant"}
#: Insertions that end a conversation well, by state.
CLOSE = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


@dataclass(frozen=True)
class Costs:
    """Prices of edits; those of insertions and deletions must be above zero."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    #: For each row with a truncated text that stays.
    truncated: int = 5


def search(initials: Sequence[str], faults: Sequence[int], start: int, whole: bool, price: Costs) -> dict[int, tuple[int, str]]:
    """Cheapest cost and edits, by the state at the end; of equal costs the least edits by ASCII.

    Nodes are (rows read, state), opened in the order of cost plus heuristic, then edits.  The
    heuristic sums what the rows ahead cost at least: the deletion of blank and duplicate rows,
    and for truncated ones the lesser of deletion and charge.  It never falls by more than an edit
    costs, so a node is best when it is first opened.  With ``whole`` the rows are a conversation: only
    its cheapest good end is found, and insertions may follow the last row.  Else insertions
    stand before rows, so no two edits to one place are a prefix of one another.
    """
    n = len(initials)
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        ahead[i] = ahead[i + 1] + (price.delete if faults[i] in (BLANK, DUPLICATE) else min(price.delete, price.truncated) if faults[i] == TRUNCATED else 0)
    heap, closed, found = [(ahead[0], "", 0, start)], set(), {}
    while heap:
        estimate, edits, i, state = heapq.heappop(heap)
        if (i, state) in closed:
            continue
        closed.add((i, state))
        cost = estimate - ahead[i]
        if i == n:
            if not whole:
                found[state] = (cost, edits)
                continue
            if state in (START, ASSISTANT):
                return {state: (cost, edits)}
        for role in "ua":
            if (state, role) in STEP and (whole or i < n):
                heapq.heappush(heap, (estimate + price.insert, edits + "I", i, STEP[state, role]))
        if i == n:
            continue
        heapq.heappush(heap, (cost + price.delete + ahead[i + 1], edits + "D", i + 1, state))
        if faults[i] in (BLANK, DUPLICATE):
            continue
        kept = cost + ahead[i + 1] + (price.truncated if faults[i] == TRUNCATED else 0)
        if (state, initials[i]) in STEP:
            heapq.heappush(heap, (kept, edits + "K", i + 1, STEP[state, initials[i]]))
        for role in "ua":
            if (state, role) in STEP:
                heapq.heappush(heap, (kept + price.rerole, edits + "R", i + 1, STEP[state, role]))
    return found


def apply_edits(roles: Sequence[str], texts: Sequence[str], edits: str, state: int) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the rows that stand after the edits; these alone say which role a row gets."""
    out, i = [], 0
    for e in edits:
        if e in "IR":
            role = next(r for r in "ua" if (state, r) in STEP)
            out.append((e, NAMED[role], "" if e == "I" else texts[i]))
        elif e == "K":
            role = roles[i][:1]
            out.append((e, roles[i], texts[i]))
        if e != "D":
            state = STEP[state, role]
        if e != "I":
            i += 1
    return out


def first_faults(roles: Sequence[str], texts: Sequence[str], said_before: Sequence[int] = ()) -> list[int]:
    """Blank, duplicate (also rows whose places are in ``said_before``), truncated, or none."""
    seen, before, out = set(), set(said_before), []
    for k, row in enumerate(zip(roles, texts)):
        said = row[1].rstrip(BLANKS)
        out.append(BLANK if not said else DUPLICATE if row in seen or k in before else SOUND if said[-1] in ENDS else TRUNCATED)
        seen.add(row)
    return out


#: What is counted of a conversation's rows, so that it can be added up over chunks in order.
TALLY = "rows long, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string"


def tally(turns: Sequence[int | None], initials: Sequence[str], faults: Sequence[int]) -> tuple:
    known = [t for t in turns if t is not None]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    ends = (known[0], known[-1]) if known else (None, None)
    return len(initials), *ends, len(set(known)), *(sum(f == k for f in faults) for k in (BLANK, DUPLICATE, TRUNCATED)), illegal, initials[0] if initials else None, initials[-1] if initials else None


def add_tallies(a: tuple, b: tuple) -> tuple:
    """The tally of both, ``b`` being what follows ``a`` in order of turns."""
    if not (a[0] and b[0]):
        return a if a[0] else b
    low, high = (a[1] if a[1] is not None else b[1]), (b[2] if b[2] is not None else a[2])
    turns = a[3] + b[3] - (a[2] is not None and a[2] == b[1])
    illegal = a[7] + b[7] + (a[9] + b[8] not in ("su", "ua", "au"))
    return a[0] + b[0], low, high, turns, *(x + y for x, y in zip(a[4:7], b[4:7])), illegal, a[8], b[9]


def gaps(t: tuple) -> int:
    return t[2] - t[1] + 1 - t[3] if t[1] is not None else 0


# Chunks -----------------------------------------------------------------------------------------


def _arrow(df: DataFrame, run: Callable[[Iterator[tuple]], Iterator[tuple]], schema: T.StructType, most: int = 1 << 20) -> DataFrame:
    """``run`` over the rows of each partition as tuples; what it yields goes on in batches of about ``most`` bytes of text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def weight(x) -> int:
        return len(x) if isinstance(x, (str, bytes)) else sum(map(weight, x.values() if isinstance(x, dict) else x)) if isinstance(x, (list, dict)) else 8

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in given for r in zip(*(c.to_pylist() for c in b.columns)))
        made, held = [], 0
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*made), arrow)], schema=arrow)
        for row in run(rows):
            made.append(row)
            held += sum(map(weight, row))
            if held >= most or len(made) >= 10_000:
                yield pack()
                made, held = [], 0
        if made:
            yield pack()

    return df.mapInArrow(tidy(batches), schema)


@dataclass(frozen=True)
class Size:
    """Most rows of a chunk, and characters after which it is closed."""

    rows: int = 1024
    chars: int = 1 << 20


def chunks(rows: DataFrame, size: Size) -> DataFrame:
    """Rows in order as chunks: ``conv_id``, ``chunk`` (ascending along a conversation), ``alone``, ``turns``, ``roles``, ``texts``.

    ``alone`` says that the chunk is its conversation, whole.  Order: turn (nulls first), role, the
    text's first 64 characters, its hash; rows that tie in all of that are equal, and a number
    of their own deals them out.  A range partitioning gives the order, so one conversation spreads over as
    many tasks as its size asks for.
    """
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "head", "hash", "number"]
    keyed = rows.withColumns({"head": F.left("text", F.lit(64)), "hash": F.xxhash64("text"), "number": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "present")
    kind = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *T._parse_datatype_string("chunk long, alone boolean, turns array<long>, roles array<string>, texts array<string>").fields])

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        nth = TaskContext.get().partitionId() << 33
        first, waiting = True, None  # a conversation at the edge of a partition may go on beyond it
        for conv, group in groupby(given, lambda r: r[0]):
            if waiting is not None:
                yield waiting
                waiting = None
            alone, held, chars = not first, [], 0
            first = False
            for _, turn, role, text, present in group:
                if len(held) >= size.rows or chars >= size.chars:
                    alone = False
                    yield (conv, nth, alone, *map(list, zip(*held)))
                    nth, held, chars = nth + 1, [], 0
                if present:
                    held.append((turn, role, text))
                    chars += len(text)
            waiting = (conv, nth, alone, *(map(list, zip(*held)) if held else ([], [], [])))
            nth += 1
        if waiting is not None:
            yield (*waiting[:2], False, *waiting[3:])

    return _arrow(ordered, run, schema)


# Whole conversations ----------------------------------------------------------------------------

RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
STOOD = "array<struct<edit string, role string, text string>>"


def _lines(stood: Sequence[tuple[str, str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for _, role, text in stood).encode()


def _solved_alone(df: DataFrame, price: Costs, with_turns: bool) -> DataFrame:
    """Results of chunks that are whole conversations, or with ``with_turns`` their repaired rows."""
    fields = T._parse_datatype_string(f"chunk long, turns {STOOD}" if with_turns else RESULT).fields

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        for conv, chunk, turns, roles, texts in given:
            faults = first_faults(roles, texts)
            initials = [r[:1] for r in roles]
            ((cost, edits),) = search(initials, faults, START, True, price).values()
            stood = apply_edits(roles, texts, edits, START)
            if with_turns:
                yield conv, chunk, [dict(zip(("edit", "role", "text"), s)) for s in stood]
            else:
                t = tally(turns, initials, faults)
                yield conv, gaps(t), *t[4:8], cost, edits, hashlib.sha256(_lines(stood)).hexdigest()

    return _arrow(df.select("conv_id", "chunk", "turns", "roles", "texts"), run, T.StructType([df.schema["conv_id"], *fields]))


# Conversations of several chunks ------------------------------------------------------------------


def _said_before(parts: DataFrame) -> DataFrame:
    """``chunk`` and the places in it of rows whose role and text stand in an earlier chunk of their conversation."""
    said = parts.select("conv_id", "chunk", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "said"))
    # the id within the digest, as a null id equals a null id
    said = said.select("chunk", "place", F.md5(F.to_json(F.struct("conv_id", "said"))).alias("digest"))
    first = said.groupBy("digest").agg(F.min("chunk").alias("first"), F.max("chunk").alias("last")).where("first < last").drop("last")
    return said.join(first, "digest").where("chunk > first").groupBy("chunk").agg(F.collect_list("place").alias("before"))


MATRIX = f"{TALLY}, costs array<long>, ranks array<long>, edits array<string>"


def _searched(parts: DataFrame, price: Costs) -> DataFrame:
    """For each chunk its tally, and by states at its begin and end the cost, the edits and their rank among those of one begin."""

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        for conv, chunk, turns, roles, texts, before in given:
            faults = first_faults(roles, texts, before or ())
            initials = [r[:1] for r in roles]
            costs, ranks, edits = [-1] * 16, [-1] * 16, [""] * 16
            for begin in range(4):
                found = search(initials, faults, begin, False, price)
                for rank, end in enumerate(sorted(found, key=lambda q: found[q][1])):
                    spot = 4 * begin + end
                    costs[spot], edits[spot] = found[end]
                    ranks[spot] = rank
            yield conv, chunk, *tally(turns, initials, faults), costs, ranks, edits

    fields = T._parse_datatype_string(f"chunk long, {MATRIX}").fields
    return _arrow(parts.select("conv_id", "chunk", "turns", "roles", "texts", "before"), run, T.StructType([parts.schema["conv_id"], *fields]))


def _in_order(df: DataFrame, last_first: bool = False) -> DataFrame:
    """All chunks of a conversation in one task, which reads them one after another and keeps none."""
    return df.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.desc("chunk") if last_first else F.asc("chunk"))


def _chained(searched: DataFrame, price: Costs) -> tuple[DataFrame, DataFrame]:
    """Results but for edits, with the state at the end; and for each chunk the best begin of each end.

    Edits up to a chunk's end are never prefixes of one another, so their order at one end
    and the next follows from ranks, and the edits themselves need not travel.
    """
    small = searched.drop("edits")
    schema = T.StructType([searched.schema["conv_id"], *T._parse_datatype_string("chunk long, begins array<long>, done struct<gaps long, blank long, duplicate long, truncated long, illegal long, cost long, last long>").fields])

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        for conv, group in groupby(given, lambda r: r[0]):
            ways, sums, row = {START: (0, 0)}, tally((), (), ()), None
            for _, chunk, *rest in group:
                if row is not None:
                    yield (*row, None)
                sums = add_tallies(sums, tuple(rest[:10]))
                costs, ranks = rest[10:]
                begins, reached = [-1] * 4, {}
                for end in range(4):
                    choices = [(ways[p][0] + costs[4 * p + end], ways[p][1], p) for p in ways if costs[4 * p + end] >= 0]
                    if choices:
                        cost, rank, begins[end] = min(choices)
                        reached[end] = (cost, (rank, ranks[4 * begins[end] + end]))
                place = {r: k for k, r in enumerate(sorted(r for _, r in reached.values()))}
                ways = {q: (cost, place[r]) for q, (cost, r) in reached.items()}
                row = (conv, chunk, begins)
            cost, _, last = min((c + len(CLOSE[q]) * price.insert, rank, q) for q, (c, rank) in ways.items())
            yield *row, dict(zip(("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "last"), (gaps(sums), *sums[4:8], cost, last)))

    chained = materialize(_arrow(_in_order(small), run, schema))
    return chained.where("done IS NOT NULL").select("conv_id", "chunk", "done.*"), chained


def _chosen(chained: DataFrame) -> DataFrame:
    """The states at begin and end of each chunk on the cheapest way, and the insertions after the last one."""
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()), T.StructField("tail", T.StringType())])

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        end = START
        for _, chunk, begins, last in given:
            tail = ""
            if last is not None:  # the last chunk comes first
                end, tail = last, CLOSE[last]
            yield chunk, begins[end], end, tail
            end = begins[end]

    return _arrow(_in_order(chained.select("conv_id", "chunk", "begins", F.col("done.last").alias("last")), True), run, schema)


def _applied(parts: DataFrame, searched: DataFrame, chosen: DataFrame) -> DataFrame:
    """For each chunk its edits and the rows that stand after them."""
    way = chosen.join(searched.select("chunk", "edits"), "chunk").select("chunk", "begin", F.concat(F.element_at("edits", (4 * F.col("begin") + F.col("end") + 1).cast("int")), "tail").alias("edits"))

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        for conv, chunk, roles, texts, begin, edits in given:
            yield conv, chunk, edits, [dict(zip(("edit", "role", "text"), s)) for s in apply_edits(roles, texts, edits, begin)]

    schema = T.StructType([parts.schema["conv_id"], *T._parse_datatype_string(f"chunk long, edits string, turns {STOOD}").fields])
    return _arrow(parts.join(way, "chunk").select("conv_id", "chunk", "roles", "texts", "begin", "edits"), run, schema)


def _joined(applied: DataFrame) -> DataFrame:
    """Edits of each conversation and the digest of its rows, chunk after chunk."""
    schema = T.StructType([applied.schema["conv_id"], *T._parse_datatype_string("chunk long, audit string, repaired_sha256 string").fields])

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        for conv, group in groupby(given, lambda r: r[0]):
            digest, edits, begun = hashlib.sha256(), [], False
            for _, chunk, said, stood in group:
                edits.append(said)
                if stood:
                    digest.update(b"\n" * begun + _lines([tuple(s.values()) for s in stood]))
                    begun = True
            yield conv, chunk, "".join(edits), digest.hexdigest()

    return _arrow(_in_order(applied), run, schema)


@dataclass(frozen=True)
class Repaired:
    #: One row a conversation: gaps, counts of faults, illegal pairs, cost, edits, digest of the rows that stand.
    conversations: DataFrame
    #: The rows that stand, by ``conv_id``, ``chunk`` and ``place`` in it: ``edit``, ``role``, ``text``.
    turns: DataFrame


def repair(rows: DataFrame, price: Costs = Costs(), size: Size = Size()) -> Repaired:
    """The cheapest repair of every conversation of ``rows`` (conv_id, turn, role, text, and if wanted ``present``).

    Edits in the order of rows: K keeps one, R gives it the role user or assistant, D deletes it, I inserts
    an empty one; afterwards the initials of roles read ``(s?(ua)+)?``.  Blank and duplicate rows are
    deleted, truncated ones cost extra if they stay.  Rows that are not ``present`` only name their
    conversation, which may so be without rows: its result is zeros and empty.  Null role or
    text counts as one space, null turns come first, a null id is a conversation of its own; rows of one turn
    go by role, then text (64 characters, then hash).  Other columns are not read.  Chunks, and tables between the steps, go to the shared folder.
    """
    if min(price.insert, price.delete) <= 0:
        raise ValueError("insertions and deletions must cost something")
    present = F.coalesce(F.col("present"), F.lit(True)) if "present" in rows.columns else F.lit(True)
    named = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], present.alias("present"))
    cut = materialize(chunks(named, size))
    alone, parts = cut.where("alone"), cut.where("NOT alone")
    searched = materialize(_searched(parts.join(_said_before(parts), "chunk", "left"), price))
    totals, chained = _chained(searched, price)
    applied = materialize(_applied(parts, searched, _chosen(chained)))
    # the last chunk names a conversation as its id does, null too
    long = totals.join(_joined(applied).drop("conv_id"), "chunk").select("conv_id", *[c.split()[0] for c in RESULT.split(", ")])
    turns = _solved_alone(alone, price, True).unionByName(applied.drop("edits"))
    return Repaired(_solved_alone(alone, price, False).unionByName(long), turns.select("conv_id", "chunk", F.posexplode("turns").alias("place", "t")).select("conv_id", "chunk", "place", "t.*"))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults dealt out by crc32 of ``conv_id:turn``, modulo 20 (a null counts as one space, here and as role or text).

    0 drops the row (it is not ``present``), 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes its role user.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), fate.alias("fate"))
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"), (F.col("fate") != 0).alias("present"), "fate",
    )
    return rows.withColumn("copy", F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("fate", "copy")
