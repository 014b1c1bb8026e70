"""Fill-in-middle, pictures and conversation repair against plain versions of their contracts."""

import collections
import hashlib
import itertools
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import dialogue, gif, infill, media

from .test_llm import CLASH, awkward, empty, frame, raw

# 11 ---------------------------------------------------------------------------------------------

TEXTS = ["", "\n", "\n\n", "a", "a\nb", "a\n", "\r\n x\n\n y ", "one. Two!? three", "é\U0001f600\U0001f601 日本\n語.", " lead  trail ", "a b\u0085c\n", "x" * 5000 + "\n" + "y " * 4000]


@pytest.mark.parametrize("units", [infill.LINES, infill.WORDS, infill.SENTENCES, infill.CHARACTERS, infill.begun_by("#\n"), infill.runs(r"0-9\x20")])
def test_boundaries_cut_as_the_grammar_does(spark, units):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k int, t string").select("t", infill.pieces(F.col("t"), units).alias("u")).collect()
    for r in rows:
        assert r.u == re.findall(units.pattern, r.t), r.t[:40]
        assert "".join(r.u) == r.t


def infill_by_hand(i, text, pattern, seed, rate, spm):
    t = text or ""
    h = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    u = re.findall(pattern, t)
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(u), "plain", None, None, t
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    return (len(u), "spm", p, m, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else (len(u), "psm", p, m, f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("rate,spm,seed", [(100, 50, 7), (60, 0, 3), (100, 100, 1), (0, 50, 7)])
def test_infill_against_a_plain_version(spark, rate, spm, seed):
    rows = [*awkward(), (None, "no\nid\n"), (901, "a<P>b\n<"), (902, "x<\n<S\n<M\n>\n"), (903, "<\n" * 40)] + [(1000 + k, t) for k, t in enumerate(TEXTS)]
    df = frame(spark, rows)
    assert {"prefix", "base"} < set(df.columns)
    made = infill.fill_in_middle(df, seed=seed, rate=rate, spm=spm)
    assert [c for c in made.columns if c not in ("n", "form", "prefix", "middle", "suffix", "output")] == [c for c in df.columns if c != "prefix"]
    got = collections.Counter((r.doc_id, r.text, r.n, r.form, r.prefix, r.middle, r.output, r.back, r.key) for r in made.withColumn("back", infill.restore(F.col("output"), F.col("form"))).collect())
    want = collections.Counter((i, t, *infill_by_hand(i, t, infill.LINES.pattern, seed, rate, spm), t or "", "clash") for i, t in rows)
    assert got == want
    assert infill.fill_in_middle(empty(spark)).collect() == []


def test_infill_with_other_marks(spark):
    marks = infill.Marks("[fim.p]", "[fim.s]", "$m|")
    made = infill.fill_in_middle(frame(spark, awkward()), marks=marks)
    for r in made.withColumn("back", infill.restore(F.col("output"), F.col("form"), marks)).collect():
        assert r.back == (r.text or "")


def test_infill_report(spark):
    rows = awkward()
    got = collections.Counter(tuple(r) for r in infill.report(frame(spark, rows)).collect())
    want = collections.Counter()
    for i, t in rows:
        n, form, p, m, out = infill_by_hand(i, t, infill.LINES.pattern, 7, 100, 50)
        want[i, n, form, p and len(p) if p is None else len(p), m if m is None else len(m), hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(raw(t)).hexdigest()] += 1
    assert got == want


# 12 ---------------------------------------------------------------------------------------------


def codes_by_hand(stream, bits):
    """The code stream of one image, bit by bit."""
    bit = [b >> k & 1 for b in stream for k in range(8)]
    at, clear, out, table, width, prior = 0, 1 << bits, [], None, bits + 1, None
    while True:
        code = sum(b << k for k, b in enumerate(bit[at : at + width]))
        at += width
        if code == clear:
            table, width, prior = {k: (k,) for k in range(clear)}, bits + 1, None
            free = clear + 2
            continue
        if code == clear + 1:
            return out
        entry = table[code] if code in table else prior + prior[:1]
        out.extend(entry)
        if prior is not None and free < 4096:
            table[free] = prior + entry[:1]
            free += 1
            if free == 1 << width and width < 12:
                width += 1
        prior = entry


def picture_by_hand(data):
    """(canvas as colours or None, drawn box, delay) of each frame, pixel by pixel."""
    at = 13
    size = lambda flags: 3 << (flags & 7) + 1
    wide, high, flags = struct.unpack("<HHB", data[6:11])
    common = None
    if flags & 128:
        common, at = data[at : at + size(flags)], at + size(flags)
    canvas, control, out = {}, (0, 0, 0), []

    def blocks(at):
        got = b""
        while data[at]:
            got, at = got + data[at + 1 : at + 1 + data[at]], at + 1 + data[at]
        return got, at + 1

    while data[at] != 0x3B:
        if data[at] == 0x21:
            label = data[at + 1]
            said, at = blocks(at + 2)
            if label == 0xF9:
                control = (said[0], said[1] | said[2] << 8, said[3])
            continue
        x, y, w, h, flags = struct.unpack("<HHHHB", data[at + 1 : at + 10])
        at += 10
        palette = common
        if flags & 128:
            palette, at = data[at : at + size(flags)], at + size(flags)
        bits = data[at]
        said, at = blocks(at + 1)
        samples = codes_by_hand(said, bits)
        order = [r for a, s in ((0, 8), (4, 8), (2, 4), (1, 2)) for r in range(a, h, s)] if flags & 64 else list(range(h))
        before = dict(canvas)
        for k, row in enumerate(order):
            for c in range(w):
                v = samples[k * w + c]
                if not (control[0] & 1 and v == control[2]) and 3 * v + 3 <= len(palette):
                    canvas[y + row, x + c] = tuple(palette[3 * v : 3 * v + 3])
        out.append((dict(canvas), (x, y, w, h), control[1], (wide, high)))
        how = control[0] >> 2 & 7
        if how == 2:
            for r, c in itertools.product(range(y, y + h), range(x, x + w)):
                canvas.pop((r, c), None)
        elif how == 3:
            canvas = before
        control = (0, 0, 0)
    return out


def blocks_of(data):
    return b"".join(bytes([len(data[k : k + 100])]) + data[k : k + 100] for k in range(0, len(data), 100)) + b"\0"


def odd_picture(rng, frames=6):
    """Frames of all sizes, some interlaced, with own palettes, transparent samples and every disposal."""
    wide, high = rng.randint(5, 30), rng.randint(5, 30)
    shades = lambda n: bytes(rng.randrange(256) for _ in range(3 * n))
    out = [b"GIF89a", struct.pack("<HHBBB", wide, high, 0x80 | 3, 0, 0), shades(16), b"!\xfe\x05hello\0"]
    for _ in range(frames):
        w, h = rng.randint(1, wide), rng.randint(1, high)
        bits = rng.choice((2, 4, 8))
        flags = rng.choice((0, 64)) | rng.choice((0, 128 | (bits - 1)))
        if rng.random() < 0.8:
            out.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, rng.choice((0, 1, 2, 3)) << 2 | rng.choice((0, 1)), rng.randrange(500), rng.randrange(4), 0))
        out.append(struct.pack("<BHHHHB", 0x2C, rng.randint(0, wide - w), rng.randint(0, high - h), w, h, flags))
        if flags & 128:
            out.append(shades(1 << bits))
        out.append(bytes([bits]) + blocks_of(gif.compress(bytes(rng.randrange(1 << bits) for _ in range(w * h)), bits)))
    return b"".join([*out, b";"])


def test_frames_against_a_plain_reader():
    rng = random.Random(4)
    for _ in range(25):
        data = odd_picture(rng)
        want = picture_by_hand(data)
        got = list(gif.frames(data))
        assert len(got) == len(want)
        start = 0
        for f, (canvas, (x, y, w, h), delay, (wide, high)) in zip(got, want):
            assert (f.left, f.top, f.width, f.height, f.delay, f.start) == (x, y, w, h, delay, start)
            start += delay
            shown = {(r, c): tuple(int(v) for v in f.canvas[r, c, :3]) for r in range(high) for c in range(wide) if f.canvas[r, c, 3]}
            assert shown == canvas
            assert gif.histogram(f.canvas).tolist() == [sum(1 for p in canvas.values() if (p[0] >> 6, p[1] >> 6, p[2] >> 6) == (k >> 4, k >> 2 & 3, k & 3)) for k in range(64)]


@pytest.mark.parametrize("bits", [2, 3, 5, 8])
def test_code_streams(bits):
    rng = random.Random(bits)
    for n in (0, 1, 2, 3, 254, 255, 256, 257, 3836, 3837, 3838, 3839, 3840, 3841, 9000, 60000):
        for spread in (1, 2, 1 << bits):
            data = bytes(rng.randrange(spread) for _ in range(n))
            stream = gif.compress(data, bits)
            assert gif.expand(stream, bits, n) == data
            if n < 10000:
                assert bytes(codes_by_hand(stream, bits)) == data


def test_broken_pictures(spark):
    whole = gif.encode(media.payload(b"some text " * 500), 64, 16)
    assert media.read_picture(whole)[0] == media.payload(b"some text " * 500)
    for data in (b"", b"GIF89a", b"PNG" + whole, whole[:-1], whole[:900], whole[:13] + b"\x2c" + whole[13:], whole.replace(struct.pack("<HHBB", 64, 16, 0, 8), struct.pack("<HHBB", 64, 16, 0, 12), 1)):
        assert media.read_picture(data)[-1], data[:20]
    rows = spark.createDataFrame([(1, whole), (2, whole[:-1]), (3, None), (4, b"")], "id int, media binary").withColumn("hist", F.lit("clash"))
    got = {r.id: r for r in media.read_pictures(rows).collect()}
    assert got[1].fault is None and bytes(got[1].payload) == media.payload(b"some text " * 500)
    assert all(got[k].fault and got[k].payload is None and got[k].hist is None for k in (2, 3, 4))
    # every frame before a fault is there
    assert collections.Counter(r.id for r in media.timed_frames(rows, "id").collect()) == {1: 5, 2: 5}


def test_media_report_against_a_plain_version(spark):
    rows = awkward() + [(900, "z" * 64), (901, "z" * 63), (902, "same line of text\n" * 9000), (903, "\U0001f600" * 33), (None, "no id")]
    got = collections.Counter()
    shades = gif.colours().astype(int)
    stored = {(r.doc_id, r.text): bytes(r.media) for r in media.store_texts(frame(spark, rows)).collect()}
    for r in media.report(frame(spark, rows)).collect():
        got[tuple(r)] += 1
    want = collections.Counter()
    for i, t in rows:
        data = raw(t)
        pay = data + b"\0" * ((64 - len(data) % 64) % 64 or (0 if data else 64))
        picture = stored[i, t]
        if len(pay) < 40000:
            read = b""
            colour = {tuple(c): k for k, c in enumerate(shades.tolist())}
            for canvas, (x, y, w, h), _, _ in picture_by_hand(picture):
                read += bytes(colour[canvas[r, c]] for r in range(y, y + h) for c in range(x, x + w))
            assert read == pay
        count = collections.Counter((shades[b][0] >> 6) << 4 | (shades[b][1] >> 6) << 2 | shades[b][2] >> 6 for b in pay)
        n = -(-len(pay) // (64 * media.ROWS))
        feature = f"64x{min(len(pay) // 64, media.ROWS)}:{n}:{100 * n}:" + ",".join(str(count[k]) for k in range(64))
        want[i, len(data), len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-64:]), len(picture), hashlib.sha256(picture).hexdigest(), feature] += 1
    assert got == want
    assert media.report(empty(spark)).collect() == []


def test_repeated_frames_are_transparent():
    pay = media.payload(b"one line that repeats itself, again" * 4000)
    pay = pay[: 64 * 16] * 20
    picture = gif.encode(pay, 64, 16)
    assert len(picture) < 5000 and media.read_picture(picture)[0] == pay
    assert sum(f.delay for f in gif.frames(picture)) == 200


def test_timed_frames(spark):
    rows = spark.createDataFrame([(k, bytearray(odd_picture(random.Random(k)))) for k in range(8)], "key long, media binary").withColumns({c: F.lit(1) for c in CLASH if c not in ("key", "media")})
    got = media.timed_frames(rows, "key", most=2000).collect()
    want = [(k, f) for k in range(8) for f in gif.frames(odd_picture(random.Random(k)))]
    assert [(r.key, r.frame) for r in sorted(got, key=lambda r: (r.key, r.frame))] == [(k, f.nth) for k, f in want]
    by = {(r.key, r.frame): r for r in got}
    for k, f in want:
        r = by[k, f.nth]
        assert (r.start_ms, r.delay_ms) == (10 * f.start, 10 * f.delay)
        assert np.array_equal(np.frombuffer(r.rgba, np.uint8).reshape(r.height, r.width, 4), f.canvas)
        assert r.hist == gif.histogram(f.canvas).tolist()


# 13 ---------------------------------------------------------------------------------------------

GOOD = re.compile(r"(s?(ua)+)?\Z")


def cheapest_by_hand(initials, faults, price, inserts=2):
    """Every edit sequence of a few rows, with at most ``inserts`` rows before each row and at the end."""
    best = None
    plans = []
    for f in faults:
        plans.append([("D", "")] + ([] if f in (1, 2) else [("K", None), ("R", "u"), ("R", "a")]))
    gaps = ["", *("".join(p) for k in range(1, inserts + 1) for p in itertools.product("ua", repeat=k))]
    for edits in itertools.product(*plans):
        for added in itertools.product(gaps, repeat=len(initials) + 1):
            said, cost, roles = "", 0, ""
            for k, (e, role) in enumerate(edits):
                said += "I" * len(added[k]) + e
                roles += added[k] + (initials[k] if e == "K" else role)
                cost += price.insert * len(added[k]) + {"D": price.delete, "K": 0, "R": price.rerole}[e] + (price.truncated if faults[k] == 3 and e != "D" else 0)
            said, roles, cost = said + "I" * len(added[-1]), roles + added[-1], cost + price.insert * len(added[-1])
            if GOOD.match(roles) and (best is None or (cost, said) < best):
                best = (cost, said)
    return best


def test_search_against_all_edits():
    rng = random.Random(2)
    prices = [dialogue.Costs(), dialogue.Costs(3, 4, 1, 2), dialogue.Costs(1, 9, 2, 0), dialogue.Costs(0, 1, 1, 1)]
    for k in range(160):
        n = rng.randint(0, 3)
        initials, faults = [rng.choice("suaux") for _ in range(n)], [rng.choice((0, 0, 0, 1, 2, 3)) for _ in range(n)]
        price = prices[k % 4]
        ((cost, edits),) = dialogue.search(initials, faults, dialogue.START, True, price).values()
        assert (cost, edits) == cheapest_by_hand(initials, faults, price), (initials, faults, price)


def repaired_by_hand(rows, price=dialogue.Costs()):
    """By conversation the contract's columns, from all ways of a plain table of states."""
    by = collections.defaultdict(list)
    for conv, turn, role, text, present in rows:
        by[conv]
        if present is not False:
            by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, said in by.items():
        seen, faults = set(), []
        for _, role, text in said:
            body = text.strip(" \t\n\x0b\x0c\r")
            faults.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
            seen.add((role, text))
        ways = {0: (0, "", ())}
        better = lambda to, q, w: to.__setitem__(q, min(to.get(q, w), w))

        def with_inserts(ways):
            for _ in range(3):
                new = dict(ways)
                for (q, r), z in dialogue.STEP.items():
                    if r in "ua" and q in ways:
                        c, e, o = ways[q]
                        better(new, z, (c + price.insert, e + "I", (*o, {"u": "user:", "a": "assistant:"}[r])))
                ways = new
            return ways

        for (_, role, text), f in zip(said, faults):
            ways, new = with_inserts(ways), {}
            for q, (c, e, o) in ways.items():
                better(new, q, (c + price.delete, e + "D", o))
                if f in (1, 2):
                    continue
                more = c + (price.truncated if f == 3 else 0)
                for (p, r), z in dialogue.STEP.items():
                    if p == q and role[:1] == r:
                        better(new, z, (more, e + "K", (*o, f"{role}:{text}")))
                    if p == q and r in "ua":
                        better(new, z, (more + price.rerole, e + "R", (*o, f"{dialogue.NAMED[r]}:{text}")))
            ways = new
        ways = with_inserts(ways)
        cost, edits, lines = min(ways[q] for q in (0, 3) if q in ways)
        turns = [t for t, _, _ in said if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def talk(seed, convs=30, hot=400):
    """Conversations of all sizes, one of them hot, with nulls, repeats, blanks and rows that are not present."""
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "no", " ", "", "\n\t", "What? ", "Cut off here", "Fine!\n", "a" * 300 + ".", None, "é。"]
    for conv in [*range(convs), None, "hot"]:
        for turn in range(hot if conv == "hot" else rng.choice((1, 2, 3, 5, 9, 17))):
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.7 else rng.choice(("system", "user", "assistant", "tool", "", "users", "Assistant", None))
            own = f"{rng.random()} " if rng.random() < 0.7 else ""
            pick = rng.choice(texts)
            rows.append((None if conv is None else 7 if conv == "hot" else conv * 10, None if rng.random() < 0.05 else 2 * turn, role, None if pick is None else own + pick, rng.random() > 0.1))
    return rows


def sorted_as_defined(spark, rows):
    """The order of rows of one turn, from Spark's own hash."""
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, present boolean")
    said = lambda c: F.coalesce(F.col(c), F.lit(" "))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), said("role"), F.left(said("text"), F.lit(64)), F.xxhash64(said("text"))]
    return df, [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.mark.parametrize("size", [dialogue.Size(), dialogue.Size(rows=1), dialogue.Size(rows=3), dialogue.Size(rows=40, chars=500)])
@pytest.mark.parametrize("price", [dialogue.Costs(), dialogue.Costs(2, 3, 1, 1)])
def test_repair_against_a_plain_version(spark, size, price):
    df, rows = sorted_as_defined(spark, talk(3))
    df = df.withColumns({c: F.lit("clash") for c in CLASH if c not in df.columns}).repartition(5)
    made = dialogue.repair(df, price, size)
    got = {r.conv_id: tuple(r)[1:] for r in made.conversations.collect()}
    assert got == repaired_by_hand(rows, price)
    # the rows that stand give the digest
    by = collections.defaultdict(list)
    for r in made.turns.orderBy("conv_id", "chunk", "place").collect():
        by[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(by[c]).encode()).hexdigest() for c in got} == {c: v[-1] for c, v in got.items()}


def test_one_conversation_spreads_over_tasks(spark):
    """Equal rows of one conversation are dealt out, and no task reads them all."""
    rows = spark.range(6000).selectExpr("1L AS conv_id", "0L AS turn", "'user' AS role", "'Same.' AS text", "true AS present")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would share a task
    try:
        cut = dialogue.chunks(rows.repartition(8), dialogue.Size(rows=100))
        per = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per) > 2 and max(per) < 40
    ((gaps, blank, duplicate, *_, cost, edits, _),) = [tuple(r)[1:] for r in dialogue.repair(rows, size=dialogue.Size(rows=100)).conversations.collect()]
    assert (gaps, blank, duplicate, cost) == (0, 0, 5999, 12000) and edits == "D" * 6000


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert dialogue.repair(none).conversations.collect() == []
    assert dialogue.repair(dialogue.damage(none)).turns.collect() == []
    gone = spark.createDataFrame([(1, 0, "user", "Hi.", False)], "conv_id long, turn long, role string, text string, present boolean")
    (row,) = dialogue.repair(gone).conversations.collect()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_damage(spark):
    rows = [(c, t, r, x) for c, t, r, x in itertools.product((None, 1, 2), (None, *range(40)), (None, "assistant"), ("Oh! Yes? No.", None))]
    got = collections.Counter(tuple(r) for r in dialogue.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    want = collections.Counter()
    for c, t, r, x in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if fate == 1 else re.sub("[.!?]", "", x) if fate == 2 else x
        want[c, t, "user" if fate == 4 else r, x, fate != 0] += 2 if fate == 3 else 1
    assert got == want
