"""GIF pictures as bytes: code streams, palettes, disposal, transparency and timing.

``encode`` makes a timed picture of samples, ``frames`` gives the frames of any picture one
after another, so memory follows one canvas, not the number of frames.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

from .common import ship

ship(__name__)

#: Fixed values of the format: codes have 12 bits at most; marks of blocks and extensions.
CODES = 4096
IMAGE, EXTENSION, TRAILER, CONTROL = 0x2C, 0x21, 0x3B, 0xF9
#: Fixed values of the format: first row and step of the four passes of an interlaced image.
PASSES = ((0, 8), (4, 8), (2, 4), (1, 2))
#: Fixed values of the format: disposal of a frame before the next one.
KEEP, BACKGROUND, PREVIOUS = 1, 2, 3


class BrokenPicture(ValueError):
    pass


def _widths(since: np.ndarray, bits: int) -> np.ndarray:
    """Bits of the code that stands ``since`` codes after a clear code: a reader's table grows with every code but the first."""
    free = (1 << bits) + 2 + np.maximum(since - 1, 0)
    return np.minimum(np.searchsorted(1 << np.arange(1, 13), free, "right") + 1, 12)


def compress(samples: bytes, bits: int = 8) -> bytes:
    """The code stream of samples below ``1 << bits``: clear codes first and where the table is full, the end code last."""
    clear = 1 << bits
    codes, table, free = [clear], {}, clear + 2
    known = table.get
    rest = iter(samples)
    prior = next(rest, None)
    for sample in rest:
        key = prior << 8 | sample
        code = known(key)
        if code is not None:
            prior = code
            continue
        codes.append(prior)
        if free < CODES:
            table[key] = free
            free += 1
        else:
            codes.append(clear)
            table.clear()
            free = clear + 2
        prior = sample
    codes += [clear + 1] if prior is None else [prior, clear + 1]
    every = np.array(codes, np.int32)
    at = np.arange(len(every))
    # the clear code counts in the run that it ends; the first one begins the stream
    begun = np.maximum.accumulate(np.where(np.concatenate([[True], every[:-1] == clear]), at, 0))
    width = _widths(at - begun, bits)
    width[0] = bits + 1
    bit = np.arange(12)
    return np.packbits((every[:, None] >> bit & 1).astype(np.uint8)[bit < width[:, None]], bitorder="little").tobytes()


def expand(stream: bytes, bits: int, most: int) -> bytes:
    """At most ``most`` samples of a code stream; what follows the end code is not read."""
    if not 2 <= bits <= 8:
        raise BrokenPicture("size of codes")
    clear = 1 << bits
    data = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.int64)
    end, place, since, made = 8 * len(stream), 0, 0, 0
    out: list[bytes] = []
    start = [bytes([k]) for k in range(clear)] + [b"", b""]
    table, prior = start.copy(), None
    while made < most and place + bits < end:
        # the widths of a run of codes are known before they are read, up to the next clear code
        width = _widths(since + np.arange(min(CODES, (end - place) // (bits + 1))), bits)
        after = place + np.cumsum(width)
        begin, width = (after - width)[after <= end], width[after <= end]
        byte = begin >> 3
        codes = (data[byte] | data[byte + 1] << 8 | data[byte + 2] << 16) >> (begin & 7) & ((1 << width) - 1)
        stops = np.flatnonzero((codes == clear) | (codes == clear + 1))
        run = codes[: stops[0]] if len(stops) else codes
        for code in run.tolist():
            if code < len(table):
                entry = table[code]
            elif code == len(table) and prior is not None:
                entry = prior + prior[:1]
            else:
                raise BrokenPicture("code without an entry")
            out.append(entry)
            made += len(entry)
            if prior is not None and len(table) < CODES:
                table.append(prior + entry[:1])
            prior = entry
            if made >= most:
                break
        if not len(codes) or (len(stops) and codes[stops[0]] == clear + 1):
            break
        if len(stops):
            place, since = int(begin[stops[0]] + width[stops[0]]), 0
            table, prior = start.copy(), None
        else:
            place, since = int(begin[-1] + width[-1]), since + len(codes)
    return b"".join(out)[:most]


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[k : k + 255])]) + data[k : k + 255] for k in range(0, len(data), 255)) + b"\0"


def colours() -> np.ndarray:
    """256 different colours: three bits of red and green each, two of blue."""
    k = np.arange(256)
    return np.stack([(k >> 5) * 255 // 7, (k >> 2 & 7) * 255 // 7, (k & 3) * 255 // 3], 1).astype(np.uint8)


def samples_of(pixels: np.ndarray) -> np.ndarray:
    """The samples that ``colours`` shows so: the high bits of a colour are its number."""
    return pixels[..., 0] >> 5 << 5 | pixels[..., 1] >> 5 << 2 | pixels[..., 2] >> 6


def encode(samples: bytes, width: int, rows: int, delay: int = 10) -> bytes:
    """Samples as a picture of frames with ``rows`` rows at most, ``delay`` hundredths of a second each.

    A frame that repeats at least half of what it covers says so: these samples are transparent,
    if it leaves a sample value free for that.
    """
    if not samples or len(samples) % width:
        raise ValueError("samples must fill rows")
    high = min(rows, len(samples) // width)
    out = [b"GIF89a", struct.pack("<HHBBB", width, high, 0xF7, 0, 0), colours().tobytes(), b"!\xff\x0bNETSCAPE2.0\x03\x01\0\0\0"]
    prior = b""
    for at in range(0, len(samples), high * width):
        part = samples[at : at + high * width]
        flags, hidden, shown = KEEP << 2, 0, part
        if prior:
            new, old = np.frombuffer(part, np.uint8), np.frombuffer(prior, np.uint8)[: len(part)]
            free = np.flatnonzero(np.bincount(new, minlength=256) == 0)
            same = new == old
            if len(free) and 2 * int(same.sum()) >= len(new):
                hidden, flags = int(free[-1]), flags | 1
                shown = np.where(same, np.uint8(hidden), new).tobytes()
        out.append(struct.pack("<BBBBHBB", EXTENSION, CONTROL, 4, flags, delay, hidden, 0))
        out.append(struct.pack("<BHHHHBB", IMAGE, 0, 0, width, len(part) // width, 0, 8))
        out.append(_blocks(compress(shown)))
        prior = part + prior[len(part) :]
    return b"".join([*out, bytes([TRAILER])])


@dataclass(frozen=True)
class Frame:
    """What the canvas shows from ``start`` on for ``delay`` hundredths of a second, and the part that this frame has drawn on."""

    nth: int
    start: int
    delay: int
    left: int
    top: int
    width: int
    height: int
    #: Red, green, blue and opacity; the next frame draws on a copy.
    canvas: np.ndarray

    @property
    def drawn(self) -> np.ndarray:
        return self.canvas[self.top : self.top + self.height, self.left : self.left + self.width]


class _Bytes:
    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.data):
            raise BrokenPicture("ends too early")
        self.at += n
        return self.data[self.at - n : self.at]

    def read(self, form: str) -> tuple:
        return struct.unpack(form, self.take(struct.calcsize(form)))

    def blocks(self) -> bytes:
        out = []
        while size := self.take(1)[0]:
            out.append(self.take(size))
        return b"".join(out)

    def palette(self, flags: int) -> np.ndarray | None:
        return np.frombuffer(self.take(3 << (flags & 7) + 1), np.uint8).reshape(-1, 3) if flags & 0x80 else None


def _rows(height: int, interlaced: bool) -> Sequence[int]:
    return [r for first, step in PASSES for r in range(first, height, step)] if interlaced else range(height)


def frames(picture: bytes, most: int = 1 << 26) -> Iterator[Frame]:
    """The frames as they are shown.  Raises ``BrokenPicture``, also for a canvas of more than ``most`` pixels.

    A sample that is the transparent one, or that the palette lacks, leaves the canvas as it is.
    """
    source = _Bytes(picture)
    if source.take(6) not in (b"GIF87a", b"GIF89a"):
        raise BrokenPicture("not a GIF")
    wide, high, flags, _, _ = source.read("<HHBBB")
    if wide * high > most:
        raise BrokenPicture("canvas too large")
    common = source.palette(flags)
    canvas = np.zeros((high, wide, 4), np.uint8)
    nth = start = 0
    control = (0, 0, 0)
    while (mark := source.take(1)[0]) != TRAILER:
        if mark == EXTENSION:
            label = source.take(1)[0]
            said = source.blocks()
            if label == CONTROL and len(said) >= 4:
                control = struct.unpack("<BHB", said[:4])
            continue
        if mark != IMAGE:
            raise BrokenPicture("unknown block")
        left, top, width, height, image = source.read("<HHHHB")
        if left + width > wide or top + height > high:
            raise BrokenPicture("image outside the canvas")
        own = source.palette(image)
        palette = common if own is None else own
        if palette is None:
            raise BrokenPicture("no palette")
        bits = source.take(1)[0]
        samples = np.frombuffer(expand(source.blocks(), bits, width * height), np.uint8)
        if len(samples) < width * height:
            raise BrokenPicture("too few samples")
        drawn = np.empty((height, width), np.uint8)
        drawn[list(_rows(height, bool(image & 0x40)))] = samples.reshape(height, width)
        flags, delay, hidden = control
        opaque = drawn < len(palette)
        if flags & 1:
            opaque &= drawn != hidden
        before = canvas
        canvas = canvas.copy()
        spot = canvas[top : top + height, left : left + width]
        solid = np.full((256, 4), 255, np.uint8)
        solid[: len(palette), :3] = palette
        if opaque.all():
            spot[...] = solid[drawn]
        else:
            spot[opaque] = solid[drawn[opaque]]
        yield Frame(nth, start, delay, left, top, width, height, canvas)
        disposal = flags >> 2 & 7
        if disposal == BACKGROUND:
            canvas = canvas.copy()
            canvas[top : top + height, left : left + width] = 0
        elif disposal == PREVIOUS:
            canvas = before
        nth, start, control = nth + 1, start + delay, (0, 0, 0)


def histogram(pixels: np.ndarray) -> np.ndarray:
    """Opaque pixels by the two high bits of red, green and blue: 64 counts."""
    shown = pixels.reshape(-1, 4)
    shown = shown[shown[:, 3] > 0].astype(np.int64)
    return np.bincount((shown[:, 0] >> 6) << 4 | (shown[:, 1] >> 6) << 2 | shown[:, 2] >> 6, minlength=64)
