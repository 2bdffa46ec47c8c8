"""Media columns in GIF: LZW code streams, palettes, disposal and transparency, timed frames.

`decode` reads any GIF87a / GIF89a stream: LZW with growing code widths, local palettes,
interlace, the four disposal methods and transparency, composited on the logical screen.  `encode`
writes 8-bit samples losslessly as timed grey frames that replace each other, compressed by LZW with a table that
grows to 4096 entries and is then cleared.  Codes are packed and read in whole runs up to a clear code, as arrays.

Edge cases: a null or empty payload is stored as one row of zeros; a broken or cut stream gives
the frames before the break and then a row with `error`; a screen of over MAX_PIXELS is such an error, whatever
its header says, and so is a frame outside the screen; repeated rows are stored each on its own; a null id stays null;
payloads of any length are cut into frames of bounded height; extra columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import durable

WIDTH = 64
FRAME_ROWS = 1024
DELAY_CS = 4
#: Pixels of the largest screen that is decoded; bytes of texts that a worker codes at once.
MAX_PIXELS, HELD = 1 << 24, 1 << 21
#: Entries of a full table, and codes that are read at once.
FULL, READ = 4096, 4096
GREY = np.repeat(np.arange(256, dtype=np.uint8), 3).reshape(256, 3)
BINS = 8


@dataclass
class Frame:
    """One shown frame: the whole screen after compositing, and the frame's own rectangle."""

    left: int
    top: int
    width: int
    height: int
    delay_cs: int
    disposal: int
    transparent: int | None
    screen: np.ndarray  # rows x columns x RGBA

    def own(self) -> np.ndarray:
        return self.screen[self.top : self.top + self.height, self.left : self.left + self.width]


def _blocks(data: np.ndarray) -> bytes:
    """Data in sub-blocks of 255 bytes and the closing zero."""
    q = len(data) // 255
    full = np.empty((q, 256), np.uint8)
    full[:, 0] = 255
    full[:, 1:] = data[: q * 255].reshape(q, 255)
    rest = data[q * 255 :].tobytes()
    return full.tobytes() + (bytes([len(rest)]) + rest if rest else b"") + b"\0"


def code_widths(minimum: int, n: int) -> np.ndarray:
    """Bits of each of n codes after a clear code.  A reader's table grows with each code but the first."""
    size = np.minimum((1 << minimum) + 1 + np.arange(n), FULL - 1)
    return np.maximum(minimum + 1, np.frexp(size)[1].astype(np.int64))


def compress(samples: bytes, minimum: int = 8) -> list[int]:
    """LZW codes: clear codes where the table is new, the end code last."""
    clear = 1 << minimum
    out, table, size, rest = [clear], {}, clear + 2, iter(samples)
    put, known = out.append, table.get
    word = next(rest, None)
    if word is not None:
        for x in rest:
            longer = word << 8 | x
            code = known(longer)
            if code is not None:
                word = code
                continue
            put(word)
            word = x
            if size < FULL:
                table[longer] = size
                size += 1
            else:
                put(clear)
                table.clear()
                size = clear + 2
        put(word)
    put(clear + 1)
    return out


def pack(streams: list[list[int]], minimum: int = 8) -> list[np.ndarray]:
    """Each stream's codes as bytes, least significant bit first, each code as wide as its place after a clear code says."""
    sizes = np.array([len(x) for x in streams])
    codes = np.fromiter(chain.from_iterable(streams), np.int64, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    starts = np.unique(np.concatenate([first, np.flatnonzero(codes == 1 << minimum) + 1]))
    place = np.arange(len(codes))
    place -= starts[np.searchsorted(starts, place, "right") - 1]
    width = code_widths(minimum, int(place.max(initial=0)) + 1)[place]
    length = -(-np.add.reduceat(width, first) // 8)
    byte = np.cumsum(length) - length
    at = np.cumsum(width) - width
    at += np.repeat(8 * byte - at[first], sizes)
    shifted = codes << (at & 7)
    out = np.zeros(int(length.sum()) + 3)
    for k in range(3):  # no two codes share a bit, so sums are unions
        out += np.bincount((at >> 3) + k, weights=(shifted >> (8 * k)) & 255, minlength=len(out))
    out = out.astype(np.uint8)
    return [out[a : a + n] for a, n in zip(byte.tolist(), length.tolist())]


def encode(payloads: list[bytes], width: int = WIDTH, frame_rows: int = FRAME_ROWS, delay_cs: int = DELAY_CS) -> list[bytes]:
    """Each payload (samples, a multiple of `width`) as grey frames of at most `frame_rows` rows, one after another."""
    step = width * frame_rows
    bodies = iter(pack([compress(p[a : a + step]) for p in payloads for a in range(0, len(p), step)]) if payloads else ())
    out = []
    for p in payloads:
        parts = [b"GIF89a", struct.pack("<HHBBB", width, min(len(p) // width, frame_rows), 0xF7, 0, 0), GREY.tobytes()]
        for a in range(0, len(p), step):
            parts += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, delay_cs, 0), b"\0", b"\x2c", struct.pack("<HHHHB", 0, 0, width, min(step, len(p) - a) // width, 0), b"\x08", _blocks(next(bodies))]
        out.append(b"".join([*parts, b"\x3b"]))
    return out


def _unblock(data: np.ndarray, at: int) -> tuple[np.ndarray, int]:
    """The bytes of a chain of sub-blocks, and the place after it."""
    parts = []
    while True:
        heads = data[at::256]
        short = heads != 255
        q = int(short.argmax()) if short.any() else len(heads)
        if q and at + 256 * q <= len(data):
            parts.append(data[at : at + 256 * q].reshape(q, 256)[:, 1:].ravel())
            at += 256 * q
        if at >= len(data):
            raise ValueError("cut sub-block")
        n = int(data[at])
        at += 1
        if not n:
            break
        if at + n > len(data):
            raise ValueError("cut sub-block")
        parts.append(data[at : at + n])
        at += n
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint8)), at


@cache
def _reading(minimum: int) -> np.ndarray:
    return code_widths(minimum, READ)


def unpack(data: np.ndarray, minimum: int) -> Iterator[list[int]]:
    """Codes of a stream, run by run: what stands between clear codes, the last up to the end code or the stream's end."""
    clear, end = 1 << minimum, (1 << minimum) + 1
    wide = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
    wide = wide[:-2] | wide[1:-1] << 8 | np.append(wide[2:], 0)[: len(wide) - 2] << 16
    widths, bits, at, run = _reading(minimum), 8 * len(data), 0, []
    place = 0
    while True:
        width = widths[place:] if place < READ else np.full(READ, 12)
        past = at + np.cumsum(width)
        width = width[: np.searchsorted(past, bits, "right")]
        past = past[: len(width)]
        first = past - width
        codes = wide[first >> 3] >> (first & 7) & ((1 << width) - 1)
        stop = np.flatnonzero((codes == clear) | (codes == end))
        if len(stop):
            run += codes[: stop[0]].tolist()
            yield run
            if codes[stop[0]] == end:
                return
            at, run, place = int(past[stop[0]]), [], 0
        elif not len(width):
            yield run
            return
        else:
            run += codes.tolist()
            at, place = int(past[-1]), place + len(width)


def lzw(data: np.ndarray, minimum: int) -> np.ndarray:
    """Samples of an LZW code stream."""
    if not 1 <= minimum <= 8:
        raise ValueError("code size")
    clear, out = 1 << minimum, []
    fresh = [bytes([i]) for i in range(clear)] + [b"", b""]
    for run in unpack(data, minimum):
        if not run:
            continue
        if run[0] >= clear:
            raise ValueError("code before any literal")
        entries, previous = fresh[:], fresh[run[0]]
        out.append(previous)
        room = FULL - len(entries)  # the table grows with so many codes
        for code in run[1 : room + 1]:
            try:
                word = entries[code]
            except IndexError:
                if code > len(entries):
                    raise ValueError("code beyond the table") from None
                word = previous + previous[:1]
            out.append(word)
            entries.append(previous + word[:1])
            previous = word
        out += [entries[code] for code in run[room + 1 :]]
    return np.frombuffer(b"".join(out), np.uint8)


def decode(media: bytes) -> Iterator[Frame]:
    """Composited frames in order."""
    data = np.frombuffer(media, np.uint8)
    if media[:6] not in (b"GIF87a", b"GIF89a") or len(media) < 13:
        raise ValueError("no GIF header")
    columns, rows, flags = struct.unpack_from("<HHB", media, 6)
    at, shared = 13, None
    if flags & 0x80:
        n = 2 << (flags & 7)
        shared = data[at : at + 3 * n].reshape(n, 3)
        at += 3 * n
    if rows * columns > MAX_PIXELS:
        raise ValueError("screen too large")
    screen = np.zeros((rows, columns, 4), np.uint8)
    delay, disposal, transparent = 0, 0, None
    while at < len(data):
        kind = media[at]
        if kind == 0x3B:
            return
        if kind == 0x21:
            label = media[at + 1]
            body, at = _unblock(data, at + 2)
            if label == 0xF9 and len(body) >= 4:
                packed, delay, index = struct.unpack("<BHB", body[:4].tobytes())
                disposal, transparent = packed >> 2 & 7, index if packed & 1 else None
            continue
        if kind != 0x2C:
            raise ValueError("unknown block")
        left, top, width, height, packed = struct.unpack_from("<HHHHB", media, at + 1)
        at += 10
        palette = shared
        if packed & 0x80:
            n = 2 << (packed & 7)
            palette = data[at : at + 3 * n].reshape(n, 3)
            at += 3 * n
        if palette is None:
            raise ValueError("no palette")
        minimum = media[at]
        body, at = _unblock(data, at + 1)
        index = lzw(body, minimum)[: width * height]
        if len(index) < width * height or left + width > columns or top + height > rows:
            raise ValueError("frame size")
        index = index.reshape(height, width)
        if packed & 0x40:
            order = np.concatenate([np.arange(s, height, d) for s, d in ((0, 8), (4, 8), (2, 4), (1, 2))])
            straight = np.empty_like(index)
            straight[order] = index
            index = straight
        if index.max(initial=0) >= len(palette):
            raise ValueError("index beyond the palette")
        before = screen.copy() if disposal == 3 else None
        place = screen[top : top + height, left : left + width]
        colour = np.empty((height, width, 4), np.uint8)
        colour[..., :3] = palette[index]
        colour[..., 3] = 255
        if transparent is None:
            place[...] = colour
        else:
            shown = index != transparent
            place[shown] = colour[shown]
        yield Frame(left, top, width, height, delay, disposal, transparent, screen)
        if disposal == 2:
            place[...] = 0
        elif disposal == 3:
            screen = before
        delay, disposal, transparent = 0, 0, None
    raise ValueError("no trailer")


def histogram(frame: Frame) -> np.ndarray:
    """BINS counts for each of red, green and blue over the frame's own shown pixels."""
    own = frame.own().reshape(-1, 4)
    seen = own[own[:, 3] > 0]
    return np.concatenate([np.bincount(seen[:, c] >> 5, minlength=BINS) for c in range(3)])


def payload(raw: bytes) -> bytes:
    """Bytes and zeros up to a positive multiple of WIDTH."""
    return raw + bytes(-len(raw) % WIDTH if raw else WIDTH)


def to_gif(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text as one GIF."""

    def run(batches):
        for batch in batches:
            first, held, texts = 0, 0, []
            for i, t in enumerate(batch.column(1)):
                texts.append((t.as_py() or "").encode())
                held += len(texts[-1])
                if held > HELD or i == batch.num_rows - 1:
                    media = encode([payload(x) for x in texts])
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(map(len, texts), pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])
                    first, held, texts = i + 1, 0, []

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, n_bytes bigint, media binary")


def frames(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """A row for each timed frame: place, delay, disposal, RGBA pixels of the screen and colour histograms.

    A stream that can't be read gives one row with `error` and no frame.
    """
    kind = media.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, frame int, start_cs bigint, delay_cs int, disposal int, transparent int, columns int, rows int, rgba binary, red array<bigint>, green array<bigint>, blue array<bigint>, error string"

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for key, data in zip(pdf["doc_id"], pdf["media"]):
                clock, k = 0, 0
                try:
                    for k, f in enumerate(decode(bytes(data or b""))):
                        h = histogram(f)
                        yield pd.DataFrame([(key, k, clock, f.delay_cs, f.disposal, f.transparent, f.screen.shape[1], f.screen.shape[0], f.screen.tobytes(), h[:BINS], h[BINS : 2 * BINS], h[2 * BINS :], None)], columns=names)
                        clock += f.delay_cs
                except (ValueError, IndexError, struct.error) as e:
                    yield pd.DataFrame([(key, None, None, None, None, None, None, None, None, None, None, None, str(e))], columns=names)

    names = [x.split()[0] for x in schema.split(", ")]
    return media.select(F.col(id_col).alias("doc_id"), F.col(media_col).alias("media")).mapInPandas(run, schema)


def read_back(media: bytes) -> tuple:
    """What a stored form holds: its samples' length, hashes and the feature: frames, their time and the colour histogram."""
    parts, bins, clock = [], np.zeros(3 * BINS, np.int64), 0
    for f in decode(media):
        parts.append(f.own()[..., 0].tobytes())
        bins += histogram(f)
        clock += f.delay_cs
    back = b"".join(parts)
    feature = f"{len(parts)}x{clock}cs:" + ".".join(map(str, bins[:BINS]))
    return len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-WIDTH:]), len(media), hashlib.sha256(media).hexdigest(), feature


def media_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digest columns of every text's stored form: the media are written, and what is read of the written bytes is digested."""
    stored = durable(to_gif(docs, id_col, text_col))
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        for batch in batches:
            rows = [read_back(m.as_py()) for m in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], ["doc_id", "n_bytes", *names])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return stored.mapInArrow(run, schema)
