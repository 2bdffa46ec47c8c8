import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeworks.llm import gif
from tests.llm.cases import frame, rows


def pack(codes):
    """(code, width) pairs, least significant bit first."""
    bits, n = 0, 0
    for c, w in codes:
        bits |= c << n
        n += w
    return np.frombuffer(bits.to_bytes(-(-n // 8), "little"), np.uint8)


def compress(samples, minimum):
    """A plain LZW encoder that lets the table grow to 4096 entries."""
    clear, out = 1 << minimum, []
    table, width = {bytes([i]): i for i in range(clear)}, minimum + 1
    out.append((clear, width))
    size, word = clear + 2, b""
    for x in samples:
        longer = word + bytes([x])
        if longer in table:
            word = longer
            continue
        out.append((table[word], width))
        if size < 4096:
            table[longer] = size
            if size == 1 << width and width < 12:
                width += 1
            size += 1
        word = bytes([x])
    if word:
        out.append((table[word], width))
    if size == 1 << width and width < 12:
        width += 1
    out.append((clear + 1, width))
    return pack(out)


@pytest.mark.parametrize("minimum,n", [(2, 50), (8, 40), (8, 30_000), (4, 9_000)])
def test_lzw(minimum, n):
    rng = np.random.default_rng(n)
    samples = (rng.integers(0, 1 << minimum, n) * (rng.random(n) < 0.3)).astype(np.uint8)
    assert (gif.lzw(compress(samples.tobytes(), minimum), minimum) == samples).all()


@pytest.mark.parametrize("n", [64, 128, 64 * 1024, 64 * 1025, 64 * 5000])
def test_round_trip(n):
    samples = np.random.default_rng(n).integers(0, 256, n).astype(np.uint8)
    (media,) = gif.encode([samples.tobytes()])
    assert b"".join(f.own()[..., 1].tobytes() for f in gif.decode(media)) == samples.tobytes()


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=400), st.integers(0, 3))
def test_codes_are_those_of_a_plain_encoder(some, times):
    """Until the table is full the stream is that of an encoder that never clears."""
    data = some * (times + 1)
    assert gif.pack([gif.compress(data)])[0].tobytes() == compress(data, 8).tobytes()
    assert gif.lzw(gif.pack([gif.compress(data)])[0], 8).tobytes() == data


def test_full_tables_are_cleared_and_texts_shrink():
    rng = np.random.default_rng(7)
    text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"], 30_000)).encode()
    noise = rng.integers(0, 256, 60_000).astype(np.uint8).tobytes()
    for data in (text, noise, b"a" * 100_000):
        codes = gif.compress(data)
        assert gif.lzw(gif.pack([codes])[0], 8).tobytes() == data
    assert codes.count(256) == 1 and gif.compress(noise).count(256) > 10 and gif.compress(text).count(256) > 2
    raw = gif.payload(text)
    assert len(gif.encode([raw])[0]) < 0.4 * len(raw) and gif.encode([raw, b"\0" * 64, raw])[2] == gif.encode([raw])[0]


def test_screens_are_bounded():
    head = b"GIF89a" + struct.pack("<HHBBB", 65535, 65535, 0, 0, 0)
    with pytest.raises(ValueError, match="too large"):
        list(gif.decode(head + b"\x3b"))


def build(frames, columns=3, rows=2, palette=((0, 0, 0), (255, 0, 0), (0, 255, 0), (0, 0, 255))):
    out = b"GIF89a" + struct.pack("<HHBBB", columns, rows, 0x81, 0, 0) + bytes(sum(palette, ()))
    for left, top, w, h, disposal, transparent, delay, px, flags in frames:
        out += b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (transparent is not None), delay, transparent or 0) + b"\0"
        out += b"\x2c" + struct.pack("<HHHHB", left, top, w, h, flags) + b"\x02" + gif._blocks(compress(bytes(px), 2))
    return out + b"\x3b"


def shown(media):
    names = {(0, 0, 0, 0): ".", (0, 0, 0, 255): "0", (255, 0, 0, 255): "1", (0, 255, 0, 255): "2", (0, 0, 255, 255): "3"}
    return ["".join(names[tuple(int(v) for v in p)] for p in f.screen.reshape(-1, 4)) for f in gif.decode(media)]


def test_disposal_and_transparency():
    base = (0, 0, 3, 2, 1, None, 5, [1] * 6, 0)
    patch = lambda d: (1, 0, 2, 1, d, 0, 7, [2, 0], 0)
    end = (0, 1, 1, 1, 1, None, 9, [3], 0)
    assert shown(build([base, patch(1), end])) == ["111111", "121111", "121311"]
    assert shown(build([base, patch(2), end])) == ["111111", "121111", "1..311"]
    assert shown(build([base, patch(3), end])) == ["111111", "121111", "111311"]


def test_interlace():
    assert shown(build([(0, 0, 1, 5, 0, None, 0, [0, 3, 2, 1, 1], 0x40)], 1, 5)) == ["01213"]


def store(payload):
    """The stored form, made with the plain encoder: a table that is full is cleared."""
    out = b"GIF89a" + struct.pack("<HHBBB", 64, min(1024, len(payload) // 64), 0xF7, 0, 0) + bytes(v for i in range(256) for v in (i, i, i))
    for a in range(0, len(payload), 64 * 1024):
        part = payload[a : a + 64 * 1024]
        codes, table, word = [256], {bytes([i]): i for i in range(256)}, b""
        size = 258
        for x in part:
            longer = word + bytes([x])
            if longer in table:
                word = longer
                continue
            codes.append(table[word])
            if size < 4096:
                table[longer] = size
                size += 1
            else:
                codes.append(256)
                table, size = {bytes([i]): i for i in range(256)}, 258
            word = bytes([x])
        codes += [table[word], 257]
        wide, entries = [], 256
        for c in codes:
            wide.append((c, min(12, max(9, (entries + 1).bit_length()))))
            entries = 256 if c == 256 else entries + 1
        body = pack(wide).tobytes()
        blocks = b"".join(bytes([len(body[k : k + 255])]) + body[k : k + 255] for k in range(0, len(body), 255))
        out += b"\x21\xf9\x04" + struct.pack("<BHB", 1 << 2, 4, 0) + b"\0\x2c" + struct.pack("<HHHHB", 0, 0, 64, len(part) // 64, 0) + b"\x08" + blocks + b"\0"
    return out + b"\x3b"


def test_table(spark):
    data = rows()
    docs = frame(spark, data)
    got = sorted((tuple(r) for r in gif.media_digests(docs).collect()), key=str)
    want = []
    for r in data:
        p = gif.payload((r[1] or "").encode())
        assert len(p) % 64 == 0 and p
        media = store(p)
        shown = -(-len(p) // (64 * 1024))
        bins = np.bincount(np.frombuffer(p, np.uint8) >> 5, minlength=8)
        want.append((r[0], len((r[1] or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(media), hashlib.sha256(media).hexdigest(), f"{shown}x{4 * shown}cs:" + ".".join(map(str, bins))))
    assert got == sorted(want, key=str)
    media = gif.to_gif(docs)
    f = gif.frames(media).where("doc_id = 8").orderBy("frame").collect()
    assert [x.start_cs for x in f] == [4 * k for k in range(len(f))] and len(f) > 1 and sum(f[0].red) == 64 * 1024
    broken = gif.frames(media.selectExpr("doc_id", "substring(media, 1, 800) as media")).where("error is not null")
    assert broken.count() == len(data)
    assert gif.media_digests(frame(spark, [])).count() == 0
