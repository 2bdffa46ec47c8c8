"""Vectorised views of Arrow text columns: words, normalised buffers and XXH64, without a Python string."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WS = np.zeros(256, bool)
WS[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: XXH64's fixed primes.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def text_slices(column: pa.Array, target: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past row, bytes, offsets) of runs of whole texts of about `target` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    offs = np.frombuffer(offs, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + target, "right")) - 1)
        b = min(b, n)
        yield a, b, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of a slice (or what other bytes than white space part): starts, ends, counts for each text, and text numbers."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, apart: np.ndarray = WS):
        n = len(buf)
        inside = ~apart[buf]
        edges = offs[1:-1]
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before[edges[edges < n]] = False
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after[edges[(edges > 0)] - 1] = False
        self.inside = inside
        self.first = inside & ~before
        self.starts = np.flatnonzero(self.first)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(offs, self.starts, "right") - 1
        self.counts = np.bincount(self.doc, minlength=len(offs) - 1)

    def joined(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, each followed by one space, in one buffer; their starts and lengths there."""
        lens = self.ends - self.starts
        starts = np.zeros(len(lens), np.int64)
        np.cumsum(lens[:-1] + 1, out=starts[1:])
        out = np.full(int(lens.sum() + len(lens)) + 8, 32, np.uint8)
        number = np.cumsum(self.first)[self.inside] - 1
        out[np.arange(len(number)) + number] = buf[self.inside]
        return out, starts, lens


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many ranges of a buffer at once; the buffer needs 8 bytes past its last range."""
    buf = np.ascontiguousarray(buf)
    wide = np.ndarray((max(0, len(buf) - 7),), "<u8", buffer=buf, strides=(1,))
    half = np.ndarray((max(0, len(buf) - 3),), "<u4", buffer=buf, strides=(1,))
    seed = np.uint64(seed)
    with np.errstate(over="ignore"):
        acc = np.full(len(starts), seed + P5, np.uint64)
        pos = starts.astype(np.int64).copy()
        rest = lens.astype(np.int64).copy()
        rows = np.flatnonzero(lens >= 32)
        if len(rows):
            lanes = [np.full(len(rows), v, np.uint64) for v in (seed + P1 + P2, seed + P2, seed, seed - P1)]
            live = np.arange(len(rows))
            while len(live):
                at = pos[rows[live]]
                for k, v in enumerate(lanes):
                    v[live] = _rotl(v[live] + wide[at + 8 * k] * P2, 31) * P1
                pos[rows[live]] += 32
                rest[rows[live]] -= 32
                live = live[rest[rows[live]] >= 32]
            h = _rotl(lanes[0], 1) + _rotl(lanes[1], 7) + _rotl(lanes[2], 12) + _rotl(lanes[3], 18)
            for v in lanes:
                h = (h ^ (_rotl(v * P2, 31) * P1)) * P1 + P4
            acc[rows] = h
        acc += lens.astype(np.uint64)
        for _ in range(3):
            s = np.flatnonzero(rest >= 8)
            if not len(s):
                break
            acc[s] = _rotl(acc[s] ^ (_rotl(wide[pos[s]] * P2, 31) * P1), 27) * P1 + P4
            pos[s] += 8
            rest[s] -= 8
        s = np.flatnonzero(rest >= 4)
        acc[s] = _rotl(acc[s] ^ (half[pos[s]].astype(np.uint64) * P1), 23) * P2 + P3
        pos[s] += 4
        rest[s] -= 4
        for _ in range(3):
            s = np.flatnonzero(rest > 0)
            if not len(s):
                break
            acc[s] = _rotl(acc[s] ^ (buf[pos[s]].astype(np.uint64) * P5), 11) * P1
            pos[s] += 1
            rest[s] -= 1
        acc ^= acc >> np.uint64(33)
        acc *= P2
        acc ^= acc >> np.uint64(29)
        acc *= P3
        acc ^= acc >> np.uint64(32)
    return acc
