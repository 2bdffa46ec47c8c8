"""Many fixed strings at once: an automaton for terms and short strings, anchors for longer ones.

An automaton over all strings goes once through a batch of texts, whatever their number.  The strings travel by broadcast, in blocks of
at most BLOCK_CHARS characters (a pass over the texts for each), and each worker builds its automaton once.  Word borders are
checked at the hits alone.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator, Sequence
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import materialise

#: Characters of the strings of one automaton, and of the texts that it goes through at once.
BLOCK_CHARS, SLICE_CHARS = 1 << 23, 1 << 20
#: Line breaks as `\\R` has them.
BREAKS = np.array([0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0x2028, 0x2029], np.uint32)


@cache
def _folds() -> np.ndarray:
    """Each character without case: lower of upper, one character for one."""
    out = np.arange(0x110000, dtype=np.uint32)
    for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))):
        upper = c.upper()
        if len(upper) != 1:
            upper = c.title() if len(c.title()) == 1 else c
        low = upper.lower()[0]
        if low != c:
            out[ord(c)] = ord(low)
    return out


@cache
def _word() -> np.ndarray:
    """Characters of words: letters, marks, decimal digits, connectors, joiners, and letters in circles or squares."""
    kinds = {"Lu", "Ll", "Lt", "Lm", "Lo", "Nl", "Mn", "Mc", "Me", "Nd", "Pc"}
    out = np.fromiter((unicodedata.category(chr(c)) in kinds for c in range(0x110000)), bool, 0x110000)
    for a, b in ((0x200C, 0x200D), (0x24B6, 0x24E9), (0x1F130, 0x1F149), (0x1F150, 0x1F169), (0x1F170, 0x1F189)):
        out[a : b + 1] = True
    return out


def fold(text: str) -> str:
    """Case removed, character by character, so that places stay."""
    if text.isascii():
        return text.lower()
    return _folds()[np.frombuffer(text.encode("utf-32-le"), np.uint32)].tobytes().decode("utf-32-le")


class Automaton:
    """All places of fixed strings in texts.  `whole[i]`: string i counts only between word borders."""

    def __init__(self, strings: Sequence[str], whole: Sequence[bool], blind: bool):
        self.blind, self.machine = blind, ahocorasick.Automaton()
        used: set[str] = set()
        groups: dict[tuple[str, bool], list[int]] = {}
        for i, s in enumerate(strings):
            s = fold(s) if blind else s
            used.update(s)
            groups.setdefault(s, []).append(i)
        self.apart = next(c for c in map(chr, range(0xE000, 0xF8FF)) if c not in used)
        self.sizes = np.array([len(s) for s in groups] or [0], np.int64)
        for k, s in enumerate(groups):
            self.machine.add_word(s, k)
        if groups:
            self.machine.make_automaton()
        self.counts = np.array([len(g) for g in groups.values()], np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.members = np.array([i for g in groups.values() for i in g], np.int64)
        self.whole = np.array(whole, bool)

    def find(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text numbers, string numbers, first places and line numbers (from 1) of all hits that lie within a line or hold no line break."""
        none = np.zeros(0, np.int64)
        if not len(self.members) or not texts:
            return none, none, none, none
        joined = self.apart + self.apart.join(texts) + self.apart
        hits = list(self.machine.iter(fold(joined) if self.blind else joined))
        if not hits:
            return none, none, none, none
        end, group = np.array(hits, np.int64).T
        start = end - self.sizes[group] + 1
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        edges = np.cumsum([1 + len(t) for t in texts])
        text = np.searchsorted(edges, start, "left")
        border = _word()[code[start - 1]] != _word()[code[start]]
        border &= _word()[code[end]] != _word()[code[end + 1]]
        # a string of its own for each that folds to this one
        n = self.counts[group]
        hit = np.repeat(np.arange(len(group)), n)
        member = self.members[np.repeat(self.first[group] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        ok = border[hit] | ~self.whole[member]
        hit, member = hit[ok], member[ok]
        breaks = np.flatnonzero(np.isin(code, BREAKS) & ~((code == 0x0A) & (np.append(0, code[:-1]) == 0x0D)))
        before = np.searchsorted(breaks, start[hit])
        at_text = np.searchsorted(breaks, np.append(0, edges[:-1])[text[hit]])
        return text[hit], member, start[hit] - np.append(0, edges[:-1])[text[hit]] - 1, before - at_text + 1


_BUILT: dict[str, Automaton] = {}


def _automaton(sent, blind: bool) -> Automaton:
    """A worker's automaton of a broadcast, built once."""
    names, whole, _, key = sent.value
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(names, whole, blind)
    return _BUILT[key]


def blocks(strings: DataFrame, most: int | None = None) -> Iterator[tuple[list[int], list[str], list[bool]]]:
    """The rows (number, string, whole) in blocks that fit an automaton (about `most` rows, if given); read block by block, so that no more are held at once."""
    rows = materialise(strings)
    seen = rows.agg(F.coalesce(F.sum(F.char_length("string")), F.lit(0)).alias("chars"), F.count(F.lit(1)).alias("n")).first()
    parts = max(1, -(-seen.chars // BLOCK_CHARS), -(-seen.n // most) if most else 1)
    for p in range(parts):
        t = rows.where(F.pmod(F.xxhash64("string"), F.lit(parts)) == p).toArrow()
        yield t.column("number").to_pylist(), t.column("string").to_pylist(), t.column("whole").to_pylist()


def occurrences(texts: DataFrame, text: str, strings: DataFrame, each: str = "place", blind: bool = False, most: int | None = None) -> DataFrame:
    """(row, number, place, line): the columns of `texts` but the text, in a struct, and the hits of numbered strings.

    strings: (number long, string, whole boolean).  each: a row for each "place" of a string, for each "line" that has it
    or for each "text".  A null text has no hits; an empty string none either.
    """
    out, carried = None, [c for c in texts.columns if c != text]
    spark = texts.sparkSession
    source = texts.select(F.struct(*[F.col(f"`{c}`") for c in carried], F.lit(0).alias("_none")).alias("row"), F.col(f"`{text}`").alias("_text"))
    schema = f"row {source.schema['row'].dataType.simpleString()}, number long, place long, line long"
    for numbers, names, whole in blocks(strings.where("string <> ''"), most):
        sent = spark.sparkContext.broadcast((names, whole, np.array(numbers, np.int64), uuid.uuid4().hex))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            machine = _automaton(sent, blind)
            for batch in batches:
                for a, b, part in slices(batch.column(1)):
                    row, member, place, line = machine.find(part)
                    if each != "place" and len(row):
                        key = np.stack([row, member, line if each == "line" else np.zeros_like(line)])
                        first = np.unique(key, axis=1, return_index=True)[1]
                        row, member, place, line = row[first], member[first], place[first], line[first]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).take(pa.array(row)), pa.array(sent.value[2][member]), pa.array(place), pa.array(line)], ["row", "number", "place", "line"])

        found = source.mapInArrow(run, schema)
        out = found if out is None else out.unionAll(found)
    return out


def slices(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """(first row, past row, texts) of about SLICE_CHARS characters; null is empty."""
    texts, a, size = [], 0, 0
    for i, t in enumerate(column.to_pylist()):
        texts.append(t or "")
        size += len(texts[-1])
        if size >= SLICE_CHARS:
            yield a, i + 1, texts
            texts, a, size = [], i + 1, 0
    if texts:
        yield a, a + len(texts), texts


# --- anchors: three words in a row, with what stands between them ---

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
WORDS = 3


def windows(texts: Sequence[bytes], inner: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text numbers, first bytes and hashes of all stretches of WORDS words; with `inner`, not of the text's first or last word.

    A hash is a polynomial over the bytes modulo 2^64; equal stretches have equal hashes, and others are told apart later.
    """
    none = np.zeros(0, np.int64)
    buf = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    inside = ~SPACE[buf]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(starts) < WORDS:
        return none, none, none
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    text = np.searchsorted(first, starts, "right") - 1
    k = np.arange(len(starts) - WORDS + 1)
    ok = text[k] == text[k + WORDS - 1]
    if inner:
        ok &= (k > 0) & (text[k - 1] == text[k]) & (k + WORDS < len(starts)) & (text[np.minimum(k + WORDS, len(starts) - 1)] == text[k])
    k = k[ok]
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(buf), _BASE, np.uint64))
        back = np.cumprod(np.full(len(buf) + 1, _INVERSE, np.uint64))
        sums = np.append(np.uint64(0), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power))
        h = (sums[ends[k + WORDS - 1]] - sums[starts[k]]) * back[starts[k]]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    return text[k], starts[k] - first[text[k]], h.view(np.int64)
