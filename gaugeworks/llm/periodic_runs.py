"""Periodic runs of words, found by harmonic grid probing.

A run is a stretch of words with smallest period q (words q apart are the same) and a length of at least
max(6, 4 q) that no neighbouring word extends.  For each period p the words at jp and (j + 1)p are compared,
so all periods of n words take n (1 + 1/2 + 1/3 + ...) tests.  A run of period p holds four grid points in a row, so
three tests in a row must succeed; a few more tests between the points turn nearly all chance survivors away.
What is left is extended to both sides by comparing arrays in chunks of growing size.

Periods go upwards.  Grid points whose four words lie within a run already found are skipped: such an
overlap is longer than the sum of both periods, so it has their greatest common divisor as a period, and
what would be found is that run again.  For the same reason a stretch with a smaller period has been found as the very same stretch.

Texts of a slice are probed together, parted by words of their own, so that short documents cost no loop each;
a run never crosses documents.  Words are told apart exactly (a dictionary of each slice).

Edge cases: a null or wordless text has no run and an empty collapsed text; texts of any length are read whole; ties and repeated
rows are each their own; an empty table gives an empty result; `runs` and `collapsed` are made anew, all other columns stay whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import WS_CLASS
from gaugeworks.llm.textbatch import Words, text_slices

#: Length of a run at least, and in periods at least.
LEAST, PERIODS = 6, 4
#: Words compared at once while a survivor is extended: first and at most.
CHUNK, LARGEST = 64, 1 << 16


def _past(x: np.ndarray, i: int, p: int) -> int:
    """The first j >= i with x[j] != x[j + p]."""
    size, end = CHUNK, len(x) - p
    while i < end:
        n = min(size, end - i)
        differ = x[i : i + n] != x[i + p : i + p + n]
        k = int(differ.argmax())
        if differ[k]:
            return i + k
        i, size = i + n, min(2 * size, LARGEST)
    return end


def _before(x: np.ndarray, i: int, p: int) -> int:
    """The least j <= i such that x[k] == x[k + p] for all k from j to i - 1."""
    size = CHUNK
    while i > 0:
        n = min(size, i)
        differ = (x[i - n : i] != x[i - n + p : i + p])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            return i - k
        i, size = i - n, min(2 * size, LARGEST)
    return 0


def find_runs(x: np.ndarray, longest: int) -> np.ndarray:
    """(start, past, period) of every run, by start and period.  `x` numbers the words; `longest` bounds what a run may span."""
    found: dict[tuple[int, int], int] = {}
    reach = np.zeros(len(x), np.int64)  # the largest end of a run that holds the word
    for p in range(1, longest // PERIODS + 1):
        grid = x[::p]
        same = grid[1:] == grid[:-1]
        at = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * p
        if not len(at):
            continue
        at = at[reach[at] <= at + 3 * p]
        for d in {1, p // 3, p // 2, p - 1} - {0, p}:
            at = at[(x[at + d] == x[at + d + p]) & (x[at + d + p] == x[at + d + 2 * p])]
        past = 0
        for a in at.tolist():
            if a + 3 * p < past:
                continue
            start, past = _before(x, a, p), _past(x, a, p) + p
            if past - start >= max(LEAST, PERIODS * p) and (start, past) not in found:
                found[start, past] = p
                reach[start:past] = np.maximum(reach[start:past], past)
    return np.array(sorted((s, e, p) for (s, e), p in found.items()), np.int64).reshape(-1, 3)


def _slice_runs(buf: np.ndarray, offs: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each text of a slice."""
    words, rows = Words(buf, offs), len(offs) - 1
    joined, starts, lens = words.joined(buf)
    total = len(starts)
    edges = np.append(starts, starts[-1] + lens[-1] + 1 if total else 0)
    # one word of its own, a negative number, stands after each text
    spaced = pa.StringArray.from_buffers(total, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(joined))
    number = spaced.dictionary_encode().indices.to_numpy()
    x = np.empty(total + rows, np.int32)
    place = np.arange(total) + words.doc
    x[place] = number
    past = np.cumsum(words.counts)
    x[past + np.arange(rows)] = -1 - np.arange(rows)
    runs = find_runs(x, int(words.counts.max(initial=0)))
    doc = np.searchsorted(past + np.arange(rows), runs[:, 0], "right")
    first = past - words.counts + np.arange(rows)
    cells = [pa.array(c) for c in (runs[:, 0] - first[doc], runs[:, 1] - runs[:, 0], runs[:, 2])]
    ends = np.searchsorted(doc, np.arange(rows + 1)).astype(np.int32)
    listed = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(cells, ["start", "length", "period"]))

    steps = np.zeros(len(x) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 1], -1)
    kept = np.flatnonzero((np.cumsum(steps)[:-1] == 0)[place])
    size = lens[kept] + 1
    keep = np.zeros(len(joined), bool)
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    keep[np.repeat(starts[kept], size) + step] = True
    left = np.bincount(words.doc[kept], minlength=rows)
    last = kept[np.cumsum(left)[left > 0] - 1]
    keep[starts[last] + lens[last]] = False  # the space after a text's last word
    length = np.bincount(words.doc[kept], weights=size, minlength=rows).astype(np.int64) - (left > 0)
    bounds = np.append(0, np.cumsum(length))
    return listed, pa.LargeStringArray.from_buffers(rows, pa.py_buffer(bounds), pa.py_buffer(joined[keep])).cast(pa.string())


def periodic_runs(docs: DataFrame, text: str = "text", carried: Sequence[str] | None = None) -> DataFrame:
    """The columns `carried` (all, if None), `runs` (start and period order, in words) and `collapsed`: the words that no run repeats, joined by spaces."""
    names = [c for c in (docs.columns if carried is None else carried) if c not in ("runs", "collapsed")]
    rows = F.struct(*[F.col(f"`{c}`") for c in names], F.lit(0).alias("_runs_none"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offs in text_slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *_slice_runs(buf, offs)], ["_all", "runs", "collapsed"])

    source = docs.select(rows.alias("_all"), F.col(f"`{text}`").cast("string").alias("_text"))
    found = source.mapInArrow(run, f"_all {source.schema['_all'].dataType.simpleString()}, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.select(*[F.col("_all")[c].alias(c) for c in names], "runs", "collapsed")


def digests(found: DataFrame, *names: str) -> DataFrame:
    """`names`, the number of runs, the longest (ties: least start, then period) and hashes of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))), "")
    length, period = F.col("_best.length"), -F.col("_best.period")
    rows = found.withColumn("_best", F.when(F.size("runs") > 0, best))
    return rows.select(
        *names,
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame, h: Column, text: str = "text") -> DataFrame:
    """Texts of which one in ten (h % 10 = 0) repeats the words from one place on with some period; other texts as they are.

    With g = floor(h / 10) and n words, words from a = g % n on repeat with period 1 + floor((n - a) / (3 + g % 8)).
    """
    chosen = docs.withColumn("_g", F.when(h % 10 == 0, F.floor(h / 10)))
    split = F.filter(F.split(F.coalesce(text, F.lit("")), f"{WS_CLASS}+"), lambda w: w != "")
    cut = chosen.withColumn("_w", F.when(F.col("_g").isNotNull(), split)).withColumn("_n", F.size("_w"))
    cut = cut.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    rest = F.col("_n") - F.col("_a")
    cut = cut.withColumn("_p", (1 + F.floor(rest / (3 + F.col("_g") % 8))).cast("int"))
    unit = F.slice("_w", F.col("_a") + 1, F.col("_p"))
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("_p")).cast("int"))), F.lit(1), rest)
    whole = F.array_join(F.concat(F.slice("_w", F.lit(1), F.col("_a")), tail), " ")
    return cut.withColumn(text, F.when(F.col("_a").isNotNull(), whole).otherwise(F.col(text))).drop("_g", "_w", "_n", "_a", "_p")
