"""Line dedup by pairwise alignment.

1. Equal texts are one: the copy of the smallest id stays, later copies are common from end to end.
2. Hashes of shared lines name candidates, as pairs (later, first text that has them), so that pairs grow with the
   shared lines and not with their square.  Hashed are windows, the least runs of lines of MIN_BYTES, whatever
   their number of texts: every line of a common block lies in such a window of the block, so each block of
   an earlier text is met through the first holders of its windows.  Single lines count too, where they are rare
   (at most RARE texts have them) or the rarest that a text shares.
3. A pair's line hashes are aligned with patience diff: lines that are unique in both are put in
   order by a longest increasing sequence, equal neighbours join them, gaps are aligned again.
4. Aligned runs of MIN_BYTES or more are deleted from the later text.  So are its windows that the first text
   has too and the alignment left out, as where no line of a block is unique, blocks are swapped or a block comes
   twice: no window that names a pair is lost, and what they cover is the same as each common block of MIN_BYTES.

A deleted line stands in an earlier text; the first text that has it is never a later one for it,
so no line is lost.  Lines are compared without white space at their ends.

Edge cases: a null text stays null; empty texts are copies of each other and stay empty; rows of
one id and text are one document with one result; a null id comes after all others; two texts
under one id are ordered by their hash; extra columns stay whatever their names,
but for dedup_*, which are made anew; an empty table
gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import WS_CHARS, durable, field, whole_rows
from gaugeworks.llm.filters import mixed

RARE = 16
#: Bytes of the least block that is deleted: about twenty words.
MIN_BYTES = 120
_LAST = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, sorted by the first, that also increases in the second."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tails, j)
        back.append(at[p - 1] if p else -1)
        if p == len(tails):
            tails.append(j)
            at.append(k)
        else:
            tails[p], at[p] = j, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched positions of two line sequences by patience diff, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        once: dict[int, int] = {}
        for i in range(a0, a1):
            once[a[i]] = -1 if a[i] in once else i
        other: dict[int, int] = {}
        for j in range(b0, b1):
            other[b[j]] = -1 if b[j] in other else j
        anchors = _increasing(sorted((i, other[x]) for x, i in once.items() if i >= 0 and other.get(x, -1) >= 0))
        if not anchors:
            continue
        ends = [(a0, b0), *((i + 1, j + 1) for i, j in anchors)]
        starts = [*anchors, (a1, b1)]
        out += anchors
        todo += [(p, i, q, j) for (p, q), (i, j) in zip(ends, starts) if p < i and q < j]
    return sorted(out)


def blocks(pairs: list[tuple[int, int]], sizes: list[int], least: int) -> list[tuple[int, int]]:
    """Runs [from, past) of the first sequence that step with the second and have `least` bytes."""
    out = []
    k = 0
    while k < len(pairs):
        m = k
        while m + 1 < len(pairs) and pairs[m + 1] == (pairs[m][0] + 1, pairs[m][1] + 1):
            m += 1
        if sum(sizes[pairs[k][0] : pairs[m][0] + 1]) >= least:
            out.append((pairs[k][0], pairs[m][0] + 1))
        k = m + 1
    return out


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _lines(col: F.Column | str) -> F.Column:
    return F.split(col, "\n")


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(th, key, h, b): text hash, id as a number, line hashes and line sizes."""
    t = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("key"), F.col(text_col).alias("t")).where("t is not null")
    t = t.select("key", F.xxhash64("t").alias("th"), F.transform(_lines("t"), lambda x: F.btrim(x, F.lit(WS_CHARS))).alias("l"))
    return t.select("key", "th", F.transform("l", lambda x: F.xxhash64(x)).alias("h"), F.transform("l", lambda x: F.octet_length(x)).alias("b"))


def candidates(lines: DataFrame, rare: int = RARE, least: int = MIN_BYTES) -> DataFrame:
    """(later, first): pairs of text hashes to align."""
    own = lines.select("key", "th", F.explode(F.array_distinct(F.filter(F.arrays_zip("h", "b"), lambda x: x.b > 0))).alias("x")).select("key", "th", F.col("x.h").alias("h"), F.col("x.b").alias("b"))
    own = durable(own.groupBy("h", "th").agg(F.min("key").alias("key"), F.max("b").alias("b")))
    # written, so that the join can split the rows of a line that very many texts have
    shared = durable(own.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min(F.struct("key", "th")).alias("first")).where("df > 1"))
    both = own.join(shared, "h")
    both = both.where(F.struct("key", "th") > F.col("first"))
    # bytes in shared lines bound any block; each first text once, by its rarest line
    by_first = both.groupBy("th", F.col("first.th").alias("first")).agg(F.min("df").alias("df"), F.sum("b").alias("b"))
    text = by_first.groupBy("th").agg(F.min("df").alias("rarest"), F.sum("b").alias("all"))
    return by_first.join(text.where(F.col("all") >= least).drop("all"), "th").where(F.col("df") <= F.greatest(F.lit(rare), F.col("rarest"))).select(F.col("th").alias("later"), "first")


def window_hashes(h: np.ndarray, b: np.ndarray, offs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text numbers, hashes, first and last lines of the least runs of lines of `least` bytes that start or end at a line of each text."""
    n = len(h)
    text = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    past = np.cumsum(b)
    before = past - b
    start, end = np.arange(n), np.searchsorted(past, before + least, "left")
    first = np.searchsorted(before, past - least, "right") - 1
    start, end = np.concatenate([start, first]), np.concatenate([end, np.arange(n)])
    ok = (start >= 0) & (end < n)
    start, end = start[ok], end[ok]
    ok = text[start] == text[end]
    start, end = start[ok], end[ok]
    with np.errstate(over="ignore"):
        power = lambda x: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)]), dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h.view(np.uint64) * power(_BASE)[:n], dtype=np.uint64)])
        made = mixed((sums[end + 1] - sums[start]) * power(_BACK)[start], (end + 1 - start).astype(np.uint64))
    return text[start], made.view(np.int64), start - offs[text[start]], end - offs[text[start]]


def window_candidates(lines: DataFrame, least: int = MIN_BYTES) -> DataFrame:
    """(later, first): each text and the first text that has one of its windows."""

    def run(batches):
        for batch in batches:
            h, b = batch.column(2), batch.column(3)
            offs = h.offsets.to_numpy().astype(np.int64)
            text, made, _, _ = window_hashes(h.flatten().to_numpy(zero_copy_only=False), b.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offs - offs[0], least)
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(made)], ["key", "th", "w"])

    own = durable(lines.select("key", "th", "h", "b").mapInArrow(run, "key bigint, th bigint, w bigint").groupBy("w", "th").agg(F.min("key").alias("key")))
    shared = durable(own.groupBy("w").agg(F.count(F.lit(1)).alias("df"), F.min(F.struct("key", "th")).alias("first")).where("df > 1"))
    both = own.join(shared, "w").where(F.struct("key", "th") > F.col("first"))
    return both.select(F.col("th").alias("later"), F.col("first.th").alias("first")).distinct()


def shared_windows(later: tuple[pa.ListArray, pa.ListArray], first: tuple[pa.ListArray, pa.ListArray], least: int) -> list[list[tuple[int, int]]]:
    """Of each pair, the windows [from, past) of the later text that the first has too, joined where they touch."""

    def made(h: pa.ListArray, b: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        offs = h.offsets.to_numpy().astype(np.int64)
        pair, w, start, end = window_hashes(h.flatten().to_numpy(zero_copy_only=False), b.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offs - offs[0], least)
        return mixed(pair, w), pair, start, end

    own, pair, start, end = made(*later)
    hit = np.flatnonzero(np.isin(own, made(*first)[0]))
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(later[0]))]
    for k, x, y in zip(pair[hit].tolist(), start[hit].tolist(), end[hit].tolist()):
        spans[k].append((x, y + 1))
    return spans


def common_blocks(lines: DataFrame, pairs: DataFrame, least: int = MIN_BYTES) -> DataFrame:
    """(later, spans): line ranges of the later text to delete."""
    used = pairs.select(F.col("later").alias("th")).unionAll(pairs.select(F.col("first").alias("th"))).distinct()
    texts = durable(lines.select("th", "h", "b").join(used, "th", "left_semi").dropDuplicates(["th"]))
    later = texts.select(F.col("th").alias("later"), F.col("h").alias("lh"), F.col("b").alias("lb"))
    first = texts.select(F.col("th").alias("first"), F.col("h").alias("fh"), F.col("b").alias("fb"))

    def run(batches):
        for batch in batches:
            out = []
            seeds = shared_windows((batch.column(1), batch.column(2)), (batch.column(3), batch.column(4)), least)
            for lh, lb, fh, seen in zip(*(batch.column(k) for k in (1, 2, 3)), seeds):
                found = blocks(align(lh.as_py(), fh.as_py()), lb.as_py(), least)
                out.append([{"a": a, "z": z} for a, z in union(found + seen)])
            kind = pa.list_(pa.struct([("a", pa.int32()), ("z", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["later", "spans"])

    both = pairs.join(later, "later").join(first, "first").select("later", "lh", "lb", "fh", "fb")
    found = both.mapInArrow(run, "later bigint, spans array<struct<a:int,z:int>>").where(F.size("spans") > 0)
    return found.groupBy("later").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare: int = RARE, least: int = MIN_BYTES, windows: bool = True) -> DataFrame:
    """The input with the text that is left, and dedup_lines, dedup_removed, dedup_copy.

    Without `windows`, single lines alone name candidates: cheaper, but a passage may stay that more than `rare` texts
    share, or whose lines the first holders don't have together.
    """
    lines = durable(line_table(docs, id_col, text_col))
    pairs = candidates(lines, rare, least)
    if windows:
        pairs = pairs.unionAll(window_candidates(lines, least)).distinct()
    pairs = durable(pairs)
    spans = common_blocks(lines, pairs, least).withColumnRenamed("later", "_th").withColumnRenamed("spans", "_spans")
    firsts = lines.groupBy(F.col("th").alias("_th")).agg(F.min("key").alias("_first"))
    info = durable(firsts.join(spans, "_th", "left"))
    body = field(text_col)
    rows = whole_rows(docs).withColumns({"_th": F.xxhash64(body), "_key": F.coalesce(field(id_col).cast("long"), F.lit(_LAST))})
    rows = rows.join(info, "_th", "left").withColumn("_copy", F.coalesce((F.col("_key") > F.col("_first")) & (body != ""), F.lit(False)))
    rows = rows.withColumn("_lines", F.when(body.isNull(), F.array().cast("array<string>")).otherwise(_lines(body)))
    inside = lambda i: F.exists("_spans", lambda s: (s.a <= i) & (i < s.z))
    kept = F.when(F.col("_copy"), F.array().cast("array<string>")).when(F.col("_spans").isNull(), F.col("_lines")).otherwise(F.filter("_lines", lambda x, i: ~inside(i)))
    rows = rows.withColumn("_kept", kept)
    text = F.when(body.isNull() | (F.size("_kept") == F.size("_lines")), body).otherwise(F.array_join("_kept", "\n"))
    added = {
        "dedup_lines": F.size("_lines").cast("long"),
        "dedup_removed": (F.size("_lines") - F.size("_kept")).cast("long"),
        "dedup_copy": F.col("_copy"),
    }
    own = [text.alias(c) if c == text_col else field(c).alias(c) for c in docs.columns if c not in added]
    return rows.select(*own, *[x.alias(c) for c, x in added.items()])
