"""Suffix-array dedup: repeated strings by threshold-bounded interval expansion.

A byte goes if a string of `length` bytes that covers it also starts earlier: in a document of
smaller id, or earlier in the same one.

Distribution.  Each window of `length` bytes has an anchor, the K-byte string in it of the least
hash (the first of these); equal windows have equal anchors at equal places.  A run of windows with
one anchor is a fragment; the anchor's hash is its bucket, so all occurrences of a window meet in one
bucket.  Anchors are counted first; fragments are made only of those that may repeat, as told by
a Bloom filter of fixed size (a false yes costs work, never a result).  Buckets of very many
fragments are dealt out by the core of every eight windows, which equal windows share too.

Equal fragments are merged to their first occurrence; its bytes are fetched only where a bucket
has several.  Those are put into one text; its suffixes are sorted, and the interval expansion goes breadth first over backward
extensions in the Burrows-Wheeler transform: level by level it finds the places where neighbouring
suffixes share exactly that many bytes, and stops at `length`.  Neighbours without such a place
share at least `length` bytes; the earliest of each such interval stays, the others go.

Edge cases: a null text is empty; texts shorter than `length` stay whole; rows that share an id
count as one document, by the smallest start, and equal rows get equal results; a null id comes
after all others; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import durable
from gaugeworks.llm.filters import filter_of, held, mixed
from gaugeworks.llm.textbatch import text_slices, xxh64

LENGTH = 100
#: Bytes of an anchor: long enough that chance repeats of it stay rare as the corpus grows.
K = 48
#: Bytes of a text whose suffixes are sorted at once.
CHUNK = 1 << 20
#: An anchor is hot if it has this many occurrences and this share of all.
HOT, HOT_SHARE = 20_000, 1 / (1 << 16)
CORE = 8
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PLACE = np.uint64(32)
_POWERS: dict[str, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    held = _POWERS.get(str(base))
    if held is None or len(held) < n:
        held = np.ones(max(n, 1 << 16), np.uint64)
        with np.errstate(over="ignore"):
            held[1:] = np.uint64(base)
            np.multiply.accumulate(held, out=held)
        _POWERS[str(base)] = held
    return held[:n]


def anchors(buf: np.ndarray, offs: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (text number, first start in the slice, windows, anchor place, anchor hash)."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.astype(np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
        h = (sums[K:] - sums[:-K]) * _powers(_INVERSE, n - K + 1)
        h ^= h >> np.uint64(30)
        h *= _M1
        h ^= h >> np.uint64(27)
        h *= _M2
        h ^= h >> np.uint64(31)
    least = (h >> _PLACE << _PLACE) | np.arange(len(h), dtype=np.uint64)
    w, have = length - K + 1, 1
    while have < w:
        step = min(have, w - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(n + 1, np.int64)
    np.add.at(inside, offs[:-1], 1)
    doc = np.cumsum(inside[:-1])[: len(place)] - 1
    good = np.arange(len(place)) + length <= offs[doc + 1]
    new = good.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~good[:-1] | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    total = np.concatenate([[0], np.cumsum(good)])
    windows = total[np.append(first[1:], len(place))] - total[first]
    return doc[first], first, windows, place[first], h[place[first]]


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def fragments(buf: np.ndarray, offs: np.ndarray, keep, hot: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text number, start in the slice, windows, bucket, hash) of the fragments whose anchors `keep` accepts."""
    doc, start, windows, place, anchor = anchors(buf, offs, length)
    ok = keep(anchor)
    doc, start, windows, place, anchor = doc[ok], start[ok], windows[ok], place[ok], anchor[ok]
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    if len(hot) and len(anchor):
        at = np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)
        many = hot[at] == anchor
        if many.any():
            # blocks of CORE windows, counted by their distance to the anchor
            reach = (place - start)[many]
            high, low = reach // CORE, (reach - windows[many] + 1) // CORE
            count = high - low + 1
            block = _ragged(low, count)
            row = np.repeat(np.flatnonzero(many), count)
            begin = np.maximum(start[row], place[row] - (block * CORE + CORE - 1))
            end = np.minimum(start[row] + windows[row], place[row] - block * CORE + 1)
            core = place[row] - block * CORE
            key = xxh64(padded, core, np.full(len(core), length - CORE + 1), 7) ^ (block.astype(np.uint64) * _M1) ^ anchor[row]
            rest = ~many
            doc, start, windows, anchor = (np.concatenate([x[rest], y]) for x, y in ((doc, doc[row]), (start, begin), (windows, end - begin), (anchor, key)))
    return doc, start, windows, anchor, xxh64(padded, start, windows + length - 1, 3)


def suffixes(text: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all positions by what follows up to their `end` (then by place), and its inverse."""
    n = len(text)
    here = np.arange(n)
    rank = np.zeros(n, np.uint64)
    for k in range(7):  # seven bytes, each one up, so that an end sorts first
        at = here + k
        rank = (rank << np.uint64(9)) | np.where(at < end, text[np.minimum(at, n - 1)].astype(np.uint64) + np.uint64(1), np.uint64(0))
    _, rank = np.unique(rank, return_inverse=True)
    rank = rank.astype(np.uint64) + np.uint64(1)
    have, longest = 7, int((end - here).max(initial=0))
    while have < longest:
        at = here + have
        key = rank << np.uint64(32) | np.where(at < end, rank[np.minimum(at, n - 1)], np.uint64(0))
        order = np.argsort(key)
        key = key[order]
        new = np.ones(n, np.uint64)
        new[1:] = key[1:] != key[:-1]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new)
        if rank.max(initial=0) == n:
            break
        have *= 2
    order = np.argsort(rank << np.uint64(32) | here.astype(np.uint64))
    inverse = np.empty(n, np.int64)
    inverse[order] = here
    return order, inverse


def shared_prefixes(text: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order, and for each of its places the bytes shared with the one before, or `length` for that or more (or all, where two are equal).

    begin / end: of the string that a position is in; the position `end` itself stands for the
    empty suffix and is part of the text.
    """
    n = len(text)
    order, inverse = suffixes(text, end)
    here = order
    extends = here > begin[here]
    left = np.where(extends, here - 1, 0)
    bwt = np.where(extends, text[left].astype(np.int64), 256)
    step = np.where(extends, inverse[left], -1)
    by = np.argsort(bwt, kind="stable")
    before, after = np.full(n, -1), np.full(n, n)
    near = bwt[by][1:] == bwt[by][:-1]
    before[by[1:][near]] = by[:-1][near]
    after[by[:-1][near]] = by[1:][near]
    shared = np.full(n + 1, length, np.int64)
    # level 0: one interval for each first byte, and one for the empty suffixes
    first = np.where(here < end[here], text[here].astype(np.int64), -1)
    cuts = np.flatnonzero(np.diff(first)) + 1
    low = np.concatenate([[0], cuts])
    high = np.concatenate([cuts, [n]])
    shared[low] = 0
    shared[n] = 0
    for level in range(1, length):
        size = high - low
        at = _ragged(low, size)
        lows, highs = np.repeat(low, size), np.repeat(high, size)
        ok = bwt[at] < 256
        at, lows, highs = at[ok], lows[ok], highs[ok]
        low = np.sort(step[at[before[at] < lows]])
        high = np.sort(step[at[after[at] >= highs]]) + 1
        fresh = shared[high] == length
        low, high = low[fresh], high[fresh]
        shared[high] = level
        if not len(low):
            break
    return order, shared[:n]


def earlier(pieces: list[np.ndarray], ids: np.ndarray, starts: np.ndarray, length: int) -> list[np.ndarray]:
    """For distinct strings with the (id, start) of their first occurrence: which of their windows start earlier elsewhere."""
    sizes = np.array([len(p) for p in pieces]) + 1
    past = np.cumsum(sizes)
    first = past - sizes
    text = np.concatenate([x for p in pieces for x in (p, np.zeros(1, np.uint8))])
    owner = np.repeat(np.arange(len(pieces)), sizes)
    begin, end = first[owner], past[owner] - 1
    order, shared = shared_prefixes(text, begin, end, length)
    group = np.cumsum(shared < length)
    window = order + length <= end[order]
    order, group = order[window], group[window]
    own, offset = owner[order], order - first[owner[order]]
    by = np.lexsort((starts[own] + offset, ids[own]))
    i, s = ids[own][by], (starts[own] + offset)[by]
    new = np.ones(len(by), np.int64)
    new[1:] = (i[1:] != i[:-1]) | (s[1:] != s[:-1])
    when = np.empty(len(by), np.int64)
    when[by] = np.cumsum(new)
    cut = np.flatnonzero(np.diff(group, prepend=-1))
    least = np.repeat(np.minimum.reduceat(when, cut), np.diff(np.append(cut, len(group)))) if len(cut) else when
    gone = np.zeros(len(text), bool)
    gone[order] = when > least
    return [gone[a : b - length] for a, b in zip(first, past)]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def _release(spark) -> None:
    """Lets Spark delete the shuffle files of finished steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def repeated_anchors(docs: DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Filter of the anchors that occur twice or more, and the sorted hot ones."""

    def run(batches):
        kept, size = [], 0
        for batch in batches:
            for _, _, buf, offs in text_slices(batch.column(0)):
                kept.append(anchors(buf, offs, length)[4])
                size += len(kept[-1])
                if size > 1 << 19:
                    yield out(kept)
                    kept, size = [], 0
        if kept:
            yield out(kept)

    def out(kept):
        keys, n = np.unique(np.concatenate(kept), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["anchor", "n"])

    counts = durable(docs.select("text").mapInArrow(run, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1"))
    total = counts.agg(F.sum("n").alias("n")).first().n or 0
    hot = counts.where(F.col("n") > max(HOT, int(total * HOT_SHARE))).select("anchor").toArrow().column("anchor").to_numpy()
    return filter_of(counts.select("anchor")), np.sort(hot.view(np.uint64))


def spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_key, text_hash, begins, pasts): byte ranges to remove, not yet joined.  docs: doc_key, text_hash, text."""
    spark = docs.sparkSession
    texts = docs.select("doc_key", "text_hash", "text")
    sent = spark.sparkContext.broadcast(repeated_anchors(docs, length))
    _release(spark)

    def cut(batches):
        """Fragments of each slice: ids, text hashes, starts in the text, windows, buckets, codes, the slice and starts there."""
        bits, hot = sent.value
        for batch in batches:
            keys, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, _, buf, offs in text_slices(batch.column(2)):
                doc, start, windows, bucket, code = fragments(buf, offs, lambda x: held(bits, x), hot, length)
                yield keys[a + doc], hashes[a + doc], start - offs[doc], windows, bucket, code, buf, start

    def all_of(batches):
        """All fragments; the first of each kind in a slice counts them all, the others none."""
        for key, text, local, windows, bucket, code, _, _ in cut(batches):
            order = np.lexsort((local, key, code, bucket))
            b, c = bucket[order], code[order]
            new = np.ones(len(order), bool)
            new[1:] = (b[1:] != b[:-1]) | (c[1:] != c[:-1])
            at = np.flatnonzero(new)
            times = np.zeros(len(order), np.int32)
            times[order[at]] = np.diff(np.append(at, len(order)))
            yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(code.view(np.int64)), pa.array(key), pa.array(text), pa.array(local << 12 | windows), pa.array(times)], ["bucket", "code", "doc_key", "text_hash", "place", "times"])

    # written once; read for the first occurrences and again for the verdicts
    seen = durable(texts.mapInArrow(all_of, "bucket bigint, code bigint, doc_key bigint, text_hash bigint, place bigint, times int"))
    distinct = seen.where("times > 0").groupBy("bucket", "code").agg(F.min(F.struct("doc_key", F.shiftright("place", 12).alias("start"))).alias("first"), F.sum("times").alias("times"))
    distinct = durable(distinct.select("bucket", "code", F.col("first.doc_key").alias("first_key"), F.col("first.start").alias("first_start"), "times"))
    _release(spark)
    several = distinct.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    wanted = spark.sparkContext.broadcast(filter_of(distinct.join(several, "bucket", "left_semi").select(F.xxhash64("bucket", "code", "first_key", "first_start").alias("x"))))

    def bytes_of(batches):
        """First occurrences of the fragments that have others in their bucket, with their bytes."""
        for key, _, local, windows, bucket, code, buf, start in cut(batches):
            ok = held(wanted.value, mixed(bucket, code, key, local))
            size = windows[ok] + length - 1
            raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(buf[_ragged(start[ok], size)]))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(bucket[ok].view(np.int64)), pa.array(code[ok].view(np.int64)), pa.array(key[ok]), pa.array(local[ok]), raw], ["bucket", "code", "doc_key", "start", "raw"])

    def judge(batches):
        """Rows sorted by bucket, code and place; whole buckets are gathered to texts of about CHUNK bytes."""
        pending: list[tuple] = []
        bucket: list[tuple] = []
        size = 0

        def flush():
            flags = earlier([np.frombuffer(r[4], np.uint8) for r in pending], np.array([r[2] for r in pending]), np.array([r[3] for r in pending]), length) if pending else []
            out = [(*r[:2], *(x.tolist() for x in _runs(f))) for r, f in zip(pending, flags) if f.any()]
            cols = list(zip(*out)) if out else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))], ["bucket", "code", "begin", "past"])

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if bucket and row[0] != bucket[-1][0]:
                    if len(bucket) > 1:
                        pending += bucket
                        size += sum(len(r[4]) for r in bucket)
                    bucket = []
                    if size > CHUNK:
                        yield flush()
                        pending, size = [], 0
                if not bucket or row[1] != bucket[-1][1]:
                    bucket.append(row)
        if len(bucket) > 1:
            pending += bucket
        if pending:
            yield flush()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = texts.mapInArrow(bytes_of, "bucket bigint, code bigint, doc_key bigint, start bigint, raw binary").repartition(n, "bucket").sortWithinPartitions("bucket", "code", "doc_key", "start")
    judged = durable(parts.mapInArrow(judge, "bucket bigint, code bigint, begin array<int>, past array<int>"))
    _release(spark)
    # written, so that the join can split the rows of a fragment that very many texts have
    verdicts = durable(distinct.join(judged, ["bucket", "code"], "left").where("times > 1 or begin is not null").select("bucket", "code", "first_key", "first_start", "begin", "past"))
    both = seen.drop("times").join(verdicts, ["bucket", "code"])
    start, windows = F.shiftright("place", 12), F.col("place").bitwiseAND(F.lit(0xFFF)).cast("int")
    own = (F.col("doc_key") == F.col("first_key")) & (start == F.col("first_start"))
    runs = F.when(own, F.arrays_zip("begin", "past")).otherwise(F.array(F.struct(F.lit(0).alias("begin"), windows.alias("past"))))
    found = both.select("doc_key", "text_hash", start.alias("start"), F.explode(runs).alias("r")).select("doc_key", "text_hash", (F.col("start") + F.col("r.begin")).alias("begin"), (F.col("start") + F.col("r.past") + (length - 1)).alias("past"))
    found = durable(found.groupBy("doc_key", "text_hash").agg(F.collect_list("begin").alias("begins"), F.collect_list("past").alias("pasts")))
    _release(spark)
    return found


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("doc_key"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), and the `kept` bytes if asked for."""
    rows = keyed(docs, id_col, text_col)
    both = rows.join(spans(rows, length), ["doc_key", "text_hash"], "left").select("doc_id", "text", "begins", "pasts")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for t, b, p in zip(*(batch.column(k) for k in (1, 2, 3))):
                raw = t.as_buffer()
                n = raw.size
                if not b.is_valid:
                    out.append((n, 0, 0, hashlib.sha256(raw).hexdigest(), raw.to_pybytes() if keep_bytes else None))
                    continue
                depth = np.zeros(n + 1, np.int64)
                np.add.at(depth, b.values.to_numpy(), 1)
                np.add.at(depth, p.values.to_numpy(), -1)
                gone = np.cumsum(depth[:n]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((n, int(gone.sum()), len(_runs(gone)[0]), hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 4 + keep_bytes]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 4 + keep_bytes]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in out], t) for k, t in enumerate(kinds))], ["doc_id", *names])

    return both.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * keep_bytes)
