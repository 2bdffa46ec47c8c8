"""Best-fit packing: patterns fitted to the length histogram by non-negative least squares.

1. Texts become token ids (one end id each); those of over CAPACITY tokens are cut into pieces.
2. The histogram of piece lengths, at most CAPACITY numbers whatever the corpus, goes to the driver.
3. Patterns of at most `DEPTH` documents that fill a sequence are enumerated over `BINS` length
   classes, their repeat counts fitted by non-negative least squares and rounded down.  Where the fit leaves
   short pieces over, deeper patterns are added one by one, each the best for the residual, and fitted again.
4. The rest goes, longest first, to the fullest sequence that still takes it: by counts, so that
   many equal sequences are filled in one step.
5. The plan is a table of (length, first rank, count, first sequence, offset).  Pieces of a length
   are ranked in two levels, so a length that a third of all pieces have is no single task.

`pack_in_order` keeps the order of the rows, as a mix needs it: stretches of at most STRETCH tokens are each planned and
packed on their own, by the executors, and sequences are numbered along the rows.

Edge cases: null and empty texts are one piece of the end id; repeated rows are packed each; an
empty table gives an empty result; extra columns are ignored; texts of any length are tokenised
whole, a word at a time, as no token crosses white space.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import durable
from gaugeworks.llm.textbatch import LOWER, Words, text_slices

CAPACITY = 4096
END_ID = 1
#: Tokens that are packed together where the order counts, and the least that a piece is taken for: so a stretch has 65,536 pieces at most.
STRETCH, LEAST_TOKENS = 1 << 22, 64
BINS, DEPTH = 64, 4
#: Rounds in which patterns of any depth are added where the fit leaves most.
ROUNDS = 40
#: Units whose ids a worker keeps before it starts anew.
KEPT_UNITS = 600_000
#: Marks that end a word as a unit of their own: none of those in contractions or special tokens.
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,!?;:#$%&*"]] = True
_ALNUM = np.array([b < 128 and chr(b).isalnum() for b in range(256)])


class Encoder:
    """Token ids of whole texts, from ids of units: each distinct unit of a slice is looked up once.

    A unit is a word, or a word's stem and the marks after it: the tokenizer splits there too, if
    the stem ends with an ASCII letter or digit.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.encode("\x01", add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sizes, self.pool = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]

    def _learn(self, new: list[bytes]) -> None:
        """Ids of new units: all in one text, split again at a separator that no unit holds."""
        for a in range(0, len(new), 20_000):
            part = [w.decode() for w in new[a : a + 20_000]]
            ids = np.array(self.tokenizer.encode_batch_fast([" \x01 ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            cuts = np.flatnonzero(ids == self.separator[0]) if len(self.separator) == 1 else np.zeros(0, np.int64)
            if len(cuts) == len(part) - 1:
                size = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
                ids = np.delete(ids, cuts)
            else:
                each = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in part]
                size, ids = np.array([len(x) for x in each]), np.array(sum(each, []), np.uint32)
            first = len(self.known)
            self.known.update(zip(new[a : a + 20_000], range(first, first + len(part))))
            self.sizes.append(size)
            self.pool.append(ids)

    def _units(self, w: Words, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and text numbers of the units."""
        place = np.where(_MARK[buf], 0, np.arange(len(buf)))
        np.maximum.accumulate(place, out=place)
        stem = place[w.ends - 1]
        cut = (stem >= w.starts) & (stem < w.ends - 1) & _ALNUM[buf[stem]]
        starts = np.concatenate([w.starts, stem[cut] + 1])
        order = np.argsort(starts, kind="stable")
        return starts[order], np.concatenate([w.doc, w.doc[cut]])[order]

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice's texts in order, an end id after each, and how many each has."""
        w = Words(buf, offs)
        starts, doc = self._units(w, buf)
        data = LOWER[buf]
        if (angle := buf == 60).any():  # special tokens are matched before lower-casing
            spelt = np.unique(np.searchsorted(w.starts, np.flatnonzero(angle & w.inside), "right") - 1)
            for k in spelt.tolist():
                data[w.starts[k] : w.ends[k]] = buf[w.starts[k] : w.ends[k]]
        before = np.cumsum(w.inside)
        cuts = np.concatenate([before[starts] - 1, before[-1:]]) if len(starts) else np.zeros(1, np.int64)
        data = np.ascontiguousarray(data[w.inside])
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > KEPT_UNITS:
            self._forget()
        new = [x for x, k in zip(distinct, map(self.known.get, distinct)) if k is None]
        if (buf == 1).any():
            for x in [x for x in new if b"\x01" in x]:
                self._learn([x])
            new = [x for x in new if b"\x01" not in x]
        self._learn(new)
        self.sizes, self.pool = [np.concatenate(self.sizes)], [np.concatenate(self.pool)]
        size, pool = self.sizes[0], np.append(self.pool[0], np.uint32(END_ID))
        start = np.cumsum(size) - size
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
        # each text's units, then its end
        n = np.bincount(doc, minlength=len(offs) - 1) + 1
        ends = np.cumsum(n) - 1
        inner = np.ones(int(n.sum()), bool)
        inner[ends] = False
        at, k = np.full(len(inner), len(pool) - 1), np.ones(len(inner), np.int64)
        at[inner], k[inner] = start[number], size[number]
        past = np.cumsum(k)
        ids = pool[np.repeat(at - (past - k), k) + np.arange(int(k.sum()))]
        return ids, np.diff(past[ends], prepend=0)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, keep_ids: bool = False, carry: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), the `ids` themselves if asked for, and each row's values of `carry`."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[x.alias(c) for c, x in (carry or {}).items()])
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids + list(carry or {})

    def run(batches):
        e = encoder(path)
        for batch in batches:
            for a, b, buf, offs in text_slices(batch.column(1), 1 << 21):
                ids, n = e.encode(buf, offs)
                cut = np.maximum(1, -(-n // capacity))
                row = np.repeat(np.arange(len(n)), cut)
                piece = np.arange(int(cut.sum())) - np.repeat(np.cumsum(cut) - cut, cut)
                start = piece * capacity
                length = np.minimum(capacity, n[row] - start)
                at = (np.cumsum(n) - n)[row] + start
                raw = memoryview(np.ascontiguousarray(ids.astype("<u4")).view(np.uint8))
                crc = [zlib.crc32(raw[4 * x : 4 * (x + y)]) for x, y in zip(at.tolist(), length.tolist())]
                out = [batch.column(0).slice(a, b - a).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if keep_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(ids.astype(np.int32))))
                out += [batch.column(k).slice(a, b - a).take(pa.array(row)) for k in range(2, batch.num_columns)]
                yield pa.RecordBatch.from_arrays(out, names)

    schema = [kinds[0], "piece int, start bigint, length bigint, ids_crc32 bigint", *["ids array<int>"] * keep_ids, *kinds[1:]]
    return rows.mapInArrow(run, ", ".join(schema))


@cache
def patterns(full: int, depth: int) -> list[tuple[int, ...]]:
    """Descending class numbers, at most `depth`, that sum to `full` or one less."""
    out: list[tuple[int, ...]] = []

    def grow(left: int, most: int, chosen: tuple[int, ...]) -> None:
        if left <= 1 and chosen:
            out.append(chosen)
        if len(chosen) < depth:
            for k in range(min(left, most), 0, -1):
                if k * (depth - len(chosen)) < left - 1:
                    break
                grow(left - k, k, (*chosen, k))

    grow(full, full, ())
    return out


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least squares under x >= 0 by the active-set method."""
    x = np.zeros(a.shape[1])
    active: list[int] = []
    for _ in range(3 * a.shape[0] + 10):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        j = int(gradient.argmax())
        if gradient[j] <= 1e-9 * max(1.0, abs(b).max()):
            break
        active.append(j)
        while True:
            s = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            if (s > 1e-12).all():
                break
            low = s <= 1e-12
            held = x[active]
            ratio = np.min(held[low] / np.maximum(held[low] - s[low], 1e-300))
            x[active] = held + ratio * (s - held)
            gone = [i for i, k in enumerate(active) if x[k] <= 1e-12]
            if not gone:
                gone = [int(np.argmin(s))]
            for i in reversed(gone):
                x[active.pop(i)] = 0
            if not active:
                s = np.zeros(0)
                break
        x[:] = 0
        x[active] = s
    return x


def filling(price: np.ndarray, full: int) -> tuple[int, ...] | None:
    """The pattern of any depth that sums to `full` or one less and whose classes' prices sum to most; None if no sum above 0 is there."""
    best, last = np.full(full + 1, -np.inf), np.zeros(full + 1, np.int64)
    best[0] = 0.0
    classes = np.flatnonzero(np.isfinite(price)) + 1
    for v in range(1, full + 1):
        fits = classes[classes <= v]
        if len(fits):
            worth = best[v - fits] + price[fits - 1]
            i = int(worth.argmax())
            best[v], last[v] = worth[i], fits[i]
    v = max((full, full - 1), key=lambda v: best[v])
    if not best[v] > 0:
        return None
    out = []
    while v:
        out.append(int(last[v]))
        v -= out[-1]
    return tuple(sorted(out, reverse=True))


def fit_patterns(size: np.ndarray, full: int) -> list[tuple[tuple[int, ...], float]]:
    """Patterns and their fitted repeat counts for the number of pieces of each class.

    All patterns of at most DEPTH pieces are fitted; then, round by round, the one of any depth that the residual of the
    fit asks for most is added and all that are in use are fitted again, so that short pieces get patterns too.
    """
    columns = lambda known: np.array([np.bincount(np.array(p) - 1, minlength=len(size)) for p in known], float).reshape(-1, len(size)).T
    price = np.where(size > 0, 0.0, -np.inf)
    known = [p for p in patterns(full, DEPTH) if all(size[c - 1] for c in p)]
    counts = nnls(columns(known), size) if known else np.zeros(0)
    for _ in range(ROUNDS):
        known, counts = [p for p, c in zip(known, counts) if c > 0], counts[counts > 0]
        more = filling(price + (size - columns(known) @ counts), full)
        if more is None or more in known:
            break
        known.append(more)
        counts = nnls(columns(known), size)
    return [(p, float(c)) for p, c in zip(known, counts) if c > 0]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, shares: tuple[float, ...] = (1.0, 0.75, 0.5, 0.25, 0.0)) -> list[tuple[int, tuple]]:
    """(how many sequences, their lengths as nested pairs) for a histogram of lengths.

    Fitted counts are tried whole and in part: the more is left for best fit, the better its short
    pieces close the patterns' gaps; with none of them all is best fit.  The plan of fewest sequences counts.
    """
    width = -(-capacity // BINS)
    size = np.zeros(BINS)
    for k, n in histogram.items():
        size[-(-k // width) - 1] += n
    fitted = fit_patterns(size, capacity // width)
    return min((_plan(histogram, capacity, [(p, int(s * c + 1e-6)) for p, c in fitted]) for s in shares), key=lambda p: sum(n for n, _ in p))


def _plan(histogram: dict[int, int], capacity: int, fitted: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, tuple]]:
    left = {k: v for k, v in histogram.items() if v}
    width = -(-capacity // BINS)
    by_class: dict[int, list[int]] = {}
    for k in sorted(left, reverse=True):
        by_class.setdefault(-(-k // width), []).append(k)
    lengths_up = sorted(left)
    groups: list[tuple[int, int, tuple | None]] = []  # room, count, lengths
    for pattern, todo in sorted(fitted, reverse=True):
        while todo:
            taken: list[int] = []
            for c in pattern[:-1]:
                at = next((k for k in by_class[c] if left[k] > taken.count(k)), None)
                if at is None:
                    break
                taken.append(at)
            if len(taken) < len(pattern) - 1:
                break
            # the last one is the longest that still fits
            i = bisect_left(lengths_up, capacity - sum(taken) + 1) - 1
            while i >= 0 and left[lengths_up[i]] <= taken.count(lengths_up[i]):
                if not left[lengths_up[i]]:
                    lengths_up.pop(i)
                i -= 1
            if i < 0 or -(-lengths_up[i] // width) < pattern[-1] - 1:
                break
            taken.append(lengths_up[i])
            n = min([todo, *(left[k] // taken.count(k) for k in set(taken))])
            for k in taken:
                left[k] -= n
            todo -= n
            lengths = None
            for k in taken:
                lengths = (k, lengths)
            groups.append((capacity - sum(taken), n, lengths))
    # best fit, longest first, over groups of equal sequences
    open_: dict[int, list[tuple[int, tuple | None]]] = {}
    for room, n, lengths in groups:
        open_.setdefault(room, []).append((n, lengths))
    rooms = sorted(open_)

    def put(room: int, n: int, lengths: tuple) -> None:
        if room not in open_ or not open_[room]:
            open_[room] = []
            i = bisect_left(rooms, room)
            if i == len(rooms) or rooms[i] != room:
                insort(rooms, room)
        open_[room].append((n, lengths))

    for k in sorted(left, reverse=True):
        n = left[k]
        while n:
            i = bisect_left(rooms, k)
            if i == len(rooms):
                each = max(1, min(capacity // k, n))
                count = n // each
                lengths = None
                for _ in range(each):
                    lengths = (k, lengths)
                put(capacity - each * k, count, lengths)
                n -= each * count
                continue
            room = rooms[i]
            have, lengths = open_[room].pop()
            if not open_[room]:
                rooms.pop(i)
            fit = room // k
            full = min(have, n // fit)
            rest = n % fit if full < have else 0
            more = lengths
            for i in range(1, fit + 1):
                more = (k, more)
                if i == rest:
                    put(room - rest * k, 1, more)
            if full:
                put(room - fit * k, full, more)
            if have > full + (rest > 0):
                put(room, have - full - (rest > 0), lengths)
            n -= full * fit + rest
    return [(n, lengths) for room in sorted(open_) for n, lengths in open_[room] if n]


def slots(planned: list[tuple[int, tuple]]) -> dict[str, np.ndarray]:
    """The plan as sorted columns: pieces of `length` and rank `first` on go to sequence `sequence` on, at `offset`."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for n, lengths in planned:
        offset = 0
        while lengths is not None:
            k, lengths = lengths
            first = ranks.get(k, 0)
            rows.append((k, first, sequence, offset))
            ranks[k] = first + n
            offset += k
        sequence += n
    table = np.array(rows, np.int64).reshape(-1, 4)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return dict(zip(("length", "first", "sequence", "offset"), table.T))


def assigned(s: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces of these lengths and ranks, by the `slots` of a plan."""
    at = np.searchsorted(s["length"] << 44 | s["first"], length << 44 | rank, "right") - 1
    assert (at >= np.searchsorted(s["length"], length)).all()
    return s["sequence"][at] + rank - s["first"][at], s["offset"][at]


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (a frame with `length`, read from durable files)."""
    spark = cut.sparkSession
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    sent = spark.sparkContext.broadcast(slots(plan(histogram, capacity)))
    names = cut.columns
    kinds = {f.name: f.dataType.simpleString() for f in cut.schema}
    share = 8 * max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = cut.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(share)))
    parts = rows.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    ranked = rows.withColumn("_own", F.row_number().over(Window.partitionBy("length", "_part").orderBy("_row")) - 1)
    ranked = ranked.join(parts.select("length", "_part", before.alias("_before")), ["length", "_part"]).select(*names, (F.col("_before") + F.col("_own")).alias("_rank"))

    def run(batches):
        for batch in batches:
            found = assigned(sent.value, batch.column(names.index("length")).to_numpy(), batch.column(len(names)).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, found)], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", sequence_id bigint, offset bigint")


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all texts with their sequence and place."""
    return place(durable(pieces(docs, path, id_col, text_col, capacity)), capacity)


def read_places(docs: DataFrame) -> dict[str, Column]:
    """_file, _block, _row: what orders the rows of a frame.  Spark names no file in frames of several reads: these have their own order."""
    row = {"_row": F.monotonically_increasing_id()}
    named = {"_file": F.input_file_name(), "_block": F.input_file_block_start()}
    try:
        docs.select(*named.values())
    except AnalysisException:
        named = {"_file": F.lit(""), "_block": F.lit(-1).cast("long")}
    return named | row


def stretches(cut: DataFrame, stretch: int) -> DataFrame:
    """Adds `_begin`, the tokens before a piece in the order of the rows, and `_stretch`, that divided by `stretch`.

    cut: pieces with _file, _block, _row of their rows.  Rows are in order by the number in their file's name, the name, the
    place in the file; of rows that come from no file, by partition.  What one task has read is summed in order on its own, after the sums
    of all before it.
    """
    part = ["_file", "_block", "_task"]
    rows = cut.withColumns({"_task": F.shiftright("_row", 33), "_tokens": F.greatest("length", F.lit(LEAST_TOKENS))})
    ahead = lambda w: F.sum("_tokens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_tokens")
    number = F.regexp_extract("_file", "part-([0-9]+)[^/]*$", 1).try_cast("long")
    sums = rows.groupBy(*part).agg(F.sum("_tokens").alias("_tokens"))
    before = F.broadcast(sums.select(*part, ahead(Window.partitionBy(F.lit(0)).orderBy(number, *part)).alias("_before")))
    own = rows.withColumn("_own", ahead(Window.partitionBy(*part).orderBy("_row", "piece")))
    found = own.join(before, part).withColumn("_begin", F.col("_before") + F.col("_own"))
    return found.select(*[c for c in cut.columns if c not in ("_file", "_block", "_row")], "_begin", F.expr(f"_begin div {stretch}").alias("_stretch"))


def pack_in_order(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, stretch: int = STRETCH) -> DataFrame:
    """Pieces of all texts with their sequence and place; ascending sequence_id (with gaps) follows the rows.

    The sequences of a stretch hold its rows and no others; within it they are in the order of their first
    pieces, and of pieces of one length the earlier have the lower sequences of the plan.
    """
    carry = read_places(docs)
    cut = durable(pieces(docs, path, id_col, text_col, capacity, carry=carry))
    names = [c for c in cut.columns if c not in carry]
    kinds = {f.name: f.dataType.simpleString() for f in cut.schema}

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(np.argsort(rows["_begin"].to_numpy())))
        length = rows["length"].to_numpy()
        by = np.argsort(length, kind="stable")
        sizes, first, n = np.unique(length[by], return_index=True, return_counts=True)
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by)) - np.repeat(first, n)
        sequence, offset = assigned(slots(plan(dict(zip(sizes.tolist(), n.tolist())), capacity)), length, rank)
        begin = np.full(int(sequence.max()) + 1, len(by))
        np.minimum.at(begin, sequence, np.arange(len(by)))
        number = np.argsort(np.argsort(begin, kind="stable"))
        return rows.select(names).append_column("sequence_id", pa.array((rows["_stretch"].to_numpy() << 32) + number[sequence])).append_column("offset", pa.array(offset))

    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", sequence_id bigint, offset bigint"
    return stretches(cut, stretch).groupBy("_stretch").applyInArrow(run, schema)
