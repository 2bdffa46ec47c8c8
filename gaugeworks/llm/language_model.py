"""LM scoring: a hashed maximum-entropy model with a softmax factored twice by classes.

P(word | history) = P(class | history) * P(group | class, history) * P(word | class, group).  The class
of a word is a hash of its ending and its group a hash of the word, so every word has both, seen or not.
The first two factors are softmaxes over hashed features of the history: the word before, a skip
feature, the word before that, and, in the first, the pair of classes before; in the second each goes with the
class.  The last factor is the group's unigram with one added for each type and for the unseen: CLASSES * GROUPS groups tell most
of the common words apart.  There are more feature rows the more distinct words were learned (`Shape.of`).

Counts cover all training rows.  Weights come from distributed gradient updates: in each round,
each worker runs adaptive gradient steps over its share of the training rows from the shared
weights, and its changes are averaged, each row by how often it was used.  The biases start at the
log-counts.  Over all rounds each training row is used once.  Rows are dealt to workers, and ordered, by a
hash of id and text, and the workers' number follows from the number of tokens: scores don't depend on the
cluster, but for the order in which changes are summed (double precision, then rounded to single).

Scoring is one pass of sparse numpy batches.  Counts of the `FREQUENT` commonest words travel with
the tasks (a fixed size); the others are joined, by key, as (text, word, count) rows.

Edge cases: a null text is empty and has only its end token; without training rows each known
count is zero and the classes are equally likely; repeated rows are scored each, and learned from by one
worker; a null id is never learned from; extra columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import durable
from gaugeworks.llm.textbatch import LOWER, Words, text_slices, xxh64

CLASSES = GROUPS = 32
FREQUENT = 1 << 18
ROUNDS, BATCH, RATE = 2, 32_768, 0.12
BLOCK = 128
#: Tokens that a worker of a gradient round learns from, for each time the least number of feature rows, until there are `WORKERS` of them.
SHARE, WORKERS = 1 << 21, 4096
#: Distinct words that a task counts before it hands them on.
HELD = 1 << 20
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
END = xxh64(np.zeros(8, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64), 42)[0]
_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD))


class Shape(NamedTuple):
    """Feature rows of the class softmax (word before, word before that, classes before; one bias), then of the group softmax (the first two by class; a bias for each class)."""

    first: tuple[int, ...] = (4096, 2048, 2048)
    second: tuple[int, ...] = (8192, 4096)
    times: int = 1

    @staticmethod
    def of(types: int) -> Shape:
        """Rows grow with the root of the distinct words: twice as many for four times the words beyond 2**22, up to 16 times (40 MB of weights)."""
        times = 1
        while times < 16 and types > (times * times) << 22:
            times *= 2
        first, second, _ = Shape()
        return Shape(tuple(x * times for x in first), tuple(x * times for x in second), times)

    @property
    def bias(self) -> tuple[int, int]:
        return sum(self.first), sum(self.first) + 1 + sum(self.second)

    @property
    def rows(self) -> int:
        return self.bias[1] + CLASSES


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and leaf (class * GROUPS + group) of every token (each text's words, then its end), and tokens of each text."""
    w = Words(buf, offs)
    joined, starts, lens = w.joined(buf)
    joined = LOWER[joined]
    word = xxh64(joined, starts, lens, 42)
    last = starts + lens - 1
    marks = np.zeros(len(word), np.int64)
    for _ in range(2):
        strip = (last > starts) & _PUNCTUATION[joined[last]]
        marks += strip
        last = last - strip
    ending = np.zeros(len(word), np.uint64)
    for k in range(3):
        at = last - k
        ending = (ending << np.uint64(8)) | np.where(at >= starts, joined[np.maximum(at, 0)], 0).astype(np.uint64)
    kind = (((ending << np.uint64(1) | (marks > 0).astype(np.uint64)) * _A) >> np.uint64(40)) % np.uint64(CLASSES - 1) + np.uint64(1)
    n = w.counts + 1
    ends = np.cumsum(n) - 1
    inner = np.ones(int(n.sum()), bool)
    inner[ends] = False
    h = np.full(len(inner), END, np.uint64)
    c = np.zeros(len(inner), np.int64)
    h[inner], c[inner] = word, (kind * np.uint64(GROUPS) + (word >> np.uint64(32)) % np.uint64(GROUPS)).astype(np.int64)
    return h, c, n


def features(h: np.ndarray, leaf: np.ndarray, n: np.ndarray, shape: Shape) -> tuple[list, list]:
    """Feature rows of each token in both softmaxes, the bias last; a text's start counts as a word of its own."""
    first = np.cumsum(n) - n
    c = (leaf // GROUPS).astype(np.uint64)
    before = np.zeros(len(h), np.uint64)
    skip = np.zeros(len(h), np.uint64)
    c1 = np.full(len(h), CLASSES, np.uint64)
    c2 = np.full(len(h), CLASSES, np.uint64)
    before[1:], skip[2:] = h[:-1], h[:-2]
    c1[1:], c2[2:] = c[:-1], c[:-2]
    second = (first + 1)[n > 1]
    before[first], c1[first] = 0, CLASSES
    for at in (first, second):
        skip[at], c2[at] = 0, CLASSES
    out: tuple[list, list] = ([], [])
    base = 0
    with np.errstate(over="ignore"):
        hashed = before * _A, skip * _C, (c1 * np.uint64(CLASSES + 1) + c2) * _B
        for k, (rows, sizes) in enumerate(zip(out, shape[:2])):
            for x, size in zip(hashed, sizes):
                x = ((x >> np.uint64(24)) + c + np.uint64(1)) * _D if k else x
                rows.append(((x >> np.uint64(32)) % np.uint64(size)).astype(np.int64) + base)
                base += size
            rows.append((leaf // GROUPS) + base if k else base)
            base += CLASSES if k else 1
    return out


def _softmax(weights: np.ndarray, f: list) -> np.ndarray:
    s = weights.take(f[0], axis=0)
    for rows in f[1:]:
        s += weights.take(rows, axis=0)
    np.clip(s, -80, 80, out=s)  # the range in which single precision neither overflows nor vanishes
    np.exp(s, out=s)
    s /= s.sum(axis=1, keepdims=True)
    return s


def _cut(f: list, a: int) -> list:
    return [x[a : a + BATCH] if np.ndim(x) else x for x in f]


def _sums(rows: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows, how often each comes and its sum of g."""
    low = int(rows.min())
    k = np.bincount(rows - low)
    at = np.flatnonzero(k)
    place = np.zeros(len(k), np.int64)
    place[at] = np.arange(len(at)) * g.shape[1]
    total = np.bincount((place[rows - low][:, None] + np.arange(g.shape[1])).ravel(), weights=g.ravel(), minlength=len(at) * g.shape[1])
    return at + low, k[at], total.reshape(len(at), -1).astype(np.float32)


def steps(weights: np.ndarray, squares: np.ndarray, uses: np.ndarray, f: tuple[list, list], leaf: np.ndarray) -> None:
    """Adaptive gradient steps, in place, over minibatches of BATCH tokens."""
    for a in range(0, len(leaf), BATCH):
        for level, answers in zip(f, (leaf // GROUPS, leaf % GROUPS)):
            part, y = _cut(level, a), answers[a : a + BATCH]
            g = _softmax(weights, part)
            g[np.arange(len(y)), y] -= 1
            for rows in part:
                at, k, total = _sums(rows, g) if np.ndim(rows) else (np.array([rows]), np.array([len(y)]), g.sum(axis=0, keepdims=True))
                square = squares.take(at, axis=0) + total * total
                squares[at] = square
                square += 1e-2
                np.sqrt(square, out=square)
                total *= RATE
                total /= square
                weights[at] -= total
                uses[at] += k


def _leaf_log10(weights: np.ndarray, f: tuple[list, list], leaf: np.ndarray) -> np.ndarray:
    out = np.zeros(len(leaf))
    for level, answers in zip(f, (leaf // GROUPS, leaf % GROUPS)):
        for a in range(0, len(leaf), BATCH):
            p = _softmax(weights, _cut(level, a))
            y = answers[a : a + BATCH]
            out[a : a + BATCH] += np.log10(np.maximum(p[np.arange(len(y)), y], 1e-30))
    return out


def count_tokens(texts: DataFrame) -> DataFrame:
    """(h, leaf, n): count of each distinct token over all texts."""

    def run(batches):
        held: list[np.ndarray] = []
        size = 0

        def out():
            keys = np.concatenate([x[0] for x in held])
            order = np.argsort(keys)
            keys, first = np.unique(keys[order], return_index=True)
            n = np.add.reduceat(np.concatenate([x[2] for x in held])[order], first)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.concatenate([x[1] for x in held])[order][first].astype(np.int32)), pa.array(n)], ["h", "leaf", "n"])

        for batch in batches:
            for _, _, buf, offs in text_slices(batch.column(0)):
                h, c, _ = tokens(buf, offs)
                keys, first, n = np.unique(h, return_index=True, return_counts=True)
                held.append((keys, c[first], n.astype(np.int64)))
                size += len(keys)
                if size > HELD:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return texts.mapInArrow(run, "h bigint, leaf int, n bigint").groupBy("h").agg(F.min("leaf").alias("leaf"), F.sum("n").alias("n"))


def common_from(counts: DataFrame, most: int = FREQUENT) -> int:
    """The least count of which at most `most` words have as much or more, from a histogram of powers of 2**(1/16)."""
    step = F.floor(F.log2("n") * 16).cast("int")
    have = 0
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least"), F.max("n").alias("top")).collect(), key=lambda r: -r.step):
        have += r.words
        if have > most:
            return r.top + 1
    return 1


def gradient_round(texts: DataFrame, weights: np.ndarray, shape: Shape, workers: int) -> np.ndarray:
    """One distributed update over (text, k), dealt out and ordered by the hash `k`: workers' changes, each feature row averaged by its uses."""
    sent = texts.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = sent.value.copy()
        squares, uses = np.zeros_like(w), np.zeros(shape.rows, np.int64)
        for batch in batches:
            for _, _, buf, offs in text_slices(batch.column(0)):
                h, c, n = tokens(buf, offs)
                steps(w, squares, uses, features(h, c, n, shape), c)
        if uses.any():
            change = (w - sent.value) * uses[:, None].astype(np.float32)
            cuts = [a for a in range(0, shape.rows, BLOCK) if uses[a : a + BLOCK].any()]
            yield pa.RecordBatch.from_arrays([pa.array([a // BLOCK for a in cuts], pa.int32()), pa.array([uses[a : a + BLOCK].tobytes() for a in cuts], pa.binary()), pa.array([change[a : a + BLOCK].astype(np.float32).tobytes() for a in cuts], pa.binary())], ["block", "uses", "change"])

    def add(batches):
        total: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for b, u, x in zip(*(batch.column(k).to_pylist() for k in range(3))):
                u, x = np.frombuffer(u, np.int64), np.frombuffer(x, np.float32).astype(np.float64)
                if b in total:
                    total[b][0] += u
                    total[b][1] += x
                else:
                    total[b] = [u.copy(), x]
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([u.tobytes() for u, _ in total.values()], pa.binary()), pa.array([x.tobytes() for _, x in total.values()], pa.binary())], ["block", "uses", "change"])

    schema = "block int, uses binary, change binary"
    out = weights.copy()
    # The bound on workers, and so on the changes they send, holds where a session deals into more partitions too.
    for r in texts.repartition(workers, "k").coalesce(workers).sortWithinPartitions("k").mapInArrow(run, schema).repartition("block").mapInArrow(add, schema).collect():
        a = r.block * BLOCK
        u = np.frombuffer(r.uses, np.int64)
        out[a : a + BLOCK] += (np.frombuffer(r.change, np.float64).reshape(len(u), -1) / np.maximum(u, 1)[:, None]).astype(np.float32)
    return out


def score(docs: DataFrame, training: F.Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every whole text.

    `training` is a condition over the input's columns that marks the rows to learn from.
    """
    spark = docs.sparkSession
    learn = docs.where(training & F.col(id_col).isNotNull()).select(F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("k"))
    counts = durable(count_tokens(learn.select("text")))
    room = np.ones((CLASSES, GROUPS))
    total = types = 0
    for r in counts.groupBy("leaf").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        room[r.leaf // GROUPS, r.leaf % GROUPS] += r.n + r.v
        total, types = total + r.n, types + r.v
    shape = Shape.of(types)
    common = counts.where(F.col("n") >= common_from(counts)).select("h", "n").toArrow()
    keys, known = common.column("h").to_numpy().view(np.uint64), common.column("n").to_numpy()
    order = np.argsort(keys)
    weights = np.zeros((shape.rows, CLASSES), np.float32)
    one, many = shape.bias
    weights[one] = np.log(room.sum(axis=1)) - np.log(room.sum(axis=1)).mean()
    weights[many:] = np.log(room) - np.log(room).mean(axis=1, keepdims=True)
    workers = min(WORKERS, max(1, -(-total // (ROUNDS * SHARE * shape.times))))
    for r in range(ROUNDS if total else 0):
        # Bits apart from those that the dealing out reads.
        weights = gradient_round(learn.where(F.pmod(F.shiftright("k", 40), F.lit(ROUNDS)) == r), weights, shape, workers)
    sent = spark.sparkContext.broadcast((keys[order], known[order], weights, np.log10(room.ravel())))
    space = float(total + types + 1)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        keys, known, weights, room = sent.value
        for batch in batches:
            for a, b, buf, offs in text_slices(batch.column(1)):
                h, c, n = tokens(buf, offs)
                doc = np.repeat(np.arange(len(n)), n)
                at = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
                hit = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                seen = known[at[hit]].astype(np.float64) + 1
                base = np.bincount(doc[hit], weights=np.log10(seen), minlength=len(n)) - n * np.log10(space)
                own = _leaf_log10(weights, features(h, c, n, shape), c) - room[c]
                own[hit] += np.log10(seen)
                rest = np.flatnonzero(~hit)
                pair = np.lexsort((h[rest], doc[rest]))
                hr, dr = h[rest][pair], doc[rest][pair]
                new = np.ones(len(hr), bool)
                new[1:] = (hr[1:] != hr[:-1]) | (dr[1:] != dr[:-1])
                first = np.flatnonzero(new)
                times = np.diff(first, append=len(hr))
                cuts = np.concatenate([[0], np.cumsum(np.bincount(dr[first], minlength=len(n)))])
                fields = pa.StructArray.from_arrays([pa.array(hr[first].view(np.int64)), pa.array(times.astype(np.int64))], ["h", "times"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(np.bincount(doc[hit], minlength=len(n)).astype(np.int64)), pa.array(base), pa.array(np.bincount(doc, weights=own, minlength=len(n))), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), fields)],
                    ["doc_id", "n_tokens", "known", "base", "own", "rare"],
                )

    parts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, n_tokens bigint, known bigint, base double, own double, rare array<struct<h:bigint,times:bigint>>")
    parts = durable(parts.withColumn("row", F.monotonically_increasing_id()))
    rare = parts.select("row", F.explode("rare").alias("r")).select("row", "r.*").join(counts.select("h", "n"), "h", "inner")
    sums = rare.groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("gain"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return parts.drop("rare").join(sums, "row", "left").select("doc_id", "n_tokens", (F.col("known") + zero("more")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + zero("gain")).alias("base_score"), (F.col("own") + zero("gain")).alias("score"))
