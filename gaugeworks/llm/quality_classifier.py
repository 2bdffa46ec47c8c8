"""Quality classifier: Naive Bayes support vectors.

N-gram indicators (words, word shapes, and pairs of each, hashed to 2**BITS columns) are scaled by
the log-ratio of the classes' smoothed counts, brought to unit length, and separated by a linear
hinge-loss model fitted by dual coordinate descent.  Margins become probabilities by a logistic
curve fitted on rows that the hinge fit doesn't see.

Fitting reads at most `SAMPLE` of the labelled texts that it may learn from, those of the smallest hash of id and text,
and of these, in that order, as many as have COLUMNS_HELD indicators together.  Scoring covers every whole text and
ships a model of fixed size.

Edge cases: null and empty texts have no indicator and get the score of margin `bias`; rows with a
null label, id or text teach nothing (an empty text does); repeated labels of one id count by their mean; if
only one class is seen, every score is that class's smoothed share; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import bounded_sample, durable
from gaugeworks.llm.textbatch import LOWER, Words, text_slices, xxh64

SAMPLE = 10_000
#: Indicators of all sampled texts that the driver holds: 64 MB.
COLUMNS_HELD = 1 << 24
BITS = 18
#: Added to each column's count; the dual box; passes of coordinate descent.
ALPHA, BOX, PASSES = 1.0, 1.0, 12
THRESHOLD = 0.7
_MASK = np.uint64((1 << BITS) - 1)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
#: Shape of a byte: letters a / A, digits 0, other ASCII as it is, bytes of longer characters a.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SHAPE[128:] = 97


@dataclass
class Model:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def indicators(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of each text in order, and how many each has."""
    w = Words(buf, offs)
    joined, starts, lens = w.joined(buf)
    low = LOWER[joined]
    shapes = _SHAPE[joined]
    same = np.zeros(len(shapes), bool)
    same[1:] = shapes[1:] == shapes[:-1]
    same[starts] = False
    at = np.cumsum(~same) - 1
    squeezed = np.concatenate([shapes[~same], np.zeros(8, np.uint8)])
    word = xxh64(low, starts, lens, 1)
    shape_start = at[starts] if len(starts) else starts
    shape = xxh64(squeezed, shape_start, (at[starts + lens - 1] + 1 - shape_start) if len(starts) else lens, 2)
    parts, owners = [word, shape], [w.doc, w.doc]
    if len(word) > 1:
        near = w.doc[1:] == w.doc[:-1]
        with np.errstate(over="ignore"):
            pair = np.where(word[1:] == word[:-1], np.uint64(7), (word[:-1] * _PAIR) ^ word[1:]) * _PAIR
            kinds = ((shape[:-1] * _PAIR) ^ shape[1:]) * _PAIR
        parts += [(pair >> np.uint64(40))[near], (kinds >> np.uint64(40))[near]]
        owners += [w.doc[1:][near]] * 2
    keys = np.unique((np.concatenate(owners).astype(np.uint64) << np.uint64(BITS)) | (np.concatenate(parts) & _MASK))
    return (keys & _MASK).astype(np.int32), np.bincount((keys >> np.uint64(BITS)).astype(np.int64), minlength=len(offs) - 1)


def log_ratio(columns: np.ndarray, n: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log of the classes' smoothed, normed counts of each column."""
    own = np.repeat(y, n)
    good = ALPHA + np.bincount(columns[own], minlength=1 << BITS)
    poor = ALPHA + np.bincount(columns[~own], minlength=1 << BITS)
    return np.log(good / good.sum()) - np.log(poor / poor.sum())


def scaled(columns: np.ndarray, n: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """The log-ratios of each text's columns, brought to unit length."""
    v = ratio[columns]
    square = np.bincount(np.repeat(np.arange(len(n)), n), weights=v * v, minlength=len(n))
    return v / np.repeat(np.sqrt(np.maximum(square, 1e-12)), n)


def descend(columns: np.ndarray, values: np.ndarray, n: np.ndarray, y: np.ndarray, box: np.ndarray, passes: int = PASSES, seed: int = 0) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L1 hinge loss with a bias column of one."""
    ends = np.cumsum(n)
    weight, bias = np.zeros(1 << BITS), 0.0
    alpha = np.zeros(len(n))
    norm = np.bincount(np.repeat(np.arange(len(n)), n), weights=values * values, minlength=len(n)) + 1
    sign = np.where(y, 1.0, -1.0)
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(n)):
            s = slice(ends[i] - n[i], ends[i])
            c, v = columns[s], values[s]
            gradient = sign[i] * (weight[c] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), box[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                weight[c] += step * v
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weight, bias


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton's method on smoothed targets."""
    good, poor = int(y.sum()), int((~y).sum())
    target = np.where(y, (good + 1) / (good + 2), 1 / (poor + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum() + 1e-3 * a, (p - target).sum()])
        q = p * (1 - p)
        h = np.array([[(q * margin * margin).sum() + 1e-3, (q * margin).sum()], [(q * margin).sum(), q.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b


def train(columns: np.ndarray, n: np.ndarray, y: np.ndarray) -> Model:
    if not y.any() or y.all():
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32), 0.0, 1e-3, float(np.log(share / (1 - share))))

    def part(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return columns[np.repeat(rows, n)], n[rows]

    def fit(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        c, k = part(rows)
        ratio = log_ratio(c, k, y[rows])
        box = BOX * np.where(y[rows], 1.0, max(1.0, y[rows].sum() / max(1, (~y[rows]).sum())))
        return ratio, *descend(c, scaled(c, k, ratio), k, y[rows], box)

    apart = np.arange(len(n)) % 5 == 0
    if y[apart].sum() >= 5 and (~y[apart]).sum() >= 5:
        ratio, weight, bias = fit(~apart)
        c, k = part(apart)
    else:
        ratio, weight, bias = fit(np.ones(len(n), bool))
        apart = np.ones(len(n), bool)
        c, k = columns, n
    margin = np.bincount(np.repeat(np.arange(len(k)), k), weights=weight[c] * scaled(c, k, ratio), minlength=len(k)) + bias
    slope, shift = calibrate(margin, y[apart])
    ratio, weight, bias = fit(np.ones(len(n), bool))
    return Model(ratio.astype(np.float32), weight.astype(np.float32), bias, slope, shift)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Learns from a bounded sample of the labelled documents."""
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).where("doc_id is not null and label is not null").groupBy("doc_id").agg((F.avg("label") >= 0.5).alias("label"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text is not null").withColumn("h", F.xxhash64("doc_id", "text"))
    chosen = bounded_sample(texts.select("doc_id", "h").join(marks, "doc_id"), sample, "h").dropDuplicates(["h"])

    def columns_of(batches):
        for batch in batches:
            lists = []
            for _, _, buf, offs in text_slices(batch.column(0)):
                c, n = indicators(buf, offs)
                lists.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(c)))
            if lists:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(lists), batch.column(1), batch.column(2)], ["c", "label", "h"])

    rows = texts.drop("doc_id").join(F.broadcast(chosen.select("h", "label")), "h").dropDuplicates(["h"])
    made = durable(rows.select("text", "label", "h").mapInArrow(columns_of, "c array<int>, label boolean, h bigint"))
    sizes = made.select("h", F.size("c").alias("n")).toArrow().sort_by("h")
    fits = int(np.searchsorted(np.cumsum(sizes.column("n").to_numpy()), COLUMNS_HELD, "right"))
    last = int(sizes.column("h")[max(0, min(fits, len(sizes)) - 1)].as_py()) if len(sizes) else 0
    got = made.where(F.col("h") <= last).toArrow().sort_by("h").combine_chunks()
    lists = got.column("c").combine_chunks()
    n = lists.value_lengths().to_numpy().astype(np.int64)
    return train(lists.flatten().to_numpy().astype(np.int64), n, got.column("label").to_numpy().astype(bool))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        m = sent.value
        product = m.weight.astype(np.float64) * m.ratio
        square = m.ratio.astype(np.float64) ** 2
        for batch in batches:
            out = []
            for _, _, buf, offs in text_slices(batch.column(1)):
                c, n = indicators(buf, offs)
                doc = np.repeat(np.arange(len(n)), n)
                size = np.sqrt(np.maximum(np.bincount(doc, weights=square[c], minlength=len(n)), 1e-12))
                out.append(m.probability(np.bincount(doc, weights=product[c], minlength=len(n)) / size + m.bias))
            p = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")
