import math
from collections import Counter

import numpy as np
import pytest

from gaugeworks.llm import language_model as lm
from gaugeworks.llm.common import fold
from tests.llm.cases import frame, lower, rows, words


def brute(data, learned):
    toks = [[*words(lower(t)), None] for _, t in data]
    c = Counter(x for (i, _), t in zip(data, toks) if learned(i) for x in t)
    n, v = sum(c.values()), len(c)
    return [(i, len(t), sum(c[x] > 0 for x in t), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t)) for (i, _), t in zip(data, toks)]


def same(got, want):
    got, want = sorted(got, key=str), sorted(want, key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert all(g[4] == pytest.approx(w[4], rel=1e-9, abs=1e-9) and g[5] <= 1e-9 for g, w in zip(got, want))


@pytest.mark.parametrize("frequent", [1 << 18, 50])
def test_base_and_gain(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = fold("doc_id", 7) == 2
    got = lm.score(docs, ~held).collect()
    ids = {r.doc_id for r in docs.where(held).select("doc_id").collect()}
    same(got, brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], lambda i: i not in ids))
    out = [r for r in got if r.doc_id in ids]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.02 * sum(r.n_tokens for r in out)


def start(shape):
    return np.zeros((shape.rows, lm.CLASSES), np.float32)


def batch(*texts):
    raw = [t.encode() for t in texts]
    return lm.tokens(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


def keyed(docs):
    from pyspark.sql import functions as F

    return docs.select("text", F.xxhash64("id", "text").alias("k"))


def test_model_sums_to_one(spark):
    """Over all words and the unseen one, a history's probabilities sum to one."""
    texts = ["the cat sat on the mat.", "the dog sat on the rug.", "a cat and a dog, and a bird!"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    counts = lm.count_tokens(docs.select("text")).collect()
    shape = lm.Shape()
    w = lm.gradient_round(keyed(docs), start(shape), shape, 2)
    h, leaf, n = batch(texts[0])
    leaves = lm.CLASSES * lm.GROUPS
    room = {k: sum(r.n + 1 for r in counts if r.leaf == k) + 1 for k in range(leaves)}
    inside = np.array([sum((r.n + 1) / room[k] for r in counts if r.leaf == k) + 1 / room[k] for k in range(leaves)])
    first, _ = lm.features(h, leaf, n, shape)
    p = np.zeros(len(h))
    by_class = lm._softmax(w, first)
    for c in range(lm.CLASSES):  # the history stays, the word's class is each in turn
        by_group = []
        for t in range(len(h)):
            other = leaf.copy()
            other[t] = c * lm.GROUPS
            by_group.append(lm._softmax(w, [x[t : t + 1] for x in lm.features(h, other, n, shape)[1]])[0])
        p += by_class[:, c] * (np.array(by_group) @ inside[c * lm.GROUPS : (c + 1) * lm.GROUPS])
    assert np.allclose(p, 1, atol=1e-5) and abs(w).max() > 0


def test_sums():
    rng = np.random.default_rng(1)
    rows, g = rng.integers(50, 90, 500), rng.normal(size=(500, 7)).astype(np.float32)
    at, k, total = lm._sums(rows, g)
    assert at.tolist() == sorted(set(rows.tolist()))
    for a, n, x in zip(at, k, total):
        assert n == (rows == a).sum() and np.allclose(x, g[rows == a].sum(axis=0), atol=1e-4)


def test_gradient():
    """A step's direction is that of the log-likelihood's numeric gradient."""
    rng = np.random.default_rng(0)
    shape = lm.Shape()
    w = rng.normal(size=(shape.rows, lm.CLASSES)).astype(np.float32) * 0.1
    h, leaf, n = batch("one two three four one two", "three one two, four five", "")
    f = lm.features(h, leaf, n, shape)
    before = lm._leaf_log10(w, f, leaf).sum()
    moved, unit = w.copy(), np.full_like(w, 1e8)
    lm.steps(moved, unit, np.zeros(shape.rows, np.int64), f, leaf)
    assert lm._leaf_log10(moved, f, leaf).sum() > before
    gradient = (w - moved).astype(np.float64) * 1e4 / lm.RATE
    for row in (f[0][0][2], f[1][0][2], f[0][3], f[1][2][1]):
        for col in (0, int(leaf[2]) // lm.GROUPS, int(leaf[2]) % lm.GROUPS):
            side = []
            for d in (1e-2, -1e-2):
                other = w.copy()
                other[row, col] += d
                side.append(lm._leaf_log10(other, f, leaf).sum() * math.log(10))
            assert (side[1] - side[0]) / 2e-2 == pytest.approx(gradient[row, col], abs=2e-2)


def test_history_tells_words_of_a_class_apart(spark):
    """"rose" and "nose" have one class and one count; the word before decides between them."""
    texts = ["red rose red rose red rose red rose", "big nose big nose big nose big nose"] * 200
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(1000, "red rose red rose"), (1001, "red nose red nose")], "doc_id long, text string")
    _, leaf, _ = batch("rose nose")
    assert leaf[0] // lm.GROUPS == leaf[1] // lm.GROUPS and leaf[0] != leaf[1]
    from pyspark.sql import functions as F

    got = {r.doc_id: r for r in lm.score(docs, F.col("doc_id") < 1000).where("doc_id >= 1000").collect()}
    assert got[1000].base_score == pytest.approx(got[1001].base_score) and got[1000].score > got[1001].score + 0.3


def test_score_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARE", 20_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    held = fold("doc_id", 7) == 2
    one, many = ({r.doc_id: r.score for r in lm.score(d, ~held).collect()} for d in (docs.coalesce(1), docs.repartition(7)))
    assert one.keys() == many.keys() and all(many[k] == pytest.approx(x, rel=1e-5) for k, x in one.items())


def test_shape_grows_with_the_words():
    sizes = [lm.Shape.of(n).rows for n in (0, 1 << 22, (1 << 22) + 1, 1 << 26, 1 << 40)]
    assert sizes[0] == sizes[1] < sizes[2] < sizes[3] < sizes[4] < 1 << 19


def test_edge_cases(spark):
    data = [(r[0], r[1]) for r in rows()]
    held = fold("doc_id", 7) == 2
    docs = frame(spark)
    ids = {r.doc_id for r in docs.where(held).select("doc_id").collect()} | {None}
    same(lm.score(docs, ~held).collect(), brute(data, lambda i: i not in ids))
    from pyspark.sql import functions as F

    same(lm.score(docs, F.lit(False)).collect(), brute(data, lambda i: False))
    assert lm.score(frame(spark, []), ~held).count() == 0
