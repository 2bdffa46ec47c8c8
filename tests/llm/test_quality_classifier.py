import math
import re

import numpy as np
import xxhash

from gaugeworks.llm import quality_classifier as qc
from gaugeworks.llm.common import fold
from tests.llm.cases import frame, lower, rows, words


def test_indicators_by_text():
    texts = ["a b a b", "", "B a", "  ", "é! ?", "one"]
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0, *map(len, raw)])
    c, n = qc.indicators(np.frombuffer(b"".join(raw), np.uint8), offs)
    ends = np.cumsum(n)
    for i, r in enumerate(raw):
        alone, k = qc.indicators(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        assert alone.tolist() == c[ends[i] - n[i] : ends[i]].tolist() and k[0] == n[i]
    assert n[1] == n[3] == 0


def test_descent_reaches_the_optimum():
    """The duality gap closes: primal and dual objectives meet."""
    rng = np.random.default_rng(1)
    rows_, n = [], []
    y = rng.random(80) < 0.5
    for i in range(80):
        c = np.unique(rng.integers(0, 40, 8) + (20 if y[i] else 0))
        rows_.append(c)
        n.append(len(c))
    c, n = np.concatenate(rows_), np.array(n)
    v = qc.scaled(c, n, qc.log_ratio(c, n, y))
    box = np.ones(80)
    w, b = qc.descend(c, v, n, y, box, passes=400)
    doc = np.repeat(np.arange(80), n)
    margin = np.bincount(doc, weights=w[c] * v) + b
    primal = 0.5 * (w @ w + b * b) + np.maximum(0, 1 - np.where(y, 1, -1) * margin).sum()
    for _ in range(200):
        d = rng.normal(size=len(w)) * 0.02
        m2 = np.bincount(doc, weights=(w + d)[c] * v) + b
        assert 0.5 * ((w + d) @ (w + d) + b * b) + np.maximum(0, 1 - np.where(y, 1, -1) * m2).sum() >= primal - 1e-2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = fold("doc_id", 4) == 2
    model = qc.fit(docs.where(~held), labels)
    got = qc.score(docs.where(held), model).join(labels, "doc_id").select("predicted", "quality", "score").collect()
    poor = [r for r in got if r.quality == 0]
    good = [r for r in got if r.quality == 1]
    assert len(got) > 500 and sum(r.predicted for r in good) >= 0.97 * len(good) and sum(r.predicted for r in poor) <= 0.05 * len(poor)


def test_edge_cases(spark):
    docs = frame(spark)
    labels = spark.createDataFrame([(0, 1), (3, 0), (5, 1), (5, 0), (6, None), (None, 1), (12, 0), (8, 1)], "doc_id long, quality int")
    model = qc.fit(docs, labels)
    got = qc.score(docs, model).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    none = qc.fit(docs, labels.where("quality > 5"))
    assert {round(r.score, 3) for r in qc.score(docs, none).collect()} == {0.5}
    assert qc.score(frame(spark, []), model).count() == 0


def brute_columns(text):
    """Indicators by plain loops: words, shapes, and pairs of each."""
    m64, pair = (1 << 64) - 1, 0x9E3779B97F4A7C15
    kind = lambda b: 97 if 97 <= b < 123 or b >= 128 else 65 if 65 <= b < 91 else 48 if 48 <= b < 58 else b
    own = [w.encode() for w in words(text)]
    low = [xxhash.xxh64_intdigest(lower(w.decode()).encode(), 1) for w in own]
    shape = [xxhash.xxh64_intdigest(re.sub(rb"(?s)(.)\1+", rb"\1", bytes(map(kind, w))), 2) for w in own]
    out = set(low) | set(shape)
    for i in range(len(own) - 1):
        out.add(((7 if low[i] == low[i + 1] else (low[i] * pair & m64) ^ low[i + 1]) * pair & m64) >> 40)
        out.add((((shape[i] * pair & m64) ^ shape[i + 1]) * pair & m64) >> 40)
    return {x & (1 << qc.BITS) - 1 for x in out}


def test_scores(spark):
    """Each text's score from the model's numbers, by plain loops."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = qc.fit(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    got = {r.doc_id: r for r in qc.score(docs, model).collect()}
    for r in docs.limit(60).collect():
        c = sorted(brute_columns(r.text))
        size = math.sqrt(max(1e-12, sum(float(model.ratio[x]) ** 2 for x in c)))
        margin = sum(float(model.weight[x]) * float(model.ratio[x]) for x in c) / size + model.bias
        p = 1 / (1 + math.exp(-max(-30, min(30, model.slope * margin + model.shift))))
        assert abs(p - got[r.doc_id].score) < 1e-6 and got[r.doc_id].predicted == (got[r.doc_id].score >= 0.7)


def test_sample_is_of_the_texts_that_may_teach_and_bounded_in_size(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(qc, "train", lambda c, n, y: seen.update(c=c, n=n, y=y))
    docs = spark.createDataFrame([(i % 40, f"text {i} " + "w " * i) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    qc.fit(docs, labels, sample=50)
    assert len(seen["n"]) == 50
    monkeypatch.setattr(qc, "COLUMNS_HELD", 60)
    qc.fit(docs, labels, sample=50)
    assert seen["n"].sum() <= 60 and len(seen["n"]) >= 5
