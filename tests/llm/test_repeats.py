import hashlib

import numpy as np
import pytest

from gaugeworks.llm import filters, repeats
from tests.llm.cases import frame, rows


def brute(data, length=100):
    """First start of every string, then what later ones cover."""
    raw = [(i, (t or "").encode()) for i, t in data]
    key = lambda i: (1 << 63) - 1 if i is None else i
    first = {}
    for i, r in raw:
        for s in range(len(r) - length + 1):
            w = r[s : s + length]
            if w not in first or (key(i), s) < first[w]:
                first[w] = (key(i), s)
    out = []
    for i, r in raw:
        gone = np.zeros(len(r), bool)
        for s in range(len(r) - length + 1):
            if first[r[s : s + length]] < (key(i), s):
                gone[s : s + length] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def compare(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_shared_prefixes():
    rng = np.random.default_rng(5)
    pieces = [rng.integers(0, 2, n).astype(np.uint8) for n in (60, 1, 40, 0, 60, 25)]
    pieces[4][:30] = pieces[0][20:50]
    sizes = np.array([len(p) for p in pieces]) + 1
    past = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    text = np.concatenate([np.append(p, np.uint8(0)) for p in pieces])
    begin, end = (past - sizes)[owner], past[owner] - 1
    order, shared = repeats.shared_prefixes(text, begin, end, 12)
    tail = [text[i : end[i]].tobytes() for i in range(len(text))]
    assert [tail[i] for i in order] == sorted(tail)

    def common(a, b):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        return 12 if a == b else min(k, 12)  # equal tails are not told apart

    assert shared[1:].tolist() == [common(tail[a], tail[b]) for a, b in zip(order, order[1:])]


@pytest.mark.parametrize("hot", [20_000, 2])
def test_planted(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = np.random.default_rng(1)
    say = lambda n: "".join(rng.choice(list("abcdefghij é"), n))
    passage, loop = say(400), say(7)
    data = [(i, say(int(rng.integers(0, 900)))) for i in range(30)]
    data += [(100 + i, say(50) + passage[int(rng.integers(0, 200)) :] + say(60)) for i in range(12)]
    data += [(200 + i, data[5][1]) for i in range(3)] + [(300, loop * 90), (301, say(30) + loop * 40), (302, passage + passage), (303, "x" * 700)]
    data += [(400 + i, say(20) + passage[:99] + say(20)) for i in range(4)]
    rng.shuffle(data)
    data = [(int(i), t) for i, t in data]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    compare(repeats.remove_repeats(docs).collect(), brute(data))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    compare(repeats.remove_repeats(docs).collect(), brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))


def test_edge_cases(spark):
    data = [r if r[0] != 8 else (8, r[1][:20_000], *r[2:]) for r in rows()]
    got = repeats.remove_repeats(frame(spark, data), keep_bytes=True)
    compare(got.drop("kept").collect(), brute([(r[0], r[1]) for r in data]))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got.collect())
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


def test_hash_of_longs(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    x = rng.integers(-(2**63), 2**63 - 1, (50, 3))
    got = spark.createDataFrame(x.tolist(), "a long, b long, c long").select(F.xxhash64("a", "b", "c").alias("h")).collect()
    assert [r.h for r in got] == filters.mixed(*(np.ascontiguousarray(c) for c in x.T)).view(np.int64).tolist()
