import hashlib
import zlib

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeworks.llm import periodic_runs as r
from gaugeworks.llm.queries import ORACLES, QUERIES
from tests.llm.cases import COLUMNS, frame, rows, words


def brute(w):
    """Runs by comparing all pairs of words."""
    x, found = np.unique(np.array(w, object).astype(str), return_inverse=True)[1], {}
    for p in range(1, len(w) // 4 + 1):
        edge = np.flatnonzero(np.append(True, x[p:] != x[:-p]))  # 1 + where words p apart differ
        edge = np.append(edge, len(w) - p + 1)
        for k in np.flatnonzero(np.diff(edge) - 1 + p >= max(6, 4 * p)).tolist():
            found.setdefault((int(edge[k]), int(edge[k + 1]) - 1 + p), p)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def collapsed(w, runs=None):
    gone = {i for s, n, p in (brute(w) if runs is None else runs) for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


WORDS = st.one_of(st.lists(st.sampled_from("abc"), max_size=60), st.tuples(st.lists(st.sampled_from("ab"), min_size=1, max_size=6), st.integers(1, 9), st.lists(st.sampled_from("ab"), max_size=8)).map(lambda x: x[0] * x[1] + x[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=5))
def test_runs_of_many_texts(texts):
    raw = [" ".join(t).encode() for t in texts]
    buf, offs = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    runs, left = r._slice_runs(buf, offs)
    assert [[(x["start"], x["length"], x["period"]) for x in got] for got in runs.to_pylist()] == [brute(t) for t in texts]
    assert left.to_pylist() == [collapsed(t) for t in texts]


def test_long_runs_and_chunks(monkeypatch):
    """Runs longer than a chunk, a run within a run, and one to the last word."""
    monkeypatch.setattr(r, "CHUNK", 3)
    for w in ([*"xy", *["a"] * 500], [*list("abcab" * 100), "q", *list("abcde" * 40)], ([*"aaaaaab"] * 30 + [*"cd"]) * 5):
        x = np.append(np.unique(w, return_inverse=True)[1], -1)
        assert [(s, e - s, p) for s, e, p in r.find_runs(x, len(w)).tolist()] == brute(w)


def test_edge_cases(spark):
    loop = "one two three " * 9
    data = [*rows(), (70, loop, *rows()[0][2:]), (70, loop, *rows()[0][2:]), (71, "\t a a " * 30, *rows()[0][2:])]
    got = r.periodic_runs(frame(spark, data))
    assert got.columns == [*[c.split()[0] for c in COLUMNS.split(", ")], "runs", "collapsed"]
    want = [(d[0], d[1], (found := brute(words(d[1]))), collapsed(words(d[1]), found)) for d in data]
    assert sorted(((x.doc_id, x.text, [tuple(y) for y in x.runs], x.collapsed) for x in got.collect()), key=str) == sorted(want, key=str)
    assert r.periodic_runs(frame(spark, [])).count() == 0
    again = r.periodic_runs(frame(spark, data).withColumns({"runs": F.lit("x"), "collapsed": F.lit(3)}))
    assert sorted(map(str, again.select("runs", "collapsed").collect())) == sorted(map(str, got.select("runs", "collapsed").collect()))


def planted(i, text):
    w = words(text)
    h = None if i is None else zlib.crc32(str(i).encode())
    if h is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def expected(i, text):
    w = planted(i, text)
    runs = brute(w)
    best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines), sha(collapsed(w, runs))


def test_planted_runs(spark):
    data = [(i, t, *x) for i, (_, t, *x) in zip(range(400), rows() * 30) if t is None or len(t) < 9999] + [(None, "a b " * 9, *rows()[0][2:])]
    docs = r.with_planted_runs(frame(spark, data).select("doc_id", "text"), F.crc32(F.col("doc_id").cast("string").cast("binary")))
    got = r.digests(r.periodic_runs(docs, carried=["doc_id"]), "doc_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted((expected(*d[:2]) for d in data), key=str)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(ORACLES["op12_periodic_runs"]).fetchall()
    got = QUERIES["op12_periodic_runs"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(x.n_runs > 0 for x in got) > 5
