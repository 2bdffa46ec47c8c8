import math
import re
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeworks.llm import lexical_search as s
from gaugeworks.llm.queries import ORACLES, QUERIES
from tests.llm.cases import PROSE, frame, lower, rows


def terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))


def brute(docs, items, k=20):
    cols = [(i, Counter(terms(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in cols), sum(sum(c.values()) for _, c in cols)
    df = Counter(t for _, c in cols for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in cols:
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    m = 75 + 25 * sum(c.values()) * n // total
                    score += w * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r, None if lost else doc, -score) for r, (score, lost, doc) in enumerate(sorted(found)[:k], 1)]
    return out


def run(spark, data, items, **how):
    found = s.search(frame(spark, data), spark.createDataFrame(items, "item_id long, text string, score long, rank int, _item long"), **how)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, found.collect()), key=str)


ITEMS = [(1, "quick brown FOX the the the owls", 0, 0, 0), (2, None, 0, 0, 0), (3, " -- ", 0, 0, 0), (4, "漢字 éà w17 z3 tail", 0, 0, 0), (5, "nowhere", 0, 0, 0), (6, "a fox a ÉÀ", 0, 0, 0), (None, "one two", 0, 0, 0), (6, "a fox a ÉÀ", 0, 0, 0)]


@pytest.mark.parametrize("k", [20, 2])
@pytest.mark.parametrize("block", [1 << 20, 5])
def test_edge_cases(spark, monkeypatch, k, block):
    """Nulls, empties, a very long text, ties, repeated rows and items, clashing names; with one block of items and with several."""
    monkeypatch.setattr(s, "BLOCK_ENTRIES", block)
    got = run(spark, rows(), ITEMS, k=k)
    assert got == sorted(brute([r[:2] for r in rows()], [i[:2] for i in ITEMS], k), key=str)


def test_empty_tables(spark):
    assert run(spark, [], ITEMS) == []
    assert run(spark, rows(), []) == []
    assert run(spark, [rows()[0]], ITEMS) == []


def test_many_ties_and_blocks(spark, monkeypatch):
    """A third of all documents are copies with equal scores; blocks are small, so that merging decides."""
    monkeypatch.setattr(s, "BLOCK_DOCS", 7)
    monkeypatch.setattr(s, "MERGE_GROUPS", 2)
    data = [(i, PROSE if i % 3 == 0 else f"fox {i % 7} tree" * (i % 5), *rows()[0][2:]) for i in range(300, 0, -1)]
    df = frame(spark, data).repartition(9)
    items = spark.createDataFrame([(1, "fox tree owls 3"), (2, "quick quick")], "item_id long, text string")
    got = sorted(map(tuple, s.search(df, items).collect()))
    assert got == sorted(brute([r[:2] for r in data], [(1, "fox tree owls 3"), (2, "quick quick")]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.text("aAbBé1 -", max_size=12)), max_size=12), st.lists(st.text("aAbBé1 -", max_size=8), max_size=4))
def test_any_texts(spark, docs, texts):
    items = list(enumerate(texts))
    got = s.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=3)
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs, items, 3))


def test_query_against_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '/root/testdata/sf0.001/{name}.parquet'")
    want = con.execute(ORACLES["op11_lexical_search"]).fetchall()
    got = QUERIES["op11_lexical_search"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(want)
