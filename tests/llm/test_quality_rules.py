import re
from collections import Counter

import duckdb
import pytest

from gaugeworks.llm import quality_rules as q
from gaugeworks.llm.queries import ORACLES, QUERIES
from tests.llm.cases import frame, rows, words


def brute(text):
    text = text or ""
    w = words(text)
    c = Counter(zip(w, w[1:], w[2:]))
    cover = {i + k for i in range(len(w) - 2) for k in range(3) if c[tuple(w[i : i + 3])] > 1}
    seen, dup, n = set(), 0, 0
    for line in text.split("\n"):
        if words(line):
            n += 1
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), n


def test_edge_cases(spark):
    data = rows() + [(50, "a b c a b c a b", *rows()[0][2:]), (51, "l one\nl one\n\nl one \nx", *rows()[0][2:])]
    got = q.apply_policy(q.build_ledger(frame(spark, data)), "v2").collect()
    want = sorted(((r[0], *brute(r[1])) for r in data), key=str)
    assert sorted((tuple(g)[:7] for g in got), key=str) == want
    for g in got:
        assert g.base_failed == (g.n_words < 50 or 100 * g.n_repeat_words > 50 * g.n_words) and g.kept == (g.failure_bits == 0)
    assert q.build_ledger(frame(spark, [])).count() == 0


@pytest.mark.parametrize("low", [24, 2])
def test_exact_path(spark, monkeypatch, low):
    """Few hash bits or tiny limits send texts down the exact path, with the same counts."""
    monkeypatch.setattr(q, "_LOW", (1 << low) - 1)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.n_repeat_words for r in q.measure(docs).collect()}
    assert got == {r.doc_id: brute(r.text)[4] for r in docs.collect()}


def test_policies_and_ablation(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ledger = q.build_ledger(docs).cache()
    bits = [r.failure_bits for r in ledger.collect()]
    assert q.mask(("few_words", "capitals")) == 1 | 32
    kept = {v: q.apply_policy(ledger, v).where("kept").count() for v in q.POLICIES}
    assert kept["base"] >= kept["v1"] >= kept["v2"] == sum(b == 0 for b in bits)
    for r in q.ablate(ledger, "v2").collect():
        bit = next(1 << x.bit for x in q.RULES if x.name == r.rule)
        assert r.rejected == sum(b & bit > 0 for b in bits) and r.only_this_rule == sum(b == bit for b in bits)
    ledger.unpersist()


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(ORACLES["op10_quality_rules"]).df()
    got = QUERIES["op10_quality_rules"](spark, "/root/testdata/sf0.001").toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.astype(str).to_numpy())) == sorted(map(tuple, want.astype(str).to_numpy()))
