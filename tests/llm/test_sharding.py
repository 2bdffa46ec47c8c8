import zlib
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeworks.llm import sharding as s
from gaugeworks.llm.queries import ORACLES, QUERIES
from tests.llm.cases import frame, rows


def one(x, n, seed):
    """The permutation of one number, written out."""
    a = next(k for k in range(1, n + 2) if k * k >= n)
    b = -(-n // a)
    while True:
        left, right = divmod(x, b)
        for i, (k, c) in enumerate(s.round_keys(seed)):
            mix = lambda v, k=k, c=c: (((v * k + c) % s.PRIME) ** 2 + c) % s.PRIME
            if i % 2 == 0:
                left = (left + mix(right)) % a
            else:
                right = (right + mix(left)) % b
        x = left * b + right
        if x < n:
            return x


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 1 << 40))
def test_permutation(n, seed):
    x = np.arange(n)
    got = s.permute(x, n, seed)
    assert sorted(got.tolist()) == x.tolist()
    assert (s.unpermute(got, n, seed) == x).all()
    k = n // 2
    assert got[k] == one(k, n, seed)


def test_large_tables():
    n = (1 << 60) - 12345
    x = np.random.default_rng(3).integers(0, n, 2000)
    shard, slot = s.locate(x, n, 1000)
    assert (s.row_at(shard, slot, n, 1000) == x).all()


def test_shuffles():
    """Neighbours land far apart, and every shard draws evenly from all parts of the table."""
    n = 100_000
    p = s.permute(np.arange(n), n)
    assert abs(np.corrcoef(np.arange(n), p)[0, 1]) < 0.02
    counts = np.histogram2d(np.arange(n) * 20 // n, p % 40, bins=(20, 40))[0]
    assert ((counts - 125) ** 2 / 125).sum() < 950  # chi square of 741 degrees of freedom: 741 +- 39


def size_of(t):
    return len((t or "").encode()) + 16


def test_edge_cases(spark):
    """Nulls, empties, repeated rows, long texts and clashing names; results don't depend on partitions."""
    data = rows() * 5
    got = s.shard_documents(frame(spark, data)).collect()
    crc = lambda t: zlib.crc32((t or "").encode())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d[0], size_of(d[1]), crc(d[1])) for d in data)
    assert sorted(r.row_number for r in got) == list(range(len(data)))
    for r in got:
        assert (r.shard, r.slot) == tuple(int(x[0]) for x in s.locate(np.array([r.row_number]), len(data)))
    for shard in range(40):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots))) and len(data) // 40 <= len(slots) <= -(-len(data) // 40)
    again = s.shard_documents(frame(spark, data[::-1]).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert s.shard_documents(frame(spark, [])).count() == 0
    assert sorted(r.row_number for r in s.shard_documents(frame(spark, data[:1])).collect()) == [0]


def test_one_row_many_times(spark, monkeypatch):
    monkeypatch.setattr(s, "RUN", 7)
    df = spark.range(1000).selectExpr("if(id < 700, 5, id) as doc_id", "'x' as shard", "id % 1 as row_number")
    got = s.assign(df, 8).collect()
    assert sorted(r.row_number for r in got) == list(range(1000))
    assert Counter(r.doc_id for r in got)[5] == 700
    assert sorted(Counter(r.shard for r in got).values()) == [125] * 8
    assert [r.doc_id for r in sorted(got, key=lambda r: r.row_number)] == sorted(r.doc_id for r in got)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(ORACLES["op13_sharding"]).fetchall()
    got = QUERIES["op13_sharding"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(want)
