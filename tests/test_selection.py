"""Quantiles by selection against sorted values; neighbours by halo against `lag` over the whole."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gaugeworks.operators import relational as r
from gaugeworks.operators import sequence as q


def expected(values, share):
    x = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    if not x:
        return None
    at = share * (len(x) - 1)
    low = int(at)
    return x[low] + (x[min(low + 1, len(x) - 1)] - x[low]) * (at - low)


SHARES = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.501, "e": 0.999, "f": 1.0}
CASES = {
    "skewed": lambda g: [g.lognormvariate(0, 8) * g.choice([-1, 1]) for _ in range(9000)],
    "ties": lambda g: [g.choice([5.0, 5.0, 5.0, g.random() * 10, None]) for _ in range(9000)],
    "two": lambda g: [g.choice([1.0, 2.0]) for _ in range(7001)],
    "edge": lambda g: [3.0] * 4000 + [3.0 + i / 1000 for i in range(4000)],
    "one": lambda g: [7.5],
    "none": lambda g: [None, None],
    "few": lambda g: [2.0, None, 1.0, -math.inf, math.inf],
}


@pytest.mark.parametrize("few", [20_000, 3])
@pytest.mark.parametrize("sketch", [10_000, 20])
@pytest.mark.parametrize("case", CASES)
def test_quantiles(spark, monkeypatch, case, few, sketch):
    monkeypatch.setattr(r, "FEW", few)
    monkeypatch.setattr(r, "SKETCH", sketch)
    values = CASES[case](random.Random(3))
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    shares = SHARES if case != "few" else {k: SHARES[k] for k in "ac"}
    got = r.quantiles(df, "v", shares).first().asDict()
    assert str(got) == str({k: expected(values, s) for k, s in shares.items()})  # nan is like nan


def test_no_sort_and_no_writes(spark, monkeypatch):
    monkeypatch.setattr(r, "materialise", None)
    df = spark.range(50_000).select((F.xxhash64("id") % 1000 / 7.0).alias("v"), F.col("id").cast("double").alias("w"))
    found = r.select_quantiles(df, {"x": ("v", 0.5), "y": ("w", 0.3)})
    assert found == {"x": expected([row.v for row in df.collect()], 0.5), "y": 0.3 * 49_999}
    plan = r.describe(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "rangepartitioning" not in plan


def neighbours(seed, n):
    g = random.Random(seed)
    return [(g.choice(["a", "b", "b", "b", None]), g.choice([None, g.randrange(10**6)]) if i % 9 == 0 else i * 7, g.choice("xyz"), g.random()) for i in range(n)]


@pytest.mark.parametrize("n,by", [(0, []), (1, []), (700, []), (700, ["file"]), (3000, ["file"])])
def test_row_above(spark, monkeypatch, n, by):
    """Equal to `lag` over the whole, with one exchange of all rows."""
    monkeypatch.setattr(q, "HALO_SAMPLE", 50)
    rows = list({(*r[:2],): r for r in neighbours(n, n)}.values())
    df = spark.createDataFrame(rows, "file string, row long, kind string, v double").repartition(6)
    got = q.row_above(df, by, ["row"] if by else ["file", "row"], ["kind", "v"], "above")
    w = Window.partitionBy(*by).orderBy("row") if by else Window.orderBy("file", "row")
    want = df.withColumn("above", F.lag(F.struct("kind", "v")).over(w))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns


def test_row_above_keeps_clashing_names(spark):
    df = spark.createDataFrame([(i, i * 2, -i) for i in range(50)], "row long, _part long, _halo long")
    got = q.row_above(df, [], ["row"], ["_part"], "above").collect()
    assert {r.row: r.above and r.above._part for r in got} == {i: (i - 1) * 2 if i else None for i in range(50)}
