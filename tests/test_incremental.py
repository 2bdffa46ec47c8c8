"""Incremental results: only changed groups are computed, results equal a full run, the next stage follows."""

import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators.relational import GateError
from gaugeworks.sources import incremental as inc
from gaugeworks.sources import state

SCHEMA = "page string, g string, cat string, words long"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def totals(seen):
    def compute(rows):
        seen.append(sorted(r.g for r in rows.select("g").distinct().collect()))
        return rows.groupBy("g").agg(F.max("cat").alias("cat"), F.sum("words").alias("words"))

    return compute


def held(spark, base, key="g"):
    return {r[key]: tuple(r) for r in inc.results(spark, base).collect()}


def test_one_page_reruns_one_group(spark, tmp_path):
    base, seen = f"{tmp_path}/s", []
    rows = [(f"p{i}", f"g{i % 7}", "c", i) for i in range(40)]
    run = inc.refresh(frame(spark, rows), base, "g", totals(seen))
    assert (run.before, run.version) == (None, 0) and len(seen[0]) == 7
    shuffled = random.Random(1).sample(rows, len(rows))
    run = inc.refresh(frame(spark, shuffled).repartition(5), base, "g", totals(seen))
    assert run.version == 0 and run.touched.isEmpty() and len(seen) == 1
    rows[9] = ("p9", "g2", "c", None)
    run = inc.refresh(frame(spark, rows), base, "g", totals(seen))
    assert seen[1:] == [["g2"]] and [tuple(r) for r in run.touched.collect()] == [("g2", "changed", True)]
    assert held(spark, base)["g2"] == ("g2", "c", sum(i for i in range(40) if i % 7 == 2 and i != 9))


def test_random_edits_equal_a_full_run(spark, tmp_path):
    """Rows come, go, change, move and are repeated; after each step the results are those of a run over everything, groups that vanish and return included."""
    base, rng, seen = f"{tmp_path}/s", random.Random(5), []
    rows = [(f"p{i}", rng.choice("abcdef"), rng.choice("xy"), rng.randint(0, 9)) for i in range(20)]
    groups = lambda rs: {g: sorted((r for r in rs if r[1] == g), key=repr) for g in {r[1] for r in rs if r[1]}}
    old = {}
    for step in range(5):
        inc.refresh(frame(spark, rows), base, "g", totals(seen), range_rows=2)
        new = groups(rows)
        differ = sorted(g for g in new if new[g] != old.get(g))
        if differ:
            assert seen.pop() == differ
        assert held(spark, base) == {r.g: tuple(r) for r in totals([])(frame(spark, rows).where("g is not null")).collect()}
        old = new
        rows = [r for r in rows if r[1] != rng.choice("abcdef")] + [rng.choice(rows)] + [(f"n{step}", rng.choice(["a", "f", None]), None, step)]


def test_selectors(spark, tmp_path):
    base, seen = f"{tmp_path}/s", []
    rows = [("p1", "a", "c", 1), ("p2", "b", "c", 2), ("p3", None, "c", 3)]
    with pytest.raises(GateError):
        inc.refresh(frame(spark, rows), base, "g", totals(seen), only="z")
    inc.refresh(frame(spark, rows), base, "g", totals(seen), only="a")
    inc.refresh(frame(spark, rows), base, "g", totals(seen), only="a")
    assert set(held(spark, base)) == {"a"} and seen == [["a"]]
    run = inc.refresh(frame(spark, rows), base, "g", totals(seen), only="a", again=True)
    assert seen[1:] == [["a"]] and run.touched.first().change == "again"
    inc.refresh(frame(spark, rows), base, "g", totals(seen))
    assert seen[2:] == [["b"]] and set(held(spark, base)) == {"a", "b"}
    inc.refresh(frame(spark, rows), base, "g", totals(seen), again=True)
    assert seen[3:] == [["a", "b"]]
    inc.refresh(frame(spark, [("p1", "a", "c", 9)]), base, "g", totals(seen), columns=["page"])
    assert set(held(spark, base)) == {"a"}
    inc.refresh(frame(spark, []), base, "g", totals(seen))
    assert not held(spark, base)


def test_failures(spark, tmp_path):
    """A failed run commits nothing; a group without a result, or with an error, comes again; two results are an error."""
    base, seen = f"{tmp_path}/s", []
    rows = [("p1", "a", "c", 1), ("p2", "b", "c", 2)]

    def broken(df):
        raise OSError

    with pytest.raises(OSError):
        inc.refresh(frame(spark, rows), base, "g", broken)
    assert state.latest(spark, base) is None
    run = inc.refresh(frame(spark, rows), base, "g", lambda df: totals(seen)(df).where("g = 'a'"))
    assert {(r.g, r.done) for r in run.touched.collect()} == {("a", True), ("b", False)}
    with pytest.raises(GateError):
        inc.refresh(frame(spark, rows), base, "g", lambda df: totals([])(df).unionAll(totals([])(df)))
    inc.refresh(frame(spark, rows), base, "g", totals(seen))
    assert seen[1:] == [["b"]] and set(held(spark, base)) == {"a", "b"}


def test_next_stage_follows(spark, tmp_path):
    """A group that moves makes its old and its new category anew, no other; a category that is left empty goes."""
    one, two, seen, cats = f"{tmp_path}/one", f"{tmp_path}/two", [], []

    def by_category(df):
        cats.append(sorted(r.cat for r in df.select("cat").distinct().collect()))
        return df.groupBy("cat").agg(F.sum("words").alias("words"))

    def both(rows):
        run = inc.refresh(frame(spark, rows), one, "g", totals(seen))
        inc.refresh(inc.results(spark, one), two, "cat", by_category, within=inc.affected(spark, one, run, "g", "cat"))
        return {r.cat: r.words for r in inc.results(spark, two).collect()}

    rows = [("p1", "a", "x", 1), ("p2", "b", "y", 2), ("p3", "c", "z", 4), ("p4", "d", "z", 8)]
    assert both(rows) == {"x": 1, "y": 2, "z": 12}
    rows[0] = ("p1", "a", "y", 1)
    assert both(rows) == {"y": 3, "z": 12} and cats[1:] == [["y"]]
    assert both(rows[:3]) == {"y": 3, "z": 4} and cats[2:] == [["z"]]
    assert both(rows[:3]) == {"y": 3, "z": 4} and len(cats) == 3
