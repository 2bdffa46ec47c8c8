"""Versioned state: crashes, two writers, repeated batches, and what a merge rewrites."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators.relational import GateError
from gaugeworks.sources import sinks, state
from gaugeworks.streaming import captures


def rows(spark, base):
    return {r.k: (r.at, r.v) for r in state.read(spark, base).collect()}


def frame(spark, keys, at, v):
    return spark.createDataFrame([(k, at, v) for k in keys], "k long, at long, v string")


class Crash(Exception):
    pass


def crash():
    raise Crash


def test_crash_before_the_commit_loses_nothing(spark, tmp_path):
    base = f"{tmp_path}/s"
    with pytest.raises(Crash):
        state.merge(frame(spark, range(10), 1, "a"), base, "k", "at", before_commit=crash)
    assert state.latest(spark, base) is None
    state.merge(frame(spark, range(10), 1, "a"), base, "k", "at")
    with pytest.raises(Crash):
        state.merge(frame(spark, range(5, 15), 2, "b"), base, "k", "at", before_commit=crash)
    assert rows(spark, base) == dict.fromkeys(range(10), (1, "a"))
    assert state.merge(frame(spark, range(5, 15), 2, "b"), base, "k", "at") == 1
    assert rows(spark, base) == dict.fromkeys(range(5), (1, "a")) | dict.fromkeys(range(5, 15), (2, "b"))


def test_crash_while_a_manifest_is_put(spark, tmp_path, monkeypatch):
    """A draft that was never put in its place counts for nothing."""
    base = f"{tmp_path}/s"
    state.merge(frame(spark, [1], 1, "a"), base, "k", "at")
    (tmp_path / "s" / "log" / f"{1:020d}.json.0.draft").write_text('{"half')
    assert rows(spark, base) == {1: (1, "a")}
    assert state.merge(frame(spark, [2], 1, "a"), base, "k", "at") == 1 and set(rows(spark, base)) == {1, 2}


def test_two_writers(spark, tmp_path):
    """Both start from one version; the second to commit merges again, and no row of either is lost."""
    base = f"{tmp_path}/s"
    state.merge(frame(spark, range(4), 1, "a"), base, "k", "at")
    first = []

    def other():
        if not first:
            first.append(state.merge(frame(spark, [2, 7], 3, "other"), base, "k", "at"))

    assert state.merge(frame(spark, [2, 3, 8], 2, "mine"), base, "k", "at", before_commit=other) == 2 and first == [1]
    assert rows(spark, base) == {0: (1, "a"), 1: (1, "a"), 2: (3, "other"), 3: (2, "mine"), 7: (3, "other"), 8: (2, "mine")}


def test_writers_at_once(spark, tmp_path):
    base, errors = f"{tmp_path}/s", []

    def write(i):
        try:
            state.merge(frame(spark, range(i * 10, i * 10 + 12), i, str(i)), base, "k", "at")
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and state.latest(spark, base)["version"] == 3
    assert rows(spark, base) == {k: (i, str(i)) for i in range(4) for k in range(i * 10, i * 10 + 12)}


def test_replace_knows_of_commits_in_between(spark, tmp_path):
    base = f"{tmp_path}/s"
    sinks.write_version(frame(spark, [1], 1, "a"), base)
    seen = state.latest(spark, base)["version"]
    sinks.write_version(frame(spark, [2], 1, "a"), base, read_version=seen)
    with pytest.raises(GateError):
        sinks.write_version(frame(spark, [3], 1, "a"), base, read_version=seen)
    assert set(rows(spark, base)) == {2}
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "current").write_text("x")
    with pytest.raises(GateError):
        state.latest(spark, f"{tmp_path}/old")


@pytest.mark.parametrize("kind", ["long", "string"])
def test_a_small_batch_rewrites_a_small_part(spark, tmp_path, kind):
    base = f"{tmp_path}/s"
    key = F.col("id") if kind == "long" else F.format_string("%06d", "id")
    whole = spark.range(10_000).select(key.alias("k"), F.lit(1).alias("at"), F.lit("a").alias("v"))
    state.merge(whole, base, "k", "at", range_rows=100)
    before = state.latest(spark, base)["ranges"]
    assert 60 <= len(before) <= 140 and sum(r["rows"] for r in before) == 10_000
    new = spark.range(4200, 4300).select(key.alias("k"), F.lit(2).alias("at"), F.lit("b").alias("v"))
    state.merge(new, base, "k", "at", range_rows=100)
    after = state.latest(spark, base)["ranges"]
    kept = {r["path"] for r in before} & {r["path"] for r in after}
    assert len(kept) >= len(before) - 4
    got = state.read(spark, base)
    assert got.count() == 10_000 and got.where("v = 'b'").count() == 100 and got.select("k").distinct().count() == 10_000
    assert [r["low"] for r in after[1:]] == sorted(r["low"] for r in after[1:])


def test_ranges_grow_and_nulls_stay(spark, tmp_path):
    base = f"{tmp_path}/s"
    want = {}
    for n in range(6):
        batch = [*range(n * 40, n * 40 + 60), None]
        state.merge(frame(spark, batch, n, str(n)), base, "k", "at", range_rows=20)
        want |= dict.fromkeys(batch, (n, str(n)))
        assert rows(spark, base) == want
    assert len(state.latest(spark, base)["ranges"]) > 6
    state.merge(frame(spark, [], 9, "x"), base, "k", "at")
    assert rows(spark, base) == want


def test_repeated_micro_batch_is_skipped(spark, tmp_path):
    base = f"{tmp_path}/s"
    assert state.merge(frame(spark, [1], 1, "a"), base, "k", "at", writer="w", batch_id=0) == 0
    assert state.merge(frame(spark, [1], 5, "again"), base, "k", "at", writer="w", batch_id=0) == 0
    assert rows(spark, base) == {1: (1, "a")}


def test_stream_restarts_after_a_crash(spark, tmp_path, monkeypatch):
    """The commit is made, the checkpoint isn't: the batch comes again and changes nothing; what comes later is merged."""
    (tmp_path / "in").mkdir()
    base, schema, real = f"{tmp_path}/state", "k string, at long, v string", state.merge
    put = lambda n, data: (tmp_path / "in" / f"{n}.json").write_text("\n".join(json.dumps(dict(zip(("k", "at", "v"), r))) for r in data))
    run = lambda: captures.upsert_into(captures.capture_stream(spark, f"{tmp_path}/in", schema), base, "k", "at", f"{tmp_path}/cp").awaitTermination()
    put(0, [("a", 1, "x"), ("b", 1, "y")])

    def once(*args, **how):
        real(*args, **how)
        raise Crash

    monkeypatch.setattr(state, "merge", once)
    with pytest.raises(Exception, match="Crash"):
        run()
    monkeypatch.setattr(state, "merge", real)
    put(1, [("a", 2, "z")])
    run()
    run()
    assert rows(spark, base) == {"a": (2, "z"), "b": (1, "y")}
