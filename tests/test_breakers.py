"""Streamed breakers against the whole table, for any split into micro-batches and over a restart."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import sequence
from gaugeworks.plans import pdp
from gaugeworks.streaming import breakers

SCHEMA = "who string, n long, status string, done long, total long"


def table(rng):
    rows = []
    for who in "abcdefg":
        done = 0
        for n in range(rng.randint(1, 18)):
            done += rng.choice([0, 1, 2, 3, 3, 3])
            rows.append((n, rng.random(), {"who": who, "n": n, "status": rng.choice(["ok", "ok", "error", None]), "done": done, "total": 14}))
    return [r for *_, r in sorted(rows, key=lambda r: r[:2])]  # entities interleave, each in its order


def streamed(spark, tmp_path, parts, make):
    """Runs the files of some parts, stops, and goes on with the others from the checkpoint."""
    folder = tmp_path / "in"
    folder.mkdir()
    out, cp = f"{tmp_path}/out", f"{tmp_path}/cp"
    half = len(parts) // 2
    for n0, chunk in ((0, parts[:half]), (half, parts[half:])):
        for n, rows in enumerate(chunk):
            (folder / f"{n0 + n:04d}.json").write_text("\n".join(map(json.dumps, rows)))
            time.sleep(0.02)  # files are read in order of their time
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
        make(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()
    return sorted(map(str, spark.read.schema(SCHEMA).parquet(out).collect()))


def split(rng, rows, most):
    parts = []
    while rows:
        k = rng.randint(1, most)
        parts.append(rng.sample(rows[:k], len(rows[:k])))  # in any order within a part
        rows = rows[k:]
    return parts


@pytest.mark.parametrize("seed,most", [(1, 30), (2, 60)])
def test_two_strikes(spark, tmp_path, seed, most):
    rng = random.Random(seed)
    rows = table(rng)
    fails = F.col("status") == "error"
    got = streamed(spark, tmp_path, split(rng, rows, most), lambda s: breakers.two_strikes(s, ["who"], ["n"], fails))
    whole = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    want = sequence.two_strikes(whole, ["who"], ["n"], fails)
    assert got == sorted(map(str, want.collect())) and len(got) < len(rows)


def test_while_progress(spark, tmp_path):
    rng = random.Random(7)
    rows = table(rng)
    got = streamed(spark, tmp_path, split(rng, rows, 40), lambda s: breakers.while_progress(s, ["who"], ["n"], "done", "total", most=9))
    want = sequence.while_progress(spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA), ["who"], ["n"], "done", "total", most=9).collect()
    assert got == sorted(map(str, want))
    runs = {}
    for r in want:
        runs[r.who] = runs.get(r.who, 0) + 1
    for who in "abcdefg":
        assert runs[who] == pdp.batch_runs(14, [r["done"] for r in rows if r["who"] == who], most=9)


def test_a_timer_closes_a_tripped_breaker(spark, tmp_path):
    """With processing-time timers a query runs on until it is stopped."""
    bad = lambda n: json.dumps({"who": "a", "n": n, "status": "error", "done": 0, "total": 1})
    folder, out = tmp_path / "in", f"{tmp_path}/out"
    folder.mkdir()
    (folder / "0.json").write_text("\n".join(map(bad, range(3))))
    stream = breakers.two_strikes(spark.readStream.schema(SCHEMA).json(str(folder)), ["who"], ["n"], F.col("status") == "error", reset_ms=1)
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="200 milliseconds").start()

    def seen(n):
        end = time.time() + 40
        while time.time() < end and query.exception() is None:
            if (tmp_path / "out" / "_spark_metadata").exists() and n in {r.n for r in spark.read.schema(SCHEMA).parquet(out).collect()}:
                return True
            time.sleep(0.5)
        return False

    try:
        assert seen(1)
        time.sleep(2)  # the timer runs off
        (folder / "1.json").write_text(bad(3))
        assert seen(3)
    finally:
        query.stop()
    assert sorted(r.n for r in spark.read.schema(SCHEMA).parquet(out).collect()) == [0, 1, 3]
