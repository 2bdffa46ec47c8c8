"""Connected components by randomised contraction, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import durable


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge list (a, b): longs, any order, repeats and loops allowed.

    Each round hooks a node to the neighbour that precedes it most in a total order (every other
    round by degree, so stars collapse at once; else a fresh random order, so chains halve), then
    contracts the edges.  A node's parent always precedes it, so no cycle can form.  Rounds grow
    with the logarithm of the largest component; nothing is collected but an emptiness flag.
    An empty edge list gives an empty result.
    """
    live = durable(edges.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds: list[DataFrame] = []
    while not live.isEmpty():
        both = live.unionAll(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if len(rounds) % 2 == 0:
            degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
            ranked = both.join(degree.select(F.col("a").alias("b"), (-F.col("n")).alias("rank")), "b").groupBy("a").agg(F.min(F.struct("rank", F.xxhash64("b").alias("tie"), F.col("b").alias("node"))).alias("best"), (-F.count(F.lit(1))).alias("own"))
        else:
            salt = F.lit(len(rounds))
            ranked = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", salt).alias("rank"), F.xxhash64("b").alias("tie"), F.col("b").alias("node"))).alias("best")).withColumn("own", F.xxhash64("a", salt))
        mine = F.struct(F.col("own").alias("rank"), F.xxhash64("a").alias("tie"), F.col("a").alias("node"))
        hook = durable(ranked.select(F.col("a").alias("node"), F.least(F.col("best"), mine).getField("node").alias("parent")))
        rounds.append(hook)
        to = lambda side, name: hook.select(F.col("node").alias(side), F.col("parent").alias(name))
        live = durable(live.join(to("a", "x"), "a").join(to("b", "y"), "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not rounds:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[-1].withColumnRenamed("parent", "root")
    for hook in reversed(rounds[:-1]):
        upper = found.select(F.col("node").alias("parent"), "root")
        found = hook.join(upper, "parent", "left").select("node", F.coalesce("root", "parent").alias("root"))
    return durable(found)
