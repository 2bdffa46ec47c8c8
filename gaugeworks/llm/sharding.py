"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0 to N - 1 in the order of their columns, and a keyed permutation of these numbers shuffles them: place
P(r) is slot P(r) div S of shard P(r) mod S.  So the counts of the S shards are at most one apart, slots have no gaps,
and both follow from a row number, N, S and the seed alone (`locate`), as does the row number from them (`row_at`):
no row is looked at to find another, and the same table gives the same shards on any cluster.

The permutation is a Feistel network over pairs (l, r) of a grid of a x b cells, a = ceil(sqrt(N)), b = ceil(N / a): rounds add
to l and r in turn, modulo a and b, a hash of the other.  The grid has fewer than a cells beyond N; a place there is
permuted on until it is below N (cycle walking), which keeps the whole a permutation of 0 to N - 1.

Equal rows can't be told apart, so they are counted first and numbered as one range; a row that repeats without bound is neither one sort
key of many rows nor one long array.  The counted rows are sorted by ranges and numbered by partial sums of the partitions.

Edge cases: a null text has size 16 and CRC 0, like an empty one; a null id sorts last; long texts are hashed whole, in the JVM;
ties and repeated rows each get a place of their own; fewer rows than shards leave shards empty; an empty table
gives an empty result; in `assign` the columns row_number, shard and slot are made anew, all other columns stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import durable, field, whole_rows

SHARDS, SEED, ROUNDS = 40, 20_240_607, 6
#: A prime below 2^31, so that all products stay below 2^62.
PRIME = (1 << 31) - 1
#: Equal rows that are numbered in one step of two.
RUN = 1 << 16


def round_keys(seed: int) -> list[tuple[int, int]]:
    """A factor and a summand for each round: a linear congruential sequence from the seed."""
    x, keys = seed % PRIME, []
    for _ in range(ROUNDS):
        pair = []
        for _ in range(2):
            x = (x * 48_271 + 11) % PRIME
            pair.append(1 + x % (PRIME - 1))
        keys.append((pair[0], pair[1]))
    return keys


def grid(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _mixed(x: np.ndarray, key: tuple[int, int]) -> np.ndarray:
    """A hash of a number below 2^31: linear, then squared, modulo PRIME."""
    y = (x % PRIME * key[0] + key[1]) % PRIME
    return (y * y + key[1]) % PRIME


def _once(x: np.ndarray, n: int, keys: list[tuple[int, int]]) -> np.ndarray:
    a, b = grid(n)
    left, right = x // b, x % b
    for i, key in enumerate(keys):
        if i % 2 == 0:
            left = (left + _mixed(right, key)) % a
        else:
            right = (right + _mixed(left, key)) % b
    return left * b + right


def _back(x: np.ndarray, n: int, keys: list[tuple[int, int]]) -> np.ndarray:
    a, b = grid(n)
    left, right = x // b, x % b
    for i, key in reversed(list(enumerate(keys))):
        if i % 2 == 0:
            left = (left - _mixed(right, key)) % a
        else:
            right = (right - _mixed(left, key)) % b
    return left * b + right


def _walked(step, x: np.ndarray, n: int, seed: int) -> np.ndarray:
    if n > 1 << 60:
        raise ValueError("at most 2^60 rows")
    keys = round_keys(seed)
    out = step(np.asarray(x, np.int64), n, keys)
    while len(beyond := np.flatnonzero(out >= n)):
        out[beyond] = step(out[beyond], n, keys)
    return out


def permute(x: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """The places of row numbers below n."""
    return _walked(_once, x, n, seed)


def unpermute(x: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """The row numbers at places below n."""
    return _walked(_back, x, n, seed)


def locate(row: np.ndarray, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of row numbers."""
    place = permute(row, n, seed)
    return place % shards, place // shards


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """Row numbers at slots of shards; what a loader needs to read a shard, or any part of it, by row number."""
    return unpermute(np.asarray(slot, np.int64) * shards + np.asarray(shard, np.int64), n, seed)


def numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows with `row_number`, 0 to N - 1 in the order of their columns (nulls last), and N.

    The distinct rows and their numbers are written once; so is their sort, whose partitions are
    then numbered by their sums, of which there are as many as partitions.
    """
    names = rows.columns
    counted = durable(whole_rows(rows).groupBy("_all").agg(F.count(F.lit(1)).alias("_n")))
    order = [F.asc_nulls_last(field(c)) for c in names]
    placed = durable(counted.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sums = {r.p: r.n for r in placed.groupBy(part.alias("p")).agg(F.sum("_n").alias("n")).collect()}
    first, before = {}, 0
    for p in sorted(sums):
        first[p], before = before, before + sums[p]
    if not before:
        return rows.withColumn("row_number", F.lit(0).cast("long")), 0
    starts = rows.sparkSession.createDataFrame(list(first.items()), "_part long, _first long")
    own = F.sum("_n").over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    at = placed.withColumn("_part", part).withColumn("_own", own).join(F.broadcast(starts), "_part").withColumn("_start", F.col("_first") + F.col("_own"))
    last = F.col("_start") + F.col("_n") - 1
    runs = at.select("_all", last.alias("_last"), F.explode(F.sequence("_start", last, F.lit(RUN))).alias("_from"))
    each = runs.select("_all", F.explode(F.sequence("_from", F.least("_last", F.col("_from") + RUN - 1))).alias("row_number"))
    return each.select(*[field(c).alias(c) for c in names if c != "row_number"], "row_number"), before


def assign(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All rows with row_number, shard and slot.  Rows should be narrow (ids, sizes, hashes): their columns are sorted by."""
    found, n = numbered(rows.drop("row_number", "shard", "slot"))

    def places(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(permute(x.to_numpy(), n, seed))

    place = F.pandas_udf(places, "long")
    return found.withColumn("_place", place("row_number")).withColumns({"shard": (F.col("_place") % shards).cast("int"), "slot": F.expr(f"_place div {int(shards)}")}).drop("_place")


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_crc32, size, row_number, shard, slot) of every document; size is its UTF-8 bytes plus 16."""
    raw = F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "UTF-8")
    return assign(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.crc32(raw).alias("text_crc32"), (F.octet_length(raw) + 16).cast("long").alias("size")), shards, seed)
