"""Ordered operators: runs, sections, regions, first occurrences, neighbours, streaks.

All partition by an entity (page, user, file), so windows are as large as one entity's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _upto(by: Sequence[str], order: Sequence[str], last: int = 0):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)


def rle(df: DataFrame, by: Sequence[str], order: Sequence[str], token: str, flag: str | None = None) -> DataFrame:
    """Runs of equal tokens: by, run (from 0), token, n, and the run's flags in order."""
    w = Window.partitionBy(*by).orderBy(*order)
    before = F.lag(F.struct(F.col(token))).over(w)
    new = (before.isNull() | ~before[token].eqNullSafe(F.col(token))).cast("long")
    runs = df.withColumn("_new", new).withColumn("run", F.sum("_new").over(_upto(by, order)) - 1)
    aggs = [F.first(token).alias(token), F.count(F.lit(1)).alias("n")]
    if flag:
        aggs.append(F.transform(F.array_sort(F.collect_list(F.struct(*order, flag))), lambda x: x[flag]).alias("flags"))
    return runs.groupBy(*by, "run").agg(*aggs)


def sectionise(df: DataFrame, by: Sequence[str], order: Sequence[str], opens: Column, name: str = "section") -> DataFrame:
    """Section number: rows before the first opener are 0, each opener starts the next."""
    return df.withColumn("_opens", F.coalesce(opens, F.lit(False)).cast("long")).withColumn(name, F.sum("_opens").over(_upto(by, order))).drop("_opens")


def region(df: DataFrame, by: Sequence[str], order: Sequence[str], starts: Column, ends: Column, name: str = "inside", before: bool = False) -> DataFrame:
    """Whether the last marker up to the row (or before it) is a start."""
    mark = F.when(starts, F.lit(1)).when(ends, F.lit(0))
    state = F.last("_mark", ignorenulls=True).over(_upto(by, order, -1 if before else 0))
    return df.withColumn("_mark", mark).withColumn(name, F.coalesce(state, F.lit(0)) == 1).drop("_mark")


def first_occurrence(df: DataFrame, by: Sequence[str], order: Sequence[str], token: str) -> DataFrame:
    """The first row of each token in each entity."""
    w = Window.partitionBy(*by, token).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def ordered_distinct(df: DataFrame, by: Sequence[str], order: Sequence[str], token: str, name: str = "tokens") -> DataFrame:
    """Distinct tokens of each entity in order of their first row: two aggregates, no window."""
    firsts = df.groupBy(*by, token).agg(F.min(F.struct(*order)).alias("_at"))
    return firsts.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", token))), lambda x: x[token]).alias(name))


def reindex(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "index") -> DataFrame:
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("long"))


def drag_fill(df: DataFrame, file: str, row: str, category: str, values: Sequence[str], least: int = 2, step: float = 1.0) -> DataFrame:
    """Rows of which `least` values are exactly `step` over the row above in the file, if that is of the same category.  `row` orders a file's rows."""
    df = row_above(df, [file], [row], [category, *values], "_above")
    hits = F.filter(F.array(*[F.when(F.col(v) - F.col("_above")[v] == step, F.lit(v)) for v in values]), lambda x: x.isNotNull())
    return df.where(F.col("_above")[category] == F.col(category)).withColumn("hits", hits).where(F.size("hits") >= least).drop("_above")


def row_above(df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str], name: str = "above") -> DataFrame:
    """Adds a struct of the columns of the row above in the order (nulls first) of an entity, null for its first row.  An entity may have any number of rows.

    Rows are dealt out once, by ranges of (by, order) between keys of a sample; the last row of each range, a halo, goes
    to the next range too, so `lag` within a range is that over the whole.  Those last rows are as few as the ranges.
    """
    key = F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate([*by, *order])])
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_all"), key.alias("_key"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_own"))
    bounds = _bounds(rows)
    part = F.lit(0)
    if bounds is not None:
        part = _bounds_up_to(F.col("_bounds"), F.col("_key"))
        rows = rows.crossJoin(F.broadcast(bounds))  # one row with at most HALO_RANGES keys
    rows = rows.select("_all", "_key", "_own", part.alias("_part"))
    if bounds is not None:
        edges = rows.groupBy("_part").agg(F.max_by(F.struct("_key", "_own"), "_key").alias("_edge"))
        edges = edges.withColumn("_next", F.lead("_part").over(Window.orderBy("_part"))).where("_next is not null")
        rows = rows.unionByName(edges.select(F.lit(None).cast(df.sparkSession.createDataFrame([], rows.schema).schema["_all"].dataType).alias("_all"), F.col("_edge._key").alias("_key"), F.col("_edge._own").alias("_own"), F.col("_next").alias("_part")))
    w = Window.partitionBy("_part").orderBy("_key")
    same = F.lit(True)
    for i in range(len(by)):
        same = same & F.col("_before._key")[f"k{i}"].eqNullSafe(F.col("_key")[f"k{i}"])
    seen = rows.withColumn("_before", F.lag(F.struct("_key", "_own")).over(w)).where("_all is not null")
    above = F.when(same, F.col("_before._own"))
    return seen.select(*[F.col("_all")[c].alias(c) for c in df.columns if c != name], above.alias(name))


#: Ranges of `row_above` at most, and keys of the sample that bounds them.
HALO_RANGES, HALO_SAMPLE = 1000, 50_000


def _bounds_up_to(bounds: Column, key: Column) -> Column:
    """How many of the sorted bounds are at most the key, by halving."""

    def step(s: Column, _: Column) -> Column:
        mid = F.shiftright(s.low + s.high, 1)
        here = F.get(bounds, mid) <= key
        return F.when(s.low >= s.high, s).when(here, F.struct((mid + 1).alias("low"), s.high.alias("high"))).otherwise(F.struct(s.low.alias("low"), mid.alias("high")))

    halvings = F.sequence(F.lit(1), F.lit(HALO_RANGES.bit_length()))
    return F.aggregate(halvings, F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high")), step, lambda s: s.low)


def _bounds(rows: DataFrame) -> DataFrame | None:
    """One row, an array `_bounds` of the keys that part the ranges, in order; None where one range will do."""
    n = rows.count()
    parts = min(HALO_RANGES, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // max(1, HALO_SAMPLE // 100))
    if parts < 2:
        return None
    sample = rows.where(F.pmod(F.xxhash64("_key"), F.lit(max(1, n // HALO_SAMPLE))) == 0).select("_key")
    keys = sample.agg(F.sort_array(F.collect_list("_key")).alias("_k"))
    every = F.greatest(F.lit(1), F.floor(F.size("_k") / parts).cast("int"))
    return keys.select(F.array_distinct(F.filter("_k", lambda x, i: (i % every == 0) & (i > 0))).alias("_bounds"))


def streaks(df: DataFrame, by: Sequence[str], order: Sequence[str], fails: Column, least: int = 2) -> DataFrame:
    """Runs of `least` or more failures in a row: by, run, n."""
    marked = df.withColumn("_fails", F.coalesce(fails, F.lit(False)))
    return rle(marked, by, order, "_fails").where(F.col("_fails") & (F.col("n") >= least)).drop("_fails")


def two_strikes(df: DataFrame, by: Sequence[str], order: Sequence[str], fails: Column, most: int = 2) -> DataFrame:
    """The rows that a breaker lets run: those up to the `most`-th failure in a row."""
    w = Window.partitionBy(*by).orderBy(*order)
    bad = F.coalesce(fails, F.lit(False))
    last = [F.coalesce(F.lag("_bad", k).over(w), F.lit(False)) for k in range(1, most + 1)]
    tripped = last[0]
    for x in last[1:]:
        tripped = tripped & x
    df = df.withColumn("_bad", bad).withColumn("_tripped", tripped.cast("int")).withColumn("_stopped", F.max("_tripped").over(_upto(by, order)))
    return df.where("_stopped = 0").drop("_bad", "_tripped", "_stopped")


def while_progress(df: DataFrame, by: Sequence[str], order: Sequence[str], done: str, total: str, most: int = 12) -> DataFrame:
    """The runs that are made: those of each entity until all is done, one gets no further than the one before, or there were `most`."""
    w = Window.partitionBy(*by).orderBy(*order)
    now, last = F.coalesce(F.col(done), F.lit(0)), F.coalesce(F.lag(F.coalesce(F.col(done), F.lit(0))).over(w), F.lit(0))
    ends = (now <= last) | (now >= F.coalesce(F.col(total), F.lit(0)))
    df = df.withColumn("_ends", ends.cast("int")).withColumn("_run", F.row_number().over(w))
    df = df.withColumn("_stopped", F.coalesce(F.max("_ends").over(_upto(by, order, -1)), F.lit(0)))
    return df.where((F.col("_stopped") == 0) & (F.col("_run") <= most)).drop("_ends", "_run", "_stopped")
