"""Results by group that are made again only where the group's content changed.

A group's fingerprint is a sum over its rows' hashes, so it doesn't depend on their order and is
aggregated before the shuffle, however large the group.  Results are kept, with the fingerprint that they were made from, in
a state table of key ranges; a run compares fingerprints, computes the groups that differ and merges them in one
commit.  A crash before the commit leaves the earlier results.  Groups that went have an entry without
a fingerprint, so the next stage can learn of them.

The next stage need not look at everything: `affected` names its keys for the groups that a run touched, as they
are now and as they were before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.relational import GateError
from gaugeworks.session import materialise
from gaugeworks.sources import state

RUN, PRINT, GONE = "_run", "_print", "_gone"


@dataclass(frozen=True)
class Refreshed:
    """What a run did: table versions before (None: there was none) and after; touched: (key, change, done), a row for each group that wasn't up to date.

    change is new, changed, again (asked for) or gone; done is false where the computation returned no row, so that the group comes again.
    """

    before: int | None
    version: int | None
    touched: DataFrame


def fingerprints(rows: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(key, _print) of each group; repeated rows count.  `columns`: those that matter, all others than the key by default."""
    used = sorted(columns if columns is not None else set(rows.columns) - {key}) or [key]
    whole = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in used]), {"ignoreNullFields": "false"}))
    part = lambda at: F.sum(F.conv(F.substring("_h", at, 15), 16, 10).cast("decimal(20,0)")).cast("string")
    hashed = rows.where(F.col(key).isNotNull()).select(key, whole.alias("_h"))
    return hashed.groupBy(key).agg(F.concat_ws("-", F.count(F.lit(1)).cast("string"), part(1), part(16)).alias(PRINT))


def results(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The results of all groups, of the newest version or an earlier one."""
    body = state.latest(spark, base) if version is None else state.manifest(spark, base, version)
    if body is None:
        raise GateError(f"{base} has no version")
    return state.rows_of(spark, base, body, body["ranges"]).where(~F.col(GONE)).drop(RUN, PRINT, GONE)


def refresh(rows: DataFrame, base: str, key: str, compute: Callable[[DataFrame], DataFrame], columns: Sequence[str] | None = None, only=None, again: bool = False, within: DataFrame | None = None, range_rows: int = state.RANGE_ROWS) -> Refreshed:
    """Brings the results at `base` up to date with `rows`.

    `compute` gets the rows of the groups to make and returns one row for each, with the key.  only: one group by name, which
    must exist.  again: groups that are up to date are made too.  within: a frame of the keys to look at; of all
    others nothing is read, said or changed.  Rows without a key belong to no group.
    """
    spark = rows.sparkSession
    now = state.latest(spark, base)

    def part(df: DataFrame) -> DataFrame:
        df = df.where(F.col(key).isNotNull()) if only is None else df.where(F.col(key) == F.lit(only))
        return df if within is None else df.join(within.select(key).distinct(), key, "left_semi")

    mine = part(rows)
    if only is not None and mine.isEmpty():
        raise GateError(f"unknown group: {only}")
    new = fingerprints(mine, key, columns).withColumnRenamed(PRINT, "_new")
    if now:
        old = part(state.rows_of(spark, base, now, now["ranges"]).select(key, F.col(PRINT).alias("_old")))
    else:
        old = new.where("false").select(key, F.col("_new").alias("_old"))
    is_new, is_old = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    change = F.when(is_old & ~is_new, "gone").when(is_new & ~is_old, "new").when(F.col("_new") != F.col("_old"), "changed").when(is_new & F.lit(again), "again")
    found = materialise(new.join(old, key, "full").select(key, change.alias("change"), F.col("_new").alias(PRINT)).where("change is not null"))
    if found.isEmpty():
        return Refreshed(now["version"] if now else None, now["version"] if now else None, found.select(key, "change", F.lit(True).alias("done")))
    todo = found.where("change <> 'gone'")
    made = materialise(compute(mine.join(todo.select(key), key, "left_semi")))
    twice = [r[0] for r in made.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").orderBy(key).limit(20).select(key).collect()]
    if twice:
        raise GateError(f"several results for {twice}")
    number = now["version"] + 1 if now else 0
    batch = made.join(todo.select(key, PRINT), key).withColumn(GONE, F.lit(False))
    gone = found.where("change = 'gone'").select(key, PRINT, F.lit(True).alias(GONE))
    batch = batch.unionByName(gone, allowMissingColumns=True).withColumn(RUN, F.lit(number).cast("long"))
    version = state.merge(batch, base, key, RUN, range_rows=range_rows)
    done = found.join(made.select(key, F.lit(True).alias("_made")), key, "left")
    return Refreshed(now["version"] if now else None, version, done.select(key, "change", (F.col("_made").isNotNull() | (F.col("change") == "gone")).alias("done")))


def affected(spark: SparkSession, base: str, run: Refreshed, key: str, down: str) -> DataFrame:
    """(down): the next stage's keys of the groups that a run touched, those that the groups had before among them."""
    versions = [v for v in dict.fromkeys((run.before, run.version)) if v is not None]
    keys, out = run.touched.where("done").select(key), None
    for v in versions:
        own = results(spark, base, v).join(keys, key, "left_semi").select(down)
        out = own if out is None else out.unionAll(own)
    return (keys.select(F.col(key).alias(down)).where("false") if out is None else out).where(F.col(down).isNotNull()).distinct()
