"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Java and Python both read this class as the six ASCII white-space characters.
WS_CLASS = r"[\x09-\x0D ]"
WS_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only where none is set and all runs on one machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="gaugeworks-"))
    return sc.getCheckpointDir().rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Writes a frame as Parquet into the shared folder and reads it back.

    The result has no lineage beyond those files, so a lost executor costs a re-read and not a
    recomputation, and a non-deterministic input can't change between two uses.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/gaugeworks-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def fold(col: str, modulus: int) -> F.Column:
    """crc32 of the id as text, modulo: the documented train / held-out split."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(modulus)


def bounded_sample(rows: DataFrame, limit: int, key: str, by: str | None = None) -> DataFrame:
    """At most `limit` rows, or as many of each value of `by`: those of the smallest `key`, a hash.  A documented bound for model fitting.

    Rows are counted first (a number for each value of `by` goes to the driver), and only those below a threshold
    that lets a few more than `limit` through are dealt out and sorted.
    """
    group = F.col(by) if by else F.lit(0)
    sizes = {r.v: r.n for r in rows.groupBy(group.alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {v: min(1.0, (limit + 6 * limit**0.5 + 20) / n) for v, n in sizes.items() if v is not None}
    if not share:
        return rows.limit(0)
    below = F.element_at(F.create_map(*[x for v, p in share.items() for x in (F.lit(v), F.lit(p * 2.0**64 - 2.0**63))]), group)
    rank = F.row_number().over(Window.partitionBy("_by").orderBy(key))
    return rows.where(F.col(key).cast("double") <= below).withColumn("_by", group).withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_by", "_rank")


def whole_rows(docs: DataFrame) -> DataFrame:
    """One column `_all` with all of a row's, so that working columns can't clash with any of the input's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all"))


def field(name: str) -> F.Column:
    return F.col("_all")[name]
