"""Sessions, the shared folder, and materialised frames."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "gaugeworks", **conf: str) -> SparkSession:
    """UTC, adaptive execution and skew joins; anything else as the cluster has it."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where none is set and all runs on one machine, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="gaugeworks-"))
    return sc.getCheckpointDir().rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """The frame from Parquet files in the shared folder: fixed rows and no lineage beyond the files."""
    path = f"{shared_dir(df.sparkSession)}/frame-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
