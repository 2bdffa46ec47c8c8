"""State tables that are updated in place of key ranges, with numbered commits that no crash and no second writer can lose.

A table is a folder: `data` has the rows, in a folder for each commit and key range; `log` has a manifest for each commit, numbered without
gaps, that names the ranges' first keys and folders.  A manifest is written whole under another name and then
put in its place, which fails if the number is taken (a hard link on a local disk, a rename without overwriting elsewhere).  So
the table is what the highest manifest says: a writer that dies before leaves files that nothing names, and of
two writers one fails and merges again with what the other wrote.

A merge rewrites the ranges that its keys fall into and no other; a range that outgrows its target is split at keys of
a sample.  Old versions stay readable until someone clears them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.relational import GateError
from gaugeworks.session import materialise

#: Rows of a key range, about; a range of over twice as many is split.
RANGE_ROWS = 1_000_000
#: Keys of a range's sample.
SAMPLE = 1000


def _at(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Puts a whole file where there is none; False if there is one."""
    target, fs = _at(spark, path)
    draft, _ = _at(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    out.write(text.encode())
    out.close()
    try:
        if fs.getScheme() == "file":
            local = lambda p: spark._jvm.java.io.File(p.toUri().getPath()).toPath()
            spark._jvm.java.nio.file.Files.createLink(local(target), local(draft))
        else:
            files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
            files.rename(draft, target, spark._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName() or fs.exists(target):
            return False
        raise
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)
    return True


def manifest(spark: SparkSession, base: str, version: int) -> dict:
    """The manifest of a commit."""
    return {"version": version, **json.loads(spark.read.text(f"{base}/log/{version:020d}.json", wholetext=True).first().value)}


def latest(spark: SparkSession, base: str) -> dict | None:
    """The manifest of the highest commit; None if there is no table.  A folder with data but no log is an error, not an empty table."""
    log, fs = _at(spark, f"{base}/log")
    names = [s.getPath().getName() for s in fs.listStatus(log)] if fs.exists(log) else []
    numbers = [int(n[:-5]) for n in names if n.endswith(".json")]
    if not numbers:
        if fs.exists(_at(spark, f"{base}/current")[0]):
            raise GateError(f"{base} is not a state table with a log")
        return None
    return manifest(spark, base, max(numbers))


def commit(spark: SparkSession, base: str, now: dict | None, body: dict) -> bool:
    """Makes `body` the version after `now`; False if another writer was first."""
    return put_new(spark, f"{base}/log/{now['version'] + 1 if now else 0:020d}.json", json.dumps(body))


def rows_of(spark: SparkSession, base: str, body: dict, ranges: list[dict]) -> DataFrame:
    paths = [f"{base}/{p}" for p in dict.fromkeys(r["path"] for r in ranges if r["path"])]
    schema = T.StructType.fromJson(body["schema"])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, base: str) -> DataFrame:
    body = latest(spark, base)
    if body is None:
        raise GateError(f"{base} has no version")
    return rows_of(spark, base, body, body["ranges"])


def replace(df: DataFrame, base: str, read_version: int | None = None) -> int:
    """Writes a whole new version.  With `read_version`, the one that the rows were made from, a commit in between is an error."""
    spark, path = df.sparkSession, f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{base}/{path}")
    while True:
        now = latest(spark, base)
        if read_version is not None and (now or {"version": -1})["version"] != read_version:
            raise GateError(f"{base} was changed since version {read_version}")
        body = {"schema": json.loads(df.schema.json()), "ranges": [{"low": None, "rows": None, "path": path}], "writers": now["writers"] if now else {}}
        if commit(spark, base, now, body):
            return now["version"] + 1 if now else 0


def last_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by `order`."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*").select(*df.columns)


def _comparable(df: DataFrame, key: str) -> Column:
    """Keys as whole numbers or texts, the null key as the least of them."""
    number = isinstance(df.schema[key].dataType, T.IntegralType)
    return F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))) if number else F.coalesce(F.col(key).cast("string"), F.lit(""))


def range_of(key: Column, lows: list) -> Column:
    """Number of the range that holds a key; `lows` are the first keys of all ranges but the first."""
    bounds = np.array(lows, object if lows and isinstance(lows[0], str) else np.int64)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(np.searchsorted(bounds, x.to_numpy(bounds.dtype), side="right").astype(np.int64))

    return F.pandas_udf(run, "long")(key) if lows else F.lit(0).cast("long")


def merged(spark: SparkSession, base: str, now: dict | None, new: DataFrame, key: str, order: str, range_rows: int) -> dict:
    """The manifest of a version in which the batch's rows are merged, after its files are written."""
    ranges = now["ranges"] if now else [{"low": None, "rows": 0, "path": None}]
    lows = lambda rs: [r["low"] for r in rs[1:]]
    counts = {r.k: r.n for r in new.groupBy(range_of(_comparable(new, key), lows(ranges)).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    body = {"schema": json.loads(new.schema.json()), "writers": dict(now["writers"]) if now else {}}
    if not counts:
        return body | {"ranges": ranges}
    old = rows_of(spark, base, now, [ranges[k] for k in counts]) if now else new.limit(0)
    both = last_rows(old.select(*new.columns).unionAll(new), key, order)
    sizes = {k: n + (old.count() if ranges[k]["rows"] is None else ranges[k]["rows"]) for k, n in counts.items()}
    large = {k: n for k, n in sizes.items() if n > 2 * range_rows}
    firsts: dict[int, list] = {}
    if large:
        # a sample of each large range's keys, by hash; the bounds are its quantiles
        place = range_of(F.col("k"), lows(ranges))
        every = F.element_at(F.create_map(*[F.lit(x) for k, n in large.items() for x in (k, max(1, n // SAMPLE))]), F.col("r"))
        keys = both.select(_comparable(both, key).alias("k")).withColumn("r", place).where(F.col("r").isin(list(large)))
        seen: dict[int, list] = {}
        for row in keys.where(F.pmod(F.xxhash64("k"), every) == 0).collect():
            seen.setdefault(row.r, []).append(row.k)
        for k, found in seen.items():
            found, parts = sorted(found), -(-large[k] // range_rows)
            firsts[k] = [x for x in dict.fromkeys(found[i * len(found) // parts] for i in range(1, parts)) if k == 0 or x > ranges[k]["low"]]
    planned = [dict(r, low=low, touched=k in counts) for k, r in enumerate(ranges) for low in (r["low"], *firsts.get(k, []))]
    path = f"data/{uuid.uuid4().hex}"
    dealt = both.withColumn("_range", range_of(_comparable(both, key), lows(planned)))
    dealt.repartition(max(1, sum(r["touched"] for r in planned)), "_range").write.partitionBy("_range").parquet(f"{base}/{path}")
    written = spark.read.schema(T.StructType([*new.schema.fields, T.StructField("_range", T.LongType())])).parquet(f"{base}/{path}")
    rows = {r._range: r.n for r in written.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = []
    for k, r in enumerate(planned):
        own = {"low": r["low"], "rows": rows.get(k, 0), "path": f"{path}/_range={k}" if k in rows else None}
        out.append(own if r["touched"] else {c: r[c] for c in ("low", "rows", "path")})
    return body | {"ranges": out}


def merge(batch: DataFrame, base: str, key: str, order: str, writer: str | None = None, batch_id: int = -1, range_rows: int = RANGE_ROWS, attempts: int = 20, before_commit: Callable[[], None] | None = None) -> int:
    """Keeps the table at the last row of each key by `order` and returns the version.

    A batch that its `writer` has already committed (by number) changes nothing, so a repeated micro-batch is harmless.  A
    commit by another writer in between means a new merge with what it wrote.  before_commit: called when all files but the manifest are written.
    """
    spark = batch.sparkSession
    new = materialise(last_rows(batch, key, order))
    for _ in range(attempts):
        now = latest(spark, base)
        if now and writer is not None and now["writers"].get(writer, -1) >= batch_id:
            return now["version"]
        body = merged(spark, base, now, new, key, order, range_rows)
        if writer is not None:
            body["writers"][writer] = batch_id
        if before_commit:
            before_commit()
        if commit(spark, base, now, body):
            return now["version"] + 1 if now else 0
    raise GateError(f"{base}: other writers were first {attempts} times")

