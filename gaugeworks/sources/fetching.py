"""Fetching of many pages in laps that can be taken up again, with no url fetched more often than allowed.

Each of the `attempts` passes deals the urls that haven't come yet into laps: of each host about `burst` urls a lap, so a lap's work is bounded by its hosts
whatever one host holds.  A lap is noted as begun before its first fetch and as done, with the folder of what came, after its last.
Three rules bound the fetches by the passes, whatever fails:

* a lap that was begun but isn't done, as its driver died, isn't run again: its urls wait for the next pass;
* a task that runs anew, as its executor died or a copy of it was started, fetches nothing and says so of its urls;
* what came in a lap that is done is never asked for again.

So a url is fetched once a pass at most, by one task, and what a failure loses is a lap's slice for one task.  The notes are files that are put in place only where there are none.

Edge cases: repeated urls are fetched once; a null url isn't fetched and has no page; an empty table gives no rows; urls without a host share one.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.text import netloc
from gaugeworks.session import materialise
from gaugeworks.sources.state import put_new

ROWS = "url string, host string, lap long"
GOT = "url string, status string, html string"


def _note(spark: SparkSession, base: str, name: str) -> dict | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/log/{name}.json")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return json.loads(spark.read.text(f"{base}/log/{name}.json", wholetext=True).first().value)


def _put(spark: SparkSession, base: str, name: str, **body) -> bool:
    return put_new(spark, f"{base}/log/{name}.json", json.dumps(body))


def _queue(urls: DataFrame, path: str, burst: int) -> int:
    """Writes urls with their hosts and laps, and returns the number of laps.  Laps are dealt by the url's hash, so no host is sorted in one task."""
    rows = urls.withColumn("host", F.coalesce(netloc(F.col("url")), F.lit("")))
    sizes = materialise(rows.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / burst).alias("_laps")))
    most = sizes.agg(F.max("_laps")).first()[0] or 0
    if most:
        rows.join(sizes, "host").select("url", "host", F.pmod(F.xxhash64("url"), F.col("_laps")).alias("lap")).write.partitionBy("lap").parquet(path)
    return most


def _fetcher(fetch: Callable[[str], str | None], pacing: float, bucket: int, wait: bool) -> Callable[[Iterator], Iterator]:
    """Batches of (url, host) to (url, status, html), each host by a bucket of `bucket` tokens that gains one every `pacing` seconds."""

    def run(batches):
        import heapq

        import pandas as pd

        again = TaskContext.get().attemptNumber() > 0
        full: dict[str, float] = {}  # when a host's bucket is full again
        start = time.monotonic() + (pacing * bucket if wait else 0.0)
        for pdf in batches:
            if again:
                yield pd.DataFrame({"url": pdf["url"], "status": "lost", "html": None})
                continue
            due = lambda host: full.get(host, start) - (bucket - 1) * pacing
            waiting = {h: list(u) for h, u in pdf.groupby("host")["url"]}
            heap = [(due(h), h) for h in waiting]
            heapq.heapify(heap)
            out = []
            while heap:
                at, host = heapq.heappop(heap)
                time.sleep(max(0.0, at - time.monotonic()))
                url = waiting[host].pop()
                full[host] = max(full.get(host, start), time.monotonic()) + pacing
                try:
                    page = fetch(url)
                    out.append((url, "failed" if page is None else "came", page))
                except OSError:
                    out.append((url, "failed", None))
                if waiting[host]:
                    heapq.heappush(heap, (due(host), host))
            yield pd.DataFrame(out, columns=["url", "status", "html"])

    return run


def _came(spark: SparkSession, folders: list[str]) -> DataFrame:
    return spark.read.schema(GOT).parquet(*folders).where("status = 'came'").select("url", "html") if folders else spark.createDataFrame([], "url string, html string")


def fetch_all(urls: DataFrame, base: str, fetch: Callable[[str], str | None], attempts: int = 2, burst: int = 1000, pacing: float = 1.5, bucket: int = 1, pause: float = 0.0, tasks: int | None = None) -> DataFrame:
    """(url, html) of the distinct urls of column `url`; null where no attempt brought a page.

    `base` keeps the laps: a call with the same folder takes up where an earlier one ended, and gives the same
    pages once all is done.  fetch: a page, or None or an OSError if none came.  The urls of the folder's first call are those that are fetched.
    """
    spark = urls.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = urls.select("url").distinct()
    folders: list[str] = []
    for p in range(attempts):
        plan = _note(spark, base, f"pass-{p}")
        if plan is None:
            path = f"{base}/queue-{p}-{uuid.uuid4().hex}"
            todo = wanted.where("url is not null")
            laps = _queue(todo.join(_came(spark, folders).select("url"), "url", "left_anti") if folders else todo, path, burst)
            if p and laps:
                time.sleep(pause)
            _put(spark, base, f"pass-{p}", path=path, laps=laps)
            plan = _note(spark, base, f"pass-{p}")
        for lap in range(plan["laps"]):
            name = f"pass-{p}-lap-{lap}"
            done = _note(spark, base, f"{name}-done")
            if done is None:
                path = None
                if _put(spark, base, f"{name}-begun"):
                    path = f"{base}/{name}-{uuid.uuid4().hex}"
                    rows = spark.read.schema(ROWS).parquet(plan["path"]).where(F.col("lap") == lap).select("url", "host")
                    # the rows are written, hosts together, before the first fetch: the fetching stage reads files and no shuffle, so lost blocks
                    # don't run it again; gzip files aren't split, so a host stays in one task
                    rows.repartition(tasks, "host").write.option("compression", "gzip").json(f"{path}/rows")
                    whole = spark.read.schema("url string, host string").json(f"{path}/rows")
                    whole.mapInPandas(_fetcher(fetch, pacing, bucket, wait=bool(p or lap)), GOT).write.parquet(f"{path}/got")
                _put(spark, base, f"{name}-done", path=path)
                done = _note(spark, base, f"{name}-done")
            if done["path"]:
                folders.append(f"{done['path']}/got")
    return wanted.join(_came(spark, folders), "url", "left")
