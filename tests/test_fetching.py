"""Fetches in laps: every url at most once a pass, whatever dies."""

import os
import subprocess
import sys
from collections import Counter

import pytest

from gaugeworks.sources import fetching

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def counted(folder, fails=lambda url, n: False):
    """A fetch function that notes its calls as files; `fails` sees the url and how many calls it had before."""

    def fetch(url):
        import os
        import uuid

        key = url.replace("/", "_")
        n = sum(x.startswith(f"{key}~") for x in os.listdir(folder))
        open(f"{folder}/{key}~{uuid.uuid4().hex}", "w").close()
        if fails(url, n):
            raise OSError(url)
        return f"page of {url}"

    return fetch


def calls(folder):
    return Counter(x.split("~")[0] for x in os.listdir(folder))


def frame(spark, urls):
    return spark.createDataFrame([(u,) for u in urls], "url string")


def pages(df):
    rows = [(r.url, r.html) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


URLS = [f"https://big.example/{i}" for i in range(40)] + [f"https://h{i}.example/x" for i in range(6)]


def folder(tmp_path, name):
    (tmp_path / name).mkdir()
    return str(tmp_path / name)


def test_all_urls_come_by_laps(spark, tmp_path):
    log, base = folder(tmp_path, "calls"), f"file://{tmp_path}/base"
    fetch = counted(log, lambda url, n: url.endswith("/7") or (url.endswith("/8") and n == 0))
    got = pages(fetching.fetch_all(frame(spark, [*URLS, URLS[0], None, "no url"]), base, fetch, burst=15, pacing=0.0))
    assert got.pop(None) is None
    assert got == {u: None if u.endswith("/7") else f"page of {u}" for u in [*URLS, "no url"]}
    n = calls(log)
    assert n["https:__big.example_7"] == n["https:__big.example_8"] == 2 and sum(n.values()) == len(URLS) + 1 + 2
    # a second call reads what came
    assert pages(fetching.fetch_all(frame(spark, URLS), base, fetch, burst=15, pacing=0.0)) == {u: got[u] for u in URLS}
    assert calls(log) == n


def test_empty_table(spark, tmp_path):
    assert pages(fetching.fetch_all(frame(spark, []), f"file://{tmp_path}/base", counted(folder(tmp_path, "calls")), pacing=0.0)) == {}
    assert pages(fetching.fetch_all(frame(spark, [None]), f"file://{tmp_path}/other", counted(folder(tmp_path, "more")), pacing=0.0)) == {None: None}


def test_driver_that_dies_in_a_lap(spark, tmp_path, monkeypatch):
    log, base = folder(tmp_path, "calls"), f"file://{tmp_path}/base"
    put, seen = fetching._put, []

    def dies(spark, base, name, **body):
        if name.endswith("lap-1-done") and not seen:
            seen.append(name)
            raise KeyboardInterrupt
        return put(spark, base, name, **body)

    monkeypatch.setattr(fetching, "_put", dies)
    with pytest.raises(KeyboardInterrupt):
        fetching.fetch_all(frame(spark, URLS), base, counted(log), burst=15, pacing=0.0)
    first = calls(log)
    assert 0 < len(first) < len(URLS)
    got = pages(fetching.fetch_all(frame(spark, URLS), base, counted(log), burst=15, pacing=0.0))
    assert got == {u: f"page of {u}" for u in URLS}
    n = calls(log)
    assert max(n.values()) == 2 and any(v == 2 for v in n.values())
    # only what the lost lap had fetched was fetched again
    assert all(first[u] == 1 for u, v in n.items() if v == 2)


def test_hosts_are_paced(spark, tmp_path):
    from time import monotonic

    log = folder(tmp_path, "calls")
    began = monotonic()
    urls = [f"https://a.example/{i}" for i in range(5)] + [f"https://b.example/{i}" for i in range(5)]
    fetching.fetch_all(frame(spark, urls), f"file://{tmp_path}/base", counted(log), pacing=0.5, tasks=1).collect()
    at = {h: sorted(os.stat(f"{log}/{x}").st_mtime for x in os.listdir(log) if x.startswith(f"https:__{h}.")) for h in "ab"}
    assert all(b - a > 0.45 for times in at.values() for a, b in zip(times, times[1:]))
    # side by side: b's first fetch doesn't wait for a's last
    assert at["b"][0] < at["a"][-1] and at["a"][0] < at["b"][-1] and monotonic() - began < 60


DYING = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from gaugeworks.sources import fetching
spark = SparkSession.builder.master("local[2,3]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp}/shared").getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def fetch(url):
    import os, uuid
    n = len(os.listdir("{tmp}/calls"))
    open("{tmp}/calls/" + url.replace("/", "_") + "~" + uuid.uuid4().hex, "w").close()
    if n == 10:
        os._exit(1)  # the Python worker dies, and its task with it
    return "page of " + url

urls = spark.createDataFrame([(f"https://h{{i % 5}}.example/{{i}}",) for i in range(40)], "url string")
rows = fetching.fetch_all(urls, "file://{tmp}/base", fetch, pacing=0.0, attempts={attempts}).collect()
print("CAME", sum(r.html == "page of " + r.url for r in rows), len(rows))
"""


@pytest.mark.parametrize("attempts, came", [(1, False), (2, True)])
def test_task_that_dies(tmp_path, attempts, came):
    (tmp_path / "calls").mkdir()
    out = subprocess.run([sys.executable, "-c", DYING.format(root=ROOT, tmp=tmp_path, attempts=attempts)], capture_output=True, text=True, timeout=240)
    said = [x for x in out.stdout.splitlines() if x.startswith("CAME")]
    assert said, out.stderr[-2000:]
    got, rows = map(int, said[0].split()[1:])
    n = calls(tmp_path / "calls")
    assert rows == 40 and max(n.values()) <= attempts
    assert (got == 40) == came
