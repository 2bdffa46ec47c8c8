"""Ordered reads of several CSV files: file and row order, headers that differ, and what builds on them."""

import csv
import random

import pytest

from gaugeworks.operators import variants as v
from gaugeworks.operators.relational import GateError
from gaugeworks.plans import blog
from gaugeworks.sources import ordered


def put(folder, name, rows, bom=False):
    with open(folder / name, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
        csv.writer(f).writerows(rows)


def test_order_and_cells(spark, tmp_path):
    """All rows of files of random sizes, against Python's reader, files made in another order than that of their names."""
    made, rng = {}, random.Random(3)
    for k in rng.sample(range(12), 12):
        head = [f"h{i}" for i in range(rng.randint(1, 6))]
        rows = [[rng.choice(["", "a,b", 'say "x"', "two\nlines", " pad ", "é", str(rng.random())]) if i else f"r{n}" for i in range(len(head))] for n in range(rng.choice([0, 1, 3, 400]))]
        put(tmp_path, f"spec-{k:02d}.csv", [head, *rows], bom=k % 2 == 0)
        made[f"spec-{k:02d}.csv"] = [dict(zip(head, x)) for x in rows]
    put(tmp_path, "other.csv", [["z"], ["1"]])
    got = ordered.csv_files(spark, f"{tmp_path}/spec-*.csv").orderBy("position").collect()
    want = [(name, k, n + 1, x) for k, name in enumerate(sorted(made)) for n, x in enumerate(made[name])]
    assert [(r.file_name, r.file_no, r.row_no, r.cells) for r in got] == want
    assert [r.position for r in got] == list(range(1, len(want) + 1))


def test_short_rows_repeated_names_and_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y,x,\n1,2,3,4\n5\n\n6,7,8,9,10\n")
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text("x\n")
    got = ordered.csv_files(spark, str(tmp_path)).orderBy("position").collect()
    assert [r.cells for r in got] == [{"y": "2", "x": "3"}, {"y": "", "x": ""}, {"y": "7", "x": "8"}] and [r.row_no for r in got] == [1, 2, 3]
    rows = ordered.columns(ordered.csv_files(spark, str(tmp_path)), ["x", "none"]).orderBy("position").collect()
    assert [(r.x, r.none) for r in rows] == [("3", None), (None, None), ("8", None)]
    with pytest.raises(GateError):
        ordered.csv_files(spark, f"{tmp_path}/b.csv")


def test_drag_fill_over_files(spark, tmp_path):
    """The row above is that of the same file; a file's last row and the next one's first aren't neighbours."""
    head = ["category", "product_name", "sku", "url", "source", "last_verified"]
    row = lambda name, *cells: ["pan", name, "", "", "", "", *cells]
    put(tmp_path, "product-spec-a.csv", [[*head, "width", "depth"], row("a1", "10 in", "20"), row("a2", "11 in", "21"), row("a3", "11 in", "22")])
    put(tmp_path, "product-spec-b.csv", [[*head, "depth", "width", "mass"], row("b1", "23", "12", "1"), row("b2", "24", "9", "2,001"), row("b3", "25", "10", "2002 g")])
    rows = v.spec_tables(ordered.csv_files(spark, f"{tmp_path}/product-spec-*.csv"))
    got = {r.product_name: (r.above, r.hits) for r in v.drag_fill_suspects(rows).collect()}
    assert got == {"a2": ("a1", ["depth", "width"]), "b3": ("b2", ["depth", "mass", "width"])}


def test_last_focus_row_over_files(spark, tmp_path):
    """The last focus row of a slug is that of the last file by name."""
    head = ["slug", "focus_keyword", "focus_intent", "refocus", "focus_prompt", "fan_out_1", "fan_out_2", "fan_out_3", "fan_out_4", "connected_entities"]
    for name, word in (("f2.csv", "second"), ("f1.csv", "first"), ("f3.csv", "")):
        put(tmp_path, name, [head, ["p", word, "", "YES" if word else "no", *[""] * 6]])
    focus = ordered.columns(ordered.csv_files(spark, f"{tmp_path}/f*.csv"), head).drop("file_name", "file_no", "row_no")
    work = spark.createDataFrame([("p", 1, 50.0, "w", "u")], "slug string, priority_rank long, geo_score double, weakest_criteria string, url string")
    pages = spark.createDataFrame([("p", "<title>t</title>")], "slug string, html string")
    got = blog.prompts(work, pages, focus).collect()
    assert len(got) == 1 and "Focus keyword: second" in got[0].prompt
