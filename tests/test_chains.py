import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from gaugeworks.config import QUESTION_KEYS
from gaugeworks.operators.relational import GateError
from gaugeworks.plans import blog, pdp
from gaugeworks.sources import readers, sinks
from gaugeworks.streaming import captures
from tests import pages as P
from tests.test_operators import good_score, specs

SLUGS = ["best-irons", "a-vs-b", "gift-ideas", "how-to"]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "html").mkdir()
    for s, h in zip(SLUGS, (P.FULL, P.POOR, P.NO_ANSWER, P.SHORT_ANSWER)):
        (tmp_path / "html" / f"{s}.html").write_text(h.replace("<body>", "\n<body>\n"))
    (tmp_path / "bank.csv").write_text("﻿slug,url,category\n" + "".join(f"{s},https://x.example/{s}/,iron\n" for s in SLUGS))
    (tmp_path / "inv.csv").write_text("Original Url,Slug,Title 1,Meta Description 1,Meta Keywords 1,H1-1,H2-1,H2-2,Unique Inlinks\n" + "".join(f"u,/{s.upper()}/,Title,,\"a, b\",,,,{i}\n" for i, s in enumerate(SLUGS)).replace("/", "", 0).replace(",/", ",").replace("/,", "/,"))
    return tmp_path


def load(spark, folder):
    return readers.csv(spark, f"{folder}/bank.csv", readers.BANK), readers.csv(spark, f"{folder}/inv.csv", readers.INVENTORY)


def test_blog_chain(spark, folder):
    bank, inv = load(spark, folder)
    posts = blog.ingest(bank, inv)
    assert {r.slug: r.unique_inlinks for r in posts.collect()} == dict(zip(SLUGS, range(4)))
    kinds = blog.classify(posts)
    pages = readers.html_cache(spark, f"{folder}/html")
    scored = blog.score(kinds, pages, "2026-10-15")
    work = blog.prioritise(scored).orderBy("priority_rank").collect()
    assert [(r.priority_rank, r.slug) for r in work] == [(1, "a-vs-b"), (2, "gift-ideas"), (3, "best-irons")]
    assert {r.content_type for r in blog.gap_types(kinds).collect()} == {"price_bracket"}
    wide = blog.classify(posts, inv, fields=("slug", "Title 1"))
    assert wide.columns == kinds.columns
    assert {r.strategy_bucket for r in blog.strategy(scored).collect()} == {"geo_consideration"}
    assert blog.against_competitors(scored, scored).where("relative_score <> 0").count() == 0
    with pytest.raises(GateError, match="without a match"):
        blog.ingest(bank, inv.where("Slug not like 'A%'"))


def test_search_signals(spark, folder):
    bank, inv = load(spark, folder)
    gsc = spark.createDataFrame([(f"https://x.example/{s}", 1, 10 * i, f"{9 - i}%", 4.0 + i) for i, s in enumerate(SLUGS[:3])], readers.GSC)
    got = {r.slug: (r.gsc_joined, r.striking_distance, r.low_ctr_high_impr) for r in blog.ingest(bank, inv, gsc).collect()}
    assert got == {"best-irons": (True, False, False), "a-vs-b": (True, True, False), "gift-ideas": (True, True, True), "how-to": (False, None, None)}


def test_missing_pages(spark, folder):
    bank, _ = load(spark, folder)
    cache = readers.html_cache(spark, f"{folder}/html").where("slug <> 'how-to'")
    with pytest.raises(GateError, match="how-to"):
        readers.with_pages(bank, cache, on_missing="fail")
    got = readers.fetch_missing(bank, cache, lambda url: f"<p>{url}", pacing=0).collect()
    assert [tuple(r) for r in got] == [("how-to", "<p>https://x.example/how-to/")]
    assert readers.fetch_missing(bank, cache, None).first().html is None


def test_briefs(spark, folder):
    bank, inv = load(spark, folder)
    pages = readers.html_cache(spark, f"{folder}/html")
    work = blog.prioritise(blog.score(blog.classify(blog.ingest(bank, inv)), pages, "2026-10-15"))
    focus = spark.createDataFrame([("1", "A-vs-B", "old", "commercial", "YES", "", "f1", "", "", "", "", ""), ("2", "a-vs-b", "kw", "commercial", "yes ", "", "f1", "f2", None, "", "e1; e2", "")], readers.FOCUS)
    asked = blog.prompts(work, pages, focus, slug="A-VS-B")
    row = asked.first()
    assert asked.count() == 1 and "Focus keyword: kw" in row.prompt and "Title: T & t" in row.prompt and "Story spam" in row.prompt
    reply = {"warnings": ["own"], "proposed_meta_title": "x" * 61, "proposed_meta_description": "d", "comparison_table": {"caption": "c", "headers": list("abcdef"), "rows": [["1"]] * 6}, "faq_block": [{"q": "Q?", "a": "A"}], "answer_first": "Ans"}
    text = "```json\n" + json.dumps(reply) + "\n```"
    got = blog.payloads(blog.ask(asked, lambda p, text=text: text))
    r = got.first()
    assert r.parsed and len(r.warnings) == 1 + 3 + 2 and r.warnings[0] == "own"
    md = got.select(blog.brief_markdown().alias("m")).first().m
    assert md.startswith("# a-vs-b") and "## 1. Warnings" in md and "| a | b | c | d | e | f |" in md and "### Q?\nA" in md and "Product copy" not in md
    assert not blog.payloads(blog.ask(asked, lambda p: "sorry")).first().parsed


def test_spreadsheet(spark, tmp_path):
    df = spark.createDataFrame([(1, "a & b", 2.5, True, None), (2, "x" * 90, None, False, ["p", "q"])], "n long, s string, d double, b boolean, l array<string>")
    assert sinks.column_widths(df) == [3, 60, 5, 7, 8]
    z = zipfile.ZipFile(io.BytesIO(sinks.workbook(df)))
    sheet = z.read("xl/worksheets/sheet1.xml").decode()
    assert 'state="frozen"' in sheet and "a &amp; b" in sheet and "p; q" in sheet and sheet.count("<row ") == 3
    with pytest.raises(GateError):
        sinks.workbook(df, most_rows=1)
    docs = sinks.documents(spark.createDataFrame([("f", "# T\n- b\ntext")], "n string, m string"), "n", "m").first()
    assert docs.file == "f.docx" and "Heading1" in zipfile.ZipFile(io.BytesIO(docs.content)).read("word/document.xml").decode()
    table = zipfile.ZipFile(io.BytesIO(sinks.document("# T\n| a | b |\n|---|---|\n| 1 | <2> |\nend"))).read("word/document.xml").decode()
    assert table.count("<w:tr>") == 2 and table.count("<w:shd") == 2 and "&lt;2&gt;" in table and "---" not in table
    (tmp_path / "book.xlsx").write_bytes(sinks.workbook(df))
    read = readers.workbook(spark.read.format("binaryFile").load(f"{tmp_path}/book.xlsx"), "n long, s string, d double, b boolean, l string").orderBy("row_no").collect()
    assert [tuple(x) for x in read] == [(1, 1, "a & b", 2.5, True, None), (2, 2, "x" * 90, None, False, "p; q")]
    sinks.stage_csv(df, f"{tmp_path}/out")
    assert sinks.read_back(df, spark, f"{tmp_path}/out") == 2
    assert sinks.quarantine(df, F.col("d").isNotNull(), f"{tmp_path}/bad").count() == 1 and spark.read.parquet(f"{tmp_path}/bad").count() == 1
    assert sinks.console(df, ["n", "s"]).startswith("n\ts\n1\ta & b")


def test_state_versions(spark, tmp_path):
    base = f"{tmp_path}/state"
    sinks.write_version(spark.range(3).toDF("k"), base)
    sinks.write_version(sinks.read_version(spark, base).where("k > 0"), base)
    assert sorted(r.k for r in sinks.read_version(spark, base).collect()) == [1, 2]


def test_index_and_ranks(spark):
    index = pdp.build_index(specs(spark))
    assert [r.sku for r in index.collect()] == ["5", "1", "2", "3", "4"] and {r.status for r in index.collect()} == {"indexed"}
    reps = {r.variant_group: (r.url, r.variant_urls) for r in pdp.representatives(index).collect()}
    assert reps["air"] == ("u1", ["u1", "u2"])
    ranked = pdp.rank_scores(spark.createDataFrame([("air", "iron", 50, 1), ("pro", "fan", 40, 2), ("pro-black", "iron", 50, 3)], "variant_group string, category string, cosmo_score int, missing int"), ["iron"])
    assert [r.variant_group for r in ranked.orderBy("priority").collect()] == ["pro-black", "air", "pro"]
    scored = pdp.apply_scores(index, ranked)
    got = {r.sku: (r.cosmo_score, r.priority, r.status) for r in scored.collect()}
    assert got["1"] == ("50", "2", "scored") and got["4"] == ("", "", "indexed")
    again = pdp.apply_scores(scored, ranked.where("variant_group <> 'air'"))
    assert {r.sku: r.status for r in again.collect()}["1"] == "captured"
    kept = pdp.build_index(specs(spark), scored)
    assert {r.sku: r.status for r in kept.collect()}["1"] == "scored"
    assert pdp.file_names(scored).where("sku = '1'").first().file_name == "02_air"
    assert [pdp.batch_runs(9, x) for x in ([3, 6, 9], [3, 3, 3], [3, 6, 8, 9])] == [3, 2, 4]


def test_scores_and_briefs(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "air.json").write_text(json.dumps({"variant_group": "air", "questions": good_score()}, indent=2))
    (tmp_path / "s" / "bad.json").write_text("{nope")
    sections = spark.createDataFrame([("air", "Air", 0, "Top", "a quote"), ("air", "Air", 1, "Care", "old text")], "variant_group string, h1 string, index int, heading string, text string")
    pages = pdp.page_texts(sections)
    assert pages.first().page == "Air\nTop\na quote\nCare\nold text"
    groups = spark.createDataFrame([("air", "iron", "1"), ("bad", "iron", "2")], "variant_group string, category string, priority string")
    files = readers.json_documents(spark, f"{tmp_path}/s", "variant_group string, questions map<string,struct<score:string,evidence:array<struct<quote:string>>,gap:string,missing_attributes:array<string>>>")
    scored = pdp.check_scores(files, groups, pages)
    got = {r.file: r for r in scored.collect()}
    assert got["air"].cosmo_score == 89 and got["air"].errors == [] and [e.rule for e in got["bad"].errors] == ["V1"]
    (tmp_path / "b").mkdir()
    brief = {"variant_group": "air", "product_name": "Air", "for_client_editor": [{"ask": "a", "if_confirmed": "y", "if_not": "n"}], "for_owner": ["o"], "edits": [{"where": "Care", "action": "replace", "current": "old text", "new": "new", "why": "w", "questions": ["isA"]}], "gifting_bullet": {"where": "g", "text": "t"}, "target_scores": dict.fromkeys(QUESTION_KEYS, 3)}
    (tmp_path / "b" / "air.json").write_text(json.dumps(brief))
    briefs = readers.json_documents(spark, f"{tmp_path}/b", pdp.k.BRIEF_SCHEMA)
    checked = pdp.check_briefs(briefs, groups, pages, scored)
    r = checked.first()
    assert r.errors == [] and r.now == 89 and r.target == 100
    md = checked.select(pdp.brief_markdown().alias("m")).first().m
    assert "Score: 89 -> 100" in md and "### 1. Replace: Care" in md and "| isA | 1 | 3 |" in md
    index = groups.select("variant_group", F.lit("scored").alias("status"))
    assert {x.variant_group: x.status for x in pdp.brief_status(index, checked).collect()} == {"air": "brief-draft", "bad": "scored"}


def test_layout_report(spark):
    rows = [(g, "P", i, h, "t", True) for g, hs in (("a", ["P", "Specs"]), ("b", ["P", "Specs"]), ("c", ["Specs", "P"])) for i, h in enumerate(hs)]
    s = spark.createDataFrame(rows, "variant_group string, h1 string, index int, heading string, text string, visible boolean")
    groups = spark.createDataFrame([(g, "iron") for g in "abc"], "variant_group string, category string")
    found = pdp.mine_layouts(s, groups)
    text = sinks.layout_report(found["templates"], found["steps"], found["differences"]).first().markdown
    assert text.startswith("## iron (3 groups, 2 templates)") and "### T-iron-1: 2 of 3 groups" in text and "Groups: a, b" in text and "Differs from T-iron-1: same sections, different order" in text
    out = pdp.fan_out(groups, found["assigned"].withColumnRenamed("template", "layout_template"), ["layout_template"])
    assert {r.variant_group: r.layout_template for r in out.collect()} == {"a": "T-iron-1", "b": "T-iron-1", "c": "T-iron-2"}


def test_deny_list_and_tree(spark, tmp_path):
    (tmp_path / "t" / ".git").mkdir(parents=True)
    (tmp_path / "t" / "a.txt").write_text("secret")
    (tmp_path / "t" / ".git" / "b.txt").write_text("secret")
    assert readers.text_tree(spark, f"{tmp_path}/t").count() == 1
    (tmp_path / "deny").write_text("# note\n\n acme \n")
    assert readers.deny_terms(spark, f"{tmp_path}/deny") == ["acme"]
    (tmp_path / "none").write_text("# note\n")
    with pytest.raises(GateError):
        readers.deny_terms(spark, f"{tmp_path}/none")
    assert readers.labelled_text(spark, [f"{tmp_path}/t/a.txt"]) == "### a.txt\nsecret"


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    base, schema = f"{tmp_path}/state", "k string, at long, v string"
    for n, rows in enumerate(([("a", 1, "x"), ("b", 1, "y")], [("a", 2, "z"), ("a", 0, "old")])):
        (tmp_path / "in" / f"{n}.json").write_text("\n".join(json.dumps(dict(zip(("k", "at", "v"), r))) for r in rows))
        captures.upsert_into(captures.capture_stream(spark, f"{tmp_path}/in", schema), base, "k", "at", f"{tmp_path}/cp").awaitTermination()
    assert {r.k: r.v for r in sinks.read_version(spark, base).collect()} == {"a": "z", "b": "y"}


def test_raised_targets_are_marked():
    card = "| question | now | target |\n|---|---|---|\n| a | 1 | 3 |\n| b | 3 | 3 |\n| c | - | 2 |\n| d | 2/3 | 10/3 |\n| e | 1 |"
    xml = zipfile.ZipFile(io.BytesIO(sinks.document(card))).read("word/document.xml").decode()
    cells = [x for x in xml.split("<w:tc>") if sinks.RAISED_COLOUR in x]
    assert [x.split('preserve">')[1].split("<")[0] for x in cells] == ["3", "10/3"]
    other = zipfile.ZipFile(io.BytesIO(sinks.document(card.replace("now", "then")))).read("word/document.xml").decode()
    assert sinks.RAISED_COLOUR not in other and "E7E6E6" in other
