"""Many terms at once and quotes by anchors, against one pattern a term and plain containment."""

import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.functions.text import term_pattern
from gaugeworks.operators import matching as m
from gaugeworks.operators import multisearch
from gaugeworks.operators.relational import GateError
from gaugeworks.sources import readers

LETTERS = "aAbBeEkKsSßſıİiIKéÉΣςσǅǆ漢_1- ́‍'.$"


def some(rng, letters, low, high):
    return "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))


def by_pattern(spark, texts, terms):
    """One regular expression for each term, over each line."""
    lines = texts.select("k", F.posexplode(F.split("text", r"\R")).alias("line", "content"))
    out = set()
    for t in terms:
        out |= {(r.k, r.line + 1, t) for r in lines.where(F.col("content").rlike(term_pattern(t))).collect()}
    return out


@pytest.mark.parametrize("block", [None, 7])
def test_terms_like_patterns(spark, block):
    rng = random.Random(5)
    terms = list(dict.fromkeys(t for t in (some(rng, LETTERS, 1, 8).strip() for _ in range(40)) if t))
    data = [(k, some(rng, LETTERS + "\n\r\x85", 0, 60) + rng.choice(["", " ", "\n"]) + rng.choice(terms).swapcase()) for k in range(300)] + [(900, None), (901, "")]
    texts = spark.createDataFrame(data, "k long, text string").repartition(3)
    got = [(r.row.k, r.line, r.term) for r in m.term_hits(texts, "text", terms, block=block).collect()]
    assert len(got) == len(set(got)) > 200 and set(got) == by_pattern(spark, texts, terms)


def test_empty_tables_of_terms_and_texts(spark):
    texts = spark.createDataFrame([(1, "a b")], "k long, text string")
    assert m.term_hits(texts, "text", []).count() == 0
    assert m.term_hits(texts.limit(0), "text", ["a"]).count() == 0
    assert [r.term for r in m.term_hits(texts, "text", ["a", "A", "", "b\nc"]).orderBy("term").collect()] == ["A", "a"]


def test_a_hundred_thousand_terms_in_one_pass(spark, tmp_path):
    """The plan doesn't grow with the terms, the texts are read once, and all hits are there."""
    path = tmp_path / "deny.txt"
    path.write_text("# list\n" + "\n".join(f"code name {i}" for i in range(100_000)))
    terms = readers.deny_list(spark, str(path))
    files = spark.createDataFrame([(f"f{k}.txt", f"first\nCODE NAME {k * 37} and code name {k}x") for k in range(500)], "path string, text string")
    plan = lambda t: m.term_hits(files, "text", t)._jdf.queryExecution().executedPlan().toString()
    many, few = plan(terms), plan(terms.limit(3))
    assert many.count("MapInArrow") == few.count("MapInArrow") == 1 and len(many) < 1.1 * len(few) + 500
    found, hits, scanned = m.scan_report(files, terms)
    want = {(f"f{k}.txt", 2, f"code name {n}") for k in range(500) for x in (str(k * 37), str(k)) for n in {x[:i] for i in range(1, len(x) + 1)} if n == str(int(n))}
    assert {tuple(r) for r in found.collect()} == want and hits == len(want) and scanned == 500
    (tmp_path / "none.txt").write_text("# nothing\n\n")
    with pytest.raises(GateError):
        readers.deny_list(spark, str(tmp_path / "none.txt"))


def quotes(seed):
    rng = random.Random(seed)
    word = lambda: some(rng, "abé", 1, 2)
    texts = [(k % 40 or None, rng.choice([" ", "\n", "\t "]).join(word() for _ in range(rng.randint(0, 80)))) for k in range(120)]
    texts += [texts[0], (5, None), (6, ""), (7, "the same words " * 300), (8, "the same words " * 300)]
    needles = []
    for k in range(150):
        t = rng.choice(texts)[1] or "x"
        a = rng.randint(0, len(t))
        needles.append((k, t[a : a + rng.randint(1, 60)]))
    needles += [(200, "absent words that no text has at all"), (201, None), (202, ""), (203, "the same words the same words the same"), (3, "é"), (204, " \n ")]
    return texts, needles


@pytest.mark.parametrize("seed", [1, 2])
def test_quotes_like_contains(spark, seed):
    texts, needles = quotes(seed)
    got = m.contained(spark.createDataFrame(needles, "needle_id long, needle string"), spark.createDataFrame(texts, "doc_id long, body string").repartition(4), "body").collect()
    want = [(n, d) for n, s in needles if s for d, t in texts if t is not None and s in t]
    assert len(want) > 500 and sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_quotes_are_no_cross_join(spark, threshold):
    texts, needles = quotes(3)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = m.contained(spark.createDataFrame(needles, "needle_id long, needle string"), spark.createDataFrame(texts, "doc_id long, body string"), "body")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        assert df.count() > 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_windows_are_equal_where_their_bytes_are():
    texts = [b"one two  three four", b"x one two  three", b"two three four one two three", b"a b", b"", b" p q r s t "]
    row, place, h = multisearch.windows(texts, False)
    seen = {}
    for i, p, x in zip(row.tolist(), place.tolist(), h.tolist()):
        words = texts[i][p:].split()[:3]
        end = p
        for w in words:
            end = texts[i].index(w, end) + len(w)
        assert seen.setdefault(x, texts[i][p:end]) == texts[i][p:end]
    assert len(row) == 2 + 2 + 4 + 3 and len(seen) == 10
    row, place, _ = multisearch.windows(texts, True)
    assert list(zip(row.tolist(), place.tolist())) == [(2, 4), (2, 10), (5, 3)]
