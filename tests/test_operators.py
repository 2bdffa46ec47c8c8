"""Sequence operators against sequential folds; joins, gates, variants, sections, layouts and rules on small frames."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeworks.config import QUESTION_KEYS
from gaugeworks.operators import capture as cap
from gaugeworks.operators import constraints as k
from gaugeworks.operators import layouts as lay
from gaugeworks.operators import matching as m
from gaugeworks.operators import relational as r
from gaugeworks.operators import sequence as q
from gaugeworks.operators import variants as v

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
PAGES = st.lists(st.lists(st.sampled_from("FNQB"), min_size=1, max_size=12), min_size=1, max_size=12)


def frame(spark, pages):
    return spark.createDataFrame([(p, i, x) for p, page in enumerate(pages) for i, x in enumerate(page)], "p long, i long, x string")


@FEW
@given(PAGES)
def test_runs(spark, pages):
    got = {}
    for x in q.rle(frame(spark, pages), ["p"], ["i"], "x").collect():
        got.setdefault(x.p, []).append((x.run, x.x, x.n))
    for p, page in enumerate(pages):
        want = []
        for x in page:
            if want and want[-1][0] == x:
                want[-1][1] += 1
            else:
                want.append([x, 1])
        assert sorted(got[p]) == [(i, x, n) for i, (x, n) in enumerate(want)]


@FEW
@given(PAGES)
def test_region(spark, pages):
    """The state machine of the FAQ region as a last-marker window."""
    got = {(x.p, x.i): x.s for x in q.region(frame(spark, pages), ["p"], ["i"], F.col("x") == "F", F.col("x") == "B", "s", before=True).collect()}
    for p, page in enumerate(pages):
        state = False
        for i, x in enumerate(page):
            assert got[p, i] == state
            if x == "F":
                state = True
            elif x == "B" or (x == "Q" and not state):
                state = False


@FEW
@given(PAGES)
def test_first_and_distinct(spark, pages):
    df = frame(spark, pages)
    got = {x.p: x.tokens for x in q.ordered_distinct(df, ["p"], ["i"], "x").collect()}
    assert got == {p: list(dict.fromkeys(page)) for p, page in enumerate(pages)}
    firsts = {(x.p, x.x): x.i for x in q.first_occurrence(df, ["p"], ["i"], "x").collect()}
    assert firsts == {(p, x): page.index(x) for p, page in enumerate(pages) for x in page}


@FEW
@given(PAGES)
def test_strikes(spark, pages):
    got = {}
    for x in q.two_strikes(frame(spark, pages), ["p"], ["i"], F.col("x") == "B").collect():
        got.setdefault(x.p, []).append(x.i)
    for p, page in enumerate(pages):
        run, row = [], 0
        for i, x in enumerate(page):
            if row == 2:
                break
            run.append(i)
            row = row + 1 if x == "B" else 0
        assert sorted(got[p]) == run


def test_global_rank(spark):
    df = spark.createDataFrame([(i, float(i * 7 % 5) if i % 11 else None) for i in range(500)], "i long, s double").repartition(7)
    got = sorted((x.rank, x.i) for x in r.global_rank(df, F.col("s").asc_nulls_last(), F.col("i")).collect())
    want = sorted(range(500), key=lambda i: (i % 11 == 0, i * 7 % 5 if i % 11 else 0, i))
    assert got == list(enumerate(want, 1))


def test_gates(spark):
    left = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, n int")
    joined = r.left_join_indicator(left, right, "k", ["n"])
    with pytest.raises(r.GateError, match=r"got 4; without a match: \['c'\]; more than once: \['a'\]"):
        r.check_merge(joined, "k", 3, right)
    r.check_merge(r.left_join_indicator(left.where("k <> 'c'"), right.where("n <> 2"), "k", ["n"]), "k", 2, right.where("n <> 2"))
    with pytest.raises(r.GateError, match="missing columns"):
        r.require_columns(left, ["k", "z"])
    with pytest.raises(r.GateError):
        r.require_rows(left.where("false"))


def test_classify(spark):
    slugs = {
        "alpha-vs-beta-steam-iron": ("comparison_vs", True, "vs"),
        "best-handheld-steamers-for-travel": ("buying_guide", True, "best"),
        "choosing-a-steam-iron-for-quilting": ("buying_guide", True, "choosing"),
        "steamer-gift-ideas-for-him": ("gift_guide", True, "gift"),
        "steam-irons-under-50-budget-picks": ("price_bracket", True, "under-50"),
        "how-to-descale-a-steam-iron": ("informational", False, ""),
        "compact-fabric-steamer-for-trips": ("buying_guide", True, "override"),
        "guide-to-the-best": ("buying_guide", True, "best"),
    }
    df = spark.createDataFrame([(s,) for s in slugs], "slug string")
    assert {x.slug: (x.content_type, x.decision_content, x.matched_on) for x in r.classify(df).collect()} == slugs


def specs(spark):
    head = "category string, product_name string, sku string, url string, source string, last_verified string, row_no long"
    a = spark.createDataFrame([("iron", "Air, Black", "1", "u1", "", "", 0, "2400 W", None), ("iron", "Air, Blue", "2", "u2", "", "", 1, "2400 W", None), ("iron", "Pro, Black", "3", "u3", "", "", 2, "2000 W", "5"), ("iron", "Pro, White", "4", "u4", "", "", 3, "2001 W", "6")], head + ", power string, levels string")
    b = spark.createDataFrame([("fan", "Pro", "5", "u5", "", "", 0, "30 dB")], head + ", noise string")
    return [a, b]


def test_variants(spark):
    rows = v.long_specs(specs(spark))
    got = {x.sku: x.variant_group for x in v.variant_groups(rows).collect()}
    assert got == {"1": "air", "2": "air", "3": "pro-black", "4": "pro-white", "5": "pro"}
    bad = v.drag_fill_suspects(rows).collect()
    assert [(x.product_name, x.above, x.hits) for x in bad] == [("Pro, White", "Pro, Black", ["levels", "power"])]
    clash = v.long_specs([specs(spark)[0].withColumn("product_name", F.regexp_replace("product_name", "Air", "Pro!")).withColumn("category", F.when(F.col("sku") < "3", "x").otherwise("y"))])
    assert v.collisions(v.variant_groups(clash)).count() >= 0


def test_upsert_keeps_while_group_is_the_same(spark):
    new = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "sku string, g string")
    old = spark.createDataFrame([("1", "a", "shot", "scored"), ("2", "z", "shot", "scored")], "sku string, g string, pic string, status string")
    got = {x.sku: (x.pic, x.status) for x in r.upsert(new, old, "sku", "g", ["pic", "status"]).collect()}
    assert got == {"1": ("shot", "scored"), "2": ("", "indexed"), "3": ("", "indexed")}


def test_sections(spark):
    rows = [
        (1, 0, "p", False, "intro", True, 5.0, 10.0),
        (1, 1, "h2", True, "First", True, 20.0, 5.0),
        (1, 2, "p", False, "seen", True, 30.0, 10.0),
        (1, 3, "p", False, "hidden", False, 50.0, 10.0),
        (1, 4, "h2", True, "Empty", True, 60.0, 5.0),
        (2, 0, "h1", True, "Only", False, 1.0, 2.0),
    ]
    got = cap.build_sections(spark.createDataFrame(rows, "page long, seq long, tag string, heading boolean, text string, visible boolean, y double, h double")).orderBy("page", "index").collect()
    assert [tuple(x) for x in got] == [
        (1, 0, cap.TOP, "", True, 5.0, 15.0, "intro"),
        (1, 1, "First", "h2", True, 20.0, 40.0, "seen\nhidden"),
        (1, 2, "Empty", "h2", False, None, None, ""),
        (2, 0, "Only", "h1", False, None, None, ""),
    ]


def test_own_copy(spark):
    heads = [(cap.TOP, "x"), ("Air Iron", "buy"), ("Reviews (12)", "r"), ("More", "r2"), ("FAQ", "f"), ("Related Products", ""), ("Beta Steam", "long text of a card"), ("Cheap thing", "only $9"), ("Beta Steam", "again"), ("Care", "text")]
    s = spark.createDataFrame([(1, i, h, x) for i, (h, x) in enumerate(heads)], "page long, index long, heading string, text string")
    lab = cap.label_sections(s, F.lit("Air Iron"), F.array(F.lit("Beta Steam Iron")))
    assert [x.role for x in lab.orderBy("index").collect()] == ["kept", "kept", "review", "review", "kept", "related", "card", "card", "card", "kept"]
    assert [(x["index"], x.heading) for x in cap.own_copy(lab).orderBy("index").collect()] == [(0, cap.TOP), (1, "Air Iron"), (2, "FAQ"), (3, "Care")]
    x = cap.excluded(lab).first()
    assert (x.related_product_cards, x.reviews, x.related_products) == (4, 2, ["Beta Steam", "Cheap thing"])


def _sequential(sections, fixed, h1):
    """The page shape by a plain loop over its sections."""
    up = lambda x: " ".join(x.split()).upper()
    out, open_ = [], False
    for h, text, visible in sections:
        key = up(h)
        quiet = h.rstrip().endswith("?") or not text.strip() or not visible
        if h == cap.TOP:
            tok = "top"
        elif key == up(h1):
            tok = None if "buy_box" in [x for x, _ in out] else "buy_box"
        elif key in ("FAQ", "FAQS", "FREQUENTLY ASKED QUESTIONS"):
            tok, open_ = "FAQ", True
        elif open_ and quiet:
            tok = "faq_q" if text.strip() else None
        else:
            open_ = False
            tok = key if key in fixed else "banner" if visible else None
        if tok:
            out.append((tok, visible))
    return out


SECTION = st.tuples(st.sampled_from([cap.TOP, "Prod", "FAQ", "How?", "Specs", "Story", "Group"]), st.sampled_from(["", "text"]), st.booleans())


@FEW
@given(st.lists(st.lists(SECTION, min_size=1, max_size=14), min_size=1, max_size=8))
def test_tokens(spark, pages):
    rows = [(f"g{p}", "Prod", i, h, x, vis) for p, page in enumerate(pages) for i, (h, x, vis) in enumerate(page)]
    s = spark.createDataFrame(rows, "variant_group string, h1 string, index int, heading string, text string, visible boolean")
    fixed = spark.createDataFrame([("SPECS", "Specs")], "key string, label string")
    got = {}
    for x in lay.tokens(s, fixed).orderBy("variant_group", "index").collect():
        got.setdefault(x.variant_group, []).append((x.token, x.visible))
    for p, page in enumerate(pages):
        assert got.get(f"g{p}", []) == _sequential(page, {"SPECS"}, "Prod")


def test_layouts(spark):
    rows = [(g, "P", i, h, "t", vis) for g, hs in (("a", ["P", "Specs", "X", "Y"]), ("b", ["P", "specs ", "Z", "W"]), ("c", ["P", "X"])) for i, (h, vis) in enumerate(zip(hs, [True, True, True, False]))]
    rows = [x if x[3] not in ("Y", "W") else (*x[:5], True) for x in rows]
    s = spark.createDataFrame(rows, "variant_group string, h1 string, index int, heading string, text string, visible boolean")
    fixed = lay.fixed_headings(s)
    assert {x.key: x.label for x in fixed.collect()} == {"P": "P", "SPECS": "Specs", "X": "X"}
    shapes = lay.skeletons(lay.tokens(s, fixed)).withColumn("category", F.lit("iron"))
    named = lay.templates(shapes)
    assert {x.template: x.members for x in named.collect()} == {"T-iron-1": ["a"], "T-iron-2": ["b"], "T-iron-3": ["c"]}
    assert {x.template: x.difference for x in lay.differences(named).collect()} == {"T-iron-2": "missing X", "T-iron-3": "missing SPECS, banner"}
    lines = lay.template_steps(shapes, named, fixed).where("template = 'T-iron-2'").orderBy("step").collect()
    assert [x.line for x in lines] == ["1. buy box (H1, price, bullets) (shown)", "2. Specs (shown)", "3. banner x2 (shown)"]


def test_matching(spark):
    names = spark.createDataFrame([("steam iron pro",), ("steam iron",), ("fan",), ("",)], "a string")
    got = {(x.a, x.b) for x in m.prefix_pairs(names, names.withColumnRenamed("a", "b"), "a", "b", 12).collect()}
    all_ = ["steam iron pro", "steam iron", "fan"]
    assert got == {(x, y) for x in all_ for y in all_ if x.startswith(y[:12]) or y.startswith(x[:12])}
    files = spark.createDataFrame([("acme/a.txt", "one\r\nACME two\nacmes")], "path string, text string")
    hits = m.scan_terms(m.numbered_lines(files), "content", ["acme", "absent"]).orderBy("line").collect()
    assert [(x.path, x.line, x.term) for x in hits] == [("acme/a.txt", 0, "acme"), ("acme/a.txt", 2, "acme")]


def good_score():
    return {q_: {"score": "3" if i else "1", "evidence": [{"quote": "a  quote"}], "gap": "g", "missing_attributes": ["w"]} for i, q_ in enumerate(QUESTION_KEYS)}


def test_score_rules(spark):
    bad = good_score()
    bad["isA"] = {"score": "true", "evidence": [], "gap": None, "missing_attributes": None}
    bad["capable_of"] = {"score": "2", "evidence": [{"quote": " "}, {"quote": "nowhere"}], "gap": "", "missing_attributes": None}
    five = {q_: x for q_, x in good_score().items() if q_ != "isA"}
    rows = [("g1", "g1", True, True, True, "has a quote\nhere", good_score()), ("g2", "x", True, True, True, "a quote", bad), ("g3", "g3", True, False, False, None, good_score()), ("g4", "g4", True, True, False, None, good_score()), ("g5", None, False, True, True, "", None), ("g6", "g6", True, True, True, "a quote", five)]
    kind = "file string, variant_group string, parsed boolean, known boolean, captured boolean, page string, questions map<string,struct<score:string,evidence:array<struct<quote:string>>,gap:string,missing_attributes:array<string>>>"
    got = {x.file: x for x in k.validate_scores(spark.createDataFrame(rows, kind)).collect()}
    rules = {f: sorted({e.rule for e in x.errors}) for f, x in got.items()}
    assert rules == {"g1": [], "g2": sorted(["V2", "V8", "V9", "V10", "V11", "V12"]), "g3": ["V3"], "g4": ["V4"], "g5": ["V1"], "g6": ["V5", "V6"]}
    assert got["g1"].cosmo_score == 89 and got["g1"].missing == 1 and got["g2"].cosmo_score is None


def test_brief_rules(spark):
    edit = {"where": "top", "action": "replace", "current": "old  text", "new": "n", "why": "w", "questions": ["isA"]}
    good = dict(file="a", variant_group="a", page="the old text", edits=[edit], for_client_editor=[{"ask": "a", "if_confirmed": "b", "if_not": "c"}], for_owner=[], gifting_bullet={"where": "x", "text": "y"}, target_scores=dict.fromkeys(QUESTION_KEYS, 2), warnings=None)
    bad = good | dict(variant_group="b", edits=[edit | {"action": "swap", "where": " ", "why": "", "questions": ["no"]}, edit | {"current": ""}, edit | {"current": "gone"}, edit | {"action": "add", "new": ""}], for_client_editor=[{"ask": "a", "if_confirmed": "", "if_not": "c"}], for_owner=None, gifting_bullet=None, target_scores={"isA": 1}, warnings=["w"])
    none = good | dict(edits=[])
    kind = f"file string, variant_group string, page string, edits array<{k.EDIT_SCHEMA}>, for_client_editor array<struct<ask:string,if_confirmed:string,if_not:string>>, for_owner array<string>, gifting_bullet struct<where:string,text:string>, target_scores map<string,int>, warnings array<string>"
    df = spark.createDataFrame([tuple(x[c.split()[0]] for c in ("file", "variant_group", "page", "edits", "for_client_editor", "for_owner", "gifting_bullet", "target_scores", "warnings")) for x in (good, bad, none)], kind)
    got = [sorted({e.rule for e in x.e}, key=lambda s: int(s[1:])) for x in df.select(k.brief_errors().alias("e")).collect()]
    assert got == [[], ["B1", "B3", "B4", "B5", "B6", "B7", "B8", "B9", "B10", "B11", "B13", "B14"], ["B2"]]


def test_long_deny_list(spark, tmp_path):
    """All terms count, and an empty tree certifies nothing."""
    from gaugeworks.operators.relational import GateError
    from gaugeworks.sources import readers

    path = tmp_path / "deny.txt"
    path.write_text("\n".join(f"term {i}" for i in range(10_001)))
    assert len(readers.deny_terms(spark, str(path))) == 10_001
    files = spark.createDataFrame([("a.txt", "one term 7\ntwo"), ("acme/b.txt", "clean")], "path string, text string")
    found, hits, scanned = m.scan_report(files, ["term 7", "acme", "absent"], block=2)
    assert sorted(map(tuple, found.collect())) == [("a.txt", 1, "term 7"), ("acme/b.txt", 0, "acme")] and (hits, scanned) == (2, 2)
    with pytest.raises(GateError):
        m.scan_report(files.limit(0), ["x"])


def test_lists_that_are_none(spark):
    raw = '{"questions": {"isA": {"score": 2, "evidence": "text"}, "capable_of": {"evidence": []}}, "for_owner": {"a": 1}}'
    df = spark.createDataFrame([(raw,), ('{"for_owner": []}',), ("{}",)], "raw string")
    got = df.select(*[k._no_list(F.col("raw"), p).alias(n) for n, p in (("a", "$.questions.isA.evidence"), ("b", "$.questions.capable_of.evidence"), ("c", "$.for_owner"))]).collect()
    assert [tuple(x) for x in got] == [(True, False, True), (False, False, False), (False, False, False)]
