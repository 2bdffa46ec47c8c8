import pytest
from pyspark.sql import functions as F

from gaugeworks.config import BLOCK_WORDS
from gaugeworks.functions import text as t


def ev(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "f,value,want",
    [
        (t.normalize_slug, "  /A/B// ", "/a/b"),
        (t.normalize_slug, None, None),
        (t.slug, "Airy + Spin, 12 min!", "airy-plus-spin-12-min"),
        (t.section_slug, "???", "section"),
        (t.section_slug, "a" * 60, "a" * 50),
        (t.base_name, "Airy, Pro, Red Coral ", "Airy, Pro"),
        (t.base_name, "Airy, 12 min", "Airy, 12 min"),
        (lambda c: t.base_name(c, same={"Air": "Joined"}), "Airy", "Joined"),
        (t.last_part, "a, b", " b"),
        (t.last_part, "a", None),
        (lambda c: t.norm(c, "Brand"), "The Brand  X-200!", "the x 200"),
        (t.heading_key, " What's \n new ", "WHAT'S NEW"),
        (t.number, "2,400 W", 2400.0),
        (t.number, "-3.5 dB", -3.5),
        (t.number, "Instant heat", None),
        (t.stat_count, "50% of 3.5 and v2 or 7", 3),
        (t.word_count, "  a  b\tc ", 3),
        (t.word_count, "", 0),
        (t.netloc, "https://a.example/x?y", "a.example"),
        (t.netloc, "//b.example#z", "b.example"),
        (t.netloc, "/rel//x", ""),
        (t.has_gift_phrase, "a gift for her", True),
        (t.has_gift_phrase, "gifts represent", False),
        (t.is_question, "What is it", True),
        (t.is_question, "What's new", False),
        (t.is_question, "Really? ", True),
        (t.is_question, "", False),
        (t.is_question, None, False),
        (t.strip_fence, "```json\n{\"a\": 1}\n```", '{"a": 1}'),
        (t.strip_fence, " {} ", "{}"),
        (t.lines, "a\r\nb\n\nc\n", ["a", "b", "", "c"]),
        (t.int_or_zero, "", 0),
        (t.int_or_zero, " 7 ", 7),
        (t.truthy, " Yes ", True),
        (t.truthy, None, False),
        (t.squash, " a \n b ", "a b"),
    ],
)
def test_scalar(spark, f, value, want):
    assert ev(spark, value, f) == want


@pytest.mark.parametrize("value,want", [("2026-09-10", 35), ("2026-09-10T12:00:00Z", 34), ("2026-09-10T12:00:00+02:00", 34), ("2027-01-01", -78), ("20260910", None), ("soon", None), ("2026-09", None)])
def test_age(spark, value, want):
    assert ev(spark, value, lambda c: t.age_days(t.iso_timestamp(c), F.lit("2026-10-15"))) == want


def test_freshness_and_penalty(spark):
    df = spark.createDataFrame([(365, 0.02), (366, 0.04), (731, 0.06), (None, 0.5)], "d int, s double")
    got = df.select(t.freshness(F.col("d")).alias("f"), t.stuffing_penalty(F.col("s")).alias("p"), t.clamp(F.col("s") * 1000).alias("c")).collect()
    assert [r.f for r in got] == [5.0, 2.5, 0.0, 0.0]
    assert [round(r.p, 9) for r in got] == [0.0, -7.5, -15.0, -15.0] and got[3].c == 100.0


def test_density(spark):
    df = spark.createDataFrame([("a b A c the",), ("the",), ("",)], "x string")
    got = df.select(t.density(t.words(F.col("x"), ("the",))).alias("d")).collect()
    assert [r.d for r in got] == [0.5, None, None]


def test_blocked(spark):
    df = spark.createDataFrame([(404, "t", "h"), (200, "Just a Moment", "h"), (200, "t", " "), (200, None, "h"), (None, "t", "h")], "s int, t string, h string")
    assert [r.b for r in df.select(t.is_blocked(F.col("s"), F.col("t"), F.col("h"), BLOCK_WORDS).alias("b")).collect()] == [True, True, True, False, False]


def test_term_pattern(spark):
    df = spark.createDataFrame([("an ACME item",), ("acmes",), ("x acmeware y",)], "x string")
    assert [r.b for r in df.select(F.col("x").rlike(t.term_pattern("acme")).alias("b")).collect()] == [True, False, False]
    assert [r.b for r in df.select(F.col("x").rlike(t.term_pattern("acmewa")).alias("b")).collect()] == [False, False, True]
