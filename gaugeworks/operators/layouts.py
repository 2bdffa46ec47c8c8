"""Layout mining: sections to tokens, runs, skeletons, templates and their differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.config import FAQ_HEADINGS
from gaugeworks.functions import text as t
from gaugeworks.operators import sequence as q
from gaugeworks.operators.capture import TOP
from gaugeworks.operators.relational import share_above

# How tokens read in a report.
READABLE = {"top": "top of page", "buy_box": "buy box (H1, price, bullets)", "banner": "banner", "hidden_block": "hidden block", "faq_group": "FAQ group", "faq_q": "FAQ question"}


def fixed_headings(sections: DataFrame, group: str = "variant_group", share: float = 0.5) -> DataFrame:
    """(key, label): headings that `share` of all pages have, FAQ's not among them, in their first spelling."""
    keyed = sections.withColumn("key", t.heading_key(F.col("heading"))).where(~F.col("key").isin(*FAQ_HEADINGS))
    total = sections.select(group).distinct()
    often = share_above(keyed.select("key", group).unionAll(total.select(F.lit(None).cast("string").alias("key"), group)), "key", group, share)
    spelt = keyed.groupBy("key").agg(F.min_by(t.strip(F.col("heading")), F.struct(group, "index")).alias("label"))
    return often.select("key").join(spelt, "key")


def tokens(sections: DataFrame, fixed: DataFrame, group: str = "variant_group") -> DataFrame:
    """(group, index, token, visible): a page's shape.  sections have heading, text, visible, index, h1.

    The FAQ region is open where the last marker before a row is a FAQ heading; a fixed heading or
    other content closes it, a question, an empty or a hidden row does not.
    """
    df = sections.withColumns({"_k": t.heading_key(F.col("heading")), "_h1": t.heading_key(F.coalesce("h1", F.lit("")))})
    df = df.join(fixed.select(F.col("key").alias("_k"), F.lit(True).alias("_fixed")), "_k", "left").withColumn("_fixed", F.coalesce("_fixed", F.lit(False)))
    top, box = F.col("heading") == TOP, F.col("_k") == F.col("_h1")
    faq = F.col("_k").isin(*FAQ_HEADINGS)
    empty = t.strip(F.col("text")) == ""
    quiet = F.regexp_replace("heading", r"(?U)\s+$", "").endswith("?") | empty | ~F.col("visible")
    opens = ~top & ~box & faq
    closes = ~top & ~box & ~faq & ~quiet
    df = q.region(df, [group], ["index"], opens, closes, "_in", before=True)
    inside = F.col("_in") & quiet
    token = (
        F.when(top, "top")
        .when(box, "buy_box")
        .when(faq, "FAQ")
        .when(inside & ~empty, "faq_q")
        .when(inside, F.lit(None))
        .when(F.col("_fixed"), F.col("_k"))
        .when(F.col("visible"), "banner")
    )
    df = df.withColumn("token", token).where("token is not null")
    again = F.row_number().over(Window.partitionBy(group, "token").orderBy("index"))
    return df.withColumn("_again", again).where("token <> 'buy_box' or _again = 1").select(group, "index", "token", "visible")


def skeletons(shape: DataFrame, group: str = "variant_group") -> DataFrame:
    """(group, skeleton, steps): run tokens in order, and runs with their counts and visibility."""
    runs = q.rle(shape, [group], ["index"], "token", "visible")
    return runs.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("run", "token", "n", "flags"))).alias("steps")).withColumn("skeleton", F.transform("steps", lambda s: s.token))


def templates(shapes: DataFrame, group: str = "variant_group", category: str = "category") -> DataFrame:
    """(category, skeleton, members, n, number, template): numbered by size, ties by the smallest group."""
    found = shapes.groupBy(category, "skeleton").agg(F.array_sort(F.collect_list(group)).alias("members"), F.count(F.lit(1)).alias("n"), F.min(group).alias("_first"))
    order = Window.partitionBy(category).orderBy(F.desc("n"), "_first")
    found = found.withColumn("number", F.row_number().over(order))
    return found.withColumn("template", t.template_id(F.col(category), F.col("number"))).drop("_first")


def template_steps(shapes: DataFrame, named: DataFrame, labels: DataFrame | None = None, group: str = "variant_group", category: str = "category") -> DataFrame:
    """(template, step, line): counts from least to most, and shown if half or more of the rows are."""
    rows = shapes.join(named.select(category, "skeleton", "template"), [category, "skeleton"]).select("template", F.explode("steps").alias("s"))
    flat = rows.select("template", (F.col("s.run") + 1).alias("step"), F.col("s.token").alias("token"), F.col("s.n").alias("n"), F.size(F.filter("s.flags", lambda x: x)).alias("shown"), F.size("s.flags").alias("all"))
    agg = flat.groupBy("template", "step", "token").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.sum("shown").alias("shown"), F.sum("all").alias("all"))
    name = F.col("token")
    if labels is not None:
        agg = agg.join(labels.select(F.col("key").alias("token"), "label"), "token", "left")
        name = F.coalesce("label", "token")
    for k, v in READABLE.items():
        name = F.when(F.col("token") == k, v).otherwise(name)
    state = F.when(F.col("shown") >= F.col("all") / 2, "shown").otherwise("hidden")
    line = F.concat(F.col("step"), F.lit(". "), name, t.repeat_label(F.col("low"), F.col("high")), F.lit(" ("), state, F.lit(")"))
    return agg.select("template", "step", "token", "low", "high", (state == "shown").alias("shown"), line.alias("line"))


def skeleton_difference(main: Column, other: Column) -> Column:
    """missing / extra tokens, repeats kept; or the same in another order."""
    missing, extra = F.filter(main, lambda x: ~F.array_contains(other, x)), F.filter(other, lambda x: ~F.array_contains(main, x))
    text = F.concat_ws("; ", F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", "))), F.when(F.size(extra) > 0, F.concat(F.lit("extra "), F.array_join(extra, ", "))))
    return F.when(text == "", "same sections, different order").otherwise(text)


def differences(named: DataFrame, category: str = "category") -> DataFrame:
    """(template, difference) of each but the first template of a category."""
    main = named.where("number = 1").select(category, F.col("skeleton").alias("_main"))
    return named.where("number > 1").join(main, category).select("template", skeleton_difference(F.col("_main"), F.col("skeleton")).alias("difference"))
