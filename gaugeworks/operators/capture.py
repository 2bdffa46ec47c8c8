"""Captured pages: block rows to sections, sections to a page's own copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.config import REVIEW_END, REVIEW_START
from gaugeworks.functions import text as t
from gaugeworks.operators import sequence as q

TOP = "(top of page)"


def build_sections(blocks: DataFrame, page: str = "page", seq: str = "seq") -> DataFrame:
    """Blocks (tag, heading, text, visible, y, h) to sections (index, heading, level, visible, y_top, y_bottom, text).

    A section shows if some of its content does; its top counts the heading only if that shows too.
    """
    rows = q.sectionise(blocks, [page], [seq], F.col("heading"), "_s")
    content = ~F.col("heading")
    shown = content & F.col("visible")
    agg = rows.groupBy(page, "_s").agg(
        F.max(F.when(F.col("heading"), F.col("text"))).alias("_title"),
        F.max(F.when(F.col("heading"), F.col("tag"))).alias("_level"),
        F.min(F.when(F.col("heading") & F.col("visible"), F.col("y"))).alias("_hy"),
        F.count_if(content).alias("_n"),
        F.min(F.when(shown, F.col("y"))).alias("_top"),
        F.max(F.when(shown, F.col("y") + F.col("h"))).alias("y_bottom"),
        F.array_join(F.transform(F.array_sort(F.filter(F.collect_list(F.when(content, F.struct(F.col(seq).alias("k"), F.col("text").alias("v")))), lambda x: x.isNotNull())), lambda x: x.v), "\n").alias("text"),
    )
    agg = agg.where("_s > 0 or _n > 0")
    agg = q.reindex(agg, [page], ["_s"])
    return agg.select(page, "index", F.coalesce("_title", F.lit(TOP)).alias("heading"), F.coalesce("_level", F.lit("")).alias("level"), F.col("_top").isNotNull().alias("visible"), F.when(F.col("_top").isNotNull(), F.least("_top", "_hy")).alias("y_top"), "y_bottom", "text")


def label_sections(sections: DataFrame, h1: Column, known: Column, brand: str | None = None, page: str = "page") -> DataFrame:
    """Adds `role`: review, related (the block of that name), card (a product's) or kept, tested in that order."""
    df = sections.withColumns({"_hn": t.norm(F.col("heading"), brand), "_h1": t.norm(h1, brand), "_known": F.transform(known, lambda x: t.norm(x, brand))})
    hn = F.col("_hn")
    df = q.region(df, [page], ["index"], hn.isin(*REVIEW_START) | hn.startswith("reviews"), hn.isin(*REVIEW_END), "_review")
    like = F.exists("_known", lambda k: (F.left(k, F.lit(35)) != "") & (hn.startswith(F.left(k, F.lit(35))) | k.startswith(F.left(hn, F.lit(35)))))
    price = (F.char_length("text") <= 60) & F.contains("text", F.lit("$"))
    card = (hn != "") & (hn != F.col("_h1")) & (like | price)
    role = F.when(F.col("_review"), "review").when(hn == "related products", "related").when(card, "card").otherwise("kept")
    return df.withColumn("role", role).drop("_hn", "_h1", "_known", "_review")


def own_copy(labelled: DataFrame, page: str = "page") -> DataFrame:
    """Kept sections, numbered anew."""
    return q.reindex(labelled.where("role = 'kept'").drop("role"), [page], ["index"], "_new").withColumn("index", F.col("_new")).drop("_new")


def excluded(labelled: DataFrame, page: str = "page") -> DataFrame:
    """(page, related_product_cards, reviews, related_products): counts, and names of cards in order."""
    counts = labelled.groupBy(page).agg(F.count_if(F.col("role").isin("related", "card")).alias("related_product_cards"), F.count_if(F.col("role") == "review").alias("reviews"))
    names = q.ordered_distinct(labelled.where("role = 'card'"), [page], ["index"], "heading", "related_products")
    return counts.join(names, page, "left").withColumn("related_products", F.coalesce("related_products", F.array().cast("array<string>")))


def clip(y_top: Column, y_bottom: Column, page_height: Column, margin: int = 20) -> Column:
    """(top, height) of a section's picture."""
    top = F.greatest(F.lit(0), y_top - margin)
    return F.struct(top.alias("top"), (F.least(y_bottom + margin, page_height) - top).alias("height"))
