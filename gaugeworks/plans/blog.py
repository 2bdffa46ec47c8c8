"""The blog chain: ingest, classify, score, rank, brief.  One lazy plan; gates run where a stage ends."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.config import PATTERNS, Rubric
from gaugeworks.functions import html
from gaugeworks.functions import text as t
from gaugeworks.operators import constraints as k
from gaugeworks.operators import relational as r
from gaugeworks.operators.scoring import score_pages

KEY = "_slug_key"


def ingest(bank: DataFrame, inventory: DataFrame, gsc: DataFrame | None = None, gate: bool = True) -> DataFrame:
    """Bank posts with their inbound links; search signals only where a frame of them is given."""
    left = bank.withColumn(KEY, t.normalize_slug(F.col("slug")))
    right = inventory.select(t.normalize_slug(F.col("Slug")).alias(KEY), F.col("Unique Inlinks").alias("unique_inlinks"))
    joined = r.left_join_indicator(left, right, KEY, ["unique_inlinks"])
    if gate:
        r.check_merge(joined, KEY, bank.count(), right)
    base = joined.select("slug", "url", "category", "unique_inlinks")
    if gsc is None:
        return base.withColumns({"gsc_joined": F.lit(False), "striking_distance": F.lit(None).cast("boolean"), "low_ctr_high_impr": F.lit(None).cast("boolean")})
    url = lambda c: F.regexp_replace(F.lower(F.btrim(c)), "/+$", "")
    rate = F.regexp_replace(F.col("CTR").cast("string"), "%", "").try_cast("double")
    seen = gsc.select(url(F.col("Top pages")).alias("_u"), F.col("Impressions").alias("_i"), rate.alias("_c"), F.col("Position").alias("_p"))
    marked = r.gsc_signals(seen, "_p", "_i", "_c").select("_u", F.lit(True).alias("gsc_joined"), "striking_distance", "low_ctr_high_impr")
    out = base.withColumn("_u", url(F.col("url"))).join(marked, "_u", "left").drop("_u")
    return out.withColumn("gsc_joined", F.coalesce("gsc_joined", F.lit(False)))


def classify(filtered: DataFrame, inventory: DataFrame | None = None, fields: Sequence[str] = ("slug",), **how) -> DataFrame:
    """Content type by slug; titles and headings join in only if `fields` asks for them."""
    if inventory is None or set(fields) <= {"slug"}:
        return r.classify(filtered, fields, **how)
    extra = [f for f in fields if f != "slug"]
    side = inventory.select(t.normalize_slug(F.col("Slug")).alias(KEY), *[F.col(f"`{f}`") for f in extra])
    joined = filtered.withColumn(KEY, t.normalize_slug(F.col("slug"))).join(side, KEY, "left")
    return r.classify(joined, fields, **how).drop(KEY, *extra)


def score(classified: DataFrame, pages: DataFrame, as_of: str, rubric: Rubric = Rubric()) -> DataFrame:
    """Scores each post's page; a post without one is `fetch_failed`."""
    return score_pages(classified.join(pages.select("slug", "html"), "slug", "left"), as_of, rubric).drop("html")


def prioritise(scored: DataFrame) -> DataFrame:
    """Decision pages, worst first, null scores last, ties by slug."""
    r.require_columns(scored, ["slug", "category", "content_type", "decision_content", "geo_score", "weakest_criteria"])
    rows = scored.where(t.truthy(F.col("decision_content")))
    ranked = r.global_rank(rows, F.col("geo_score").asc_nulls_last(), F.col("slug"), name="priority_rank")
    url = ["url"] if "url" in scored.columns else []
    return ranked.select("priority_rank", "slug", *url, "category", "content_type", F.bround("geo_score", 1).alias("geo_score"), "weakest_criteria", F.lit("geo_consideration").alias("strategy_bucket"), F.lit("none").alias("gsc_signal"))


def strategy(scored: DataFrame) -> DataFrame:
    """Buckets by search signals, and a score that puts near wins first: documented, not the default."""
    near, weak = F.coalesce("striking_distance", F.lit(False)), F.coalesce("low_ctr_high_impr", F.lit(False))
    bucket = F.when(near & weak, "quick_win").when(near, "striking_distance").when(weak, "ctr_fix").otherwise("geo_consideration")
    gain = 100 - F.coalesce("geo_score", F.lit(0.0))
    return scored.withColumns({"strategy_bucket": bucket, "priority_score": gain + F.when(near, 20).otherwise(0) + F.when(weak, 10).otherwise(0)})


def against_competitors(scored: DataFrame, rivals: DataFrame) -> DataFrame:
    """Score less the mean of the competitors' pages for the same slug."""
    mean = rivals.groupBy("slug").agg(F.avg("geo_score").alias("rival_score"))
    return scored.join(mean, "slug", "left").withColumn("relative_score", F.col("geo_score") - F.col("rival_score"))


def gap_types(classified: DataFrame, patterns=PATTERNS, least: int = 1) -> DataFrame:
    return r.gaps(classified, "content_type", [name for name, _, yes in patterns if yes], least)


def focus_block() -> Column:
    """Text of a refocus row for the prompt."""
    fans = F.filter(F.array("fan_out_1", "fan_out_2", "fan_out_3", "fan_out_4"), lambda x: ~k.blank(x))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Focus keyword: "), F.coalesce("focus_keyword", F.lit(""))),
        F.concat(F.lit("Intent: "), F.coalesce("focus_intent", F.lit(""))),
        F.when(~k.blank(F.col("focus_prompt")), F.concat(F.lit("Prompt: "), "focus_prompt")),
        F.when(F.size(fans) > 0, F.concat(F.lit("Questions:\n- "), F.array_join(fans, "\n- "))),
        F.when(~k.blank(F.col("connected_entities")), F.concat(F.lit("Entities: "), "connected_entities")),
    )


def prompts(worklist: DataFrame, pages: DataFrame, focus: DataFrame, spec_text: str = "", vocabulary: str = "", slug: str | None = None, url_prefix: str = "") -> DataFrame:
    """(slug, priority_rank, prompt, ...): page facts, text and focus of each worklist row, the last focus row of a slug counting.

    A worklist without urls gets them from `url_prefix` and the slug.  The order of focus rows is their `position`, where an ordered read gives one.
    """
    own_url = F.concat(F.lit(url_prefix), "slug")
    worklist = worklist.withColumn("url", F.coalesce("url", own_url) if "url" in worklist.columns else own_url)
    rows = worklist.where(F.lower("slug") == slug.lower()) if slug else worklist
    own = focus.where(F.upper(F.btrim("refocus")) == "YES").withColumns({"_k": F.lower("slug"), "_o": F.col("position") if "position" in focus.columns else F.monotonically_increasing_id()}).drop("slug", "position")
    df = r.lookup_last(rows.withColumn("_k", F.lower("slug")), own, "_k", "_o").drop("_k")
    df = df.join(pages.select("slug", "html"), "slug", "left").withColumn("_n", html.nodes(F.col("html")))
    n = F.col("_n")
    df = df.withColumns({"page_title": html.first_text(n, "title"), "page_description": html.meta(n, "description"), "page_h1": html.first_text(n, "h1"), "page_text": html.visible_text(n)})
    prompt = F.concat_ws(
        "\n\n",
        F.concat(F.lit("Page: "), "slug", F.lit("\nScore: "), F.coalesce(F.col("geo_score").cast("string"), F.lit("none")), F.lit("\nWeakest: "), "weakest_criteria"),
        F.concat(F.lit("Title: "), F.coalesce("page_title", F.lit("")), F.lit("\nDescription: "), F.coalesce("page_description", F.lit("")), F.lit("\nH1: "), F.coalesce("page_h1", F.lit(""))),
        F.when(F.col("refocus").isNotNull(), focus_block()),
        F.concat(F.lit("Text: "), F.coalesce("page_text", F.lit(""))),
        F.nullif(F.lit(spec_text), F.lit("")),
        F.nullif(F.lit(vocabulary), F.lit("")),
        F.lit("Reply with one JSON object."),
    )
    return df.withColumn("prompt", prompt).drop("_n", "html")


def ask(df: DataFrame, model: Callable[[str], str]) -> DataFrame:
    """Adds `reply` by an injected model function: one call for each row, on the executors; null where it fails."""

    def run(batches):
        for pdf in batches:
            out = []
            for p in pdf["prompt"]:
                try:
                    out.append(model(p))
                except OSError:
                    out.append(None)
            yield pdf.assign(reply=out)

    return df.mapInPandas(run, T.StructType([*df.schema.fields, T.StructField("reply", T.StringType())]))


def payloads(replies: DataFrame) -> DataFrame:
    """Parses replies; adds the payload's columns, `warnings` in full and `parsed` (null payloads go to a quarantine)."""
    df = replies.withColumn("_j", F.from_json(t.strip_fence(F.col("reply")), T.StructType.fromDDL(k.REPLY_SCHEMA)))
    df = df.withColumn("parsed", F.try_parse_json(t.strip_fence(F.col("reply"))).isNotNull())
    own = [c for c in replies.columns]
    df = df.select(*own, "parsed", "_j.*")
    more = k.refocus_warnings(F.col("focus_intent"), F.col("fanout_answers")) if {"focus_intent", "refocus"} <= set(own) else None
    warnings = k.reply_warnings()
    if more is not None:
        warnings = F.concat(warnings, F.when(F.col("refocus").isNotNull(), more).otherwise(F.array().cast("array<string>")))
    return df.withColumn("warnings", warnings)


def brief_markdown() -> Column:
    """A brief as Markdown; a section that has nothing is left out and the others are numbered on."""
    rows = F.array(
        F.struct(F.lit("Warnings").alias("h"), F.when(F.size("warnings") > 0, F.concat(F.lit("- "), F.array_join("warnings", "\n- "))).alias("b")),
        F.struct(F.lit("Meta").alias("h"), F.concat_ws("\n", F.concat(F.lit("Title: "), "proposed_meta_title"), F.concat(F.lit("Description: "), "proposed_meta_description"), F.concat(F.lit("H1: "), "proposed_h1")).alias("b")),
        F.struct(F.lit("Answer first").alias("h"), F.col("answer_first").alias("b")),
        F.struct(F.lit("Comparison table").alias("h"), F.when(F.size("comparison_table.headers") > 0, F.concat_ws("\n", "comparison_table.caption", F.concat(F.lit("| "), F.array_join("comparison_table.headers", " | "), F.lit(" |")), F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.size("comparison_table.headers"))), F.array_join(F.transform("comparison_table.rows", lambda x: F.concat(F.lit("| "), F.array_join(x, " | "), F.lit(" |"))), "\n"))).alias("b")),
        F.struct(F.lit("Product copy").alias("h"), F.when(F.size("added_product_copy") > 0, F.array_join(F.transform("added_product_copy", lambda x: F.concat(F.lit("- "), x.product, F.lit(": "), x.sentence)), "\n")).alias("b")),
        F.struct(F.lit("Fan-out answers").alias("h"), F.when(F.size("fanout_answers") > 0, F.array_join(F.transform("fanout_answers", lambda x: F.concat(F.lit("### "), x.heading, F.lit("\n"), x.answer)), "\n")).alias("b")),
        F.struct(F.lit("FAQ").alias("h"), F.when(F.size("faq_block") > 0, F.array_join(F.transform("faq_block", lambda x: F.concat(F.lit("### "), x.q, F.lit("\n"), x.a)), "\n")).alias("b")),
        F.struct(F.lit("Schema").alias("h"), F.col("schema_recommendation").alias("b")),
        F.struct(F.lit("Notes").alias("h"), F.col("editorial_notes").alias("b")),
    )
    have = F.filter(rows, lambda x: ~k.blank(x.b))
    body = F.array_join(F.transform(have, lambda x, i: F.concat(F.lit("## "), (i + 1).cast("string"), F.lit(". "), x.h, F.lit("\n"), x.b)), "\n\n")
    return F.concat(F.lit("# "), "slug", F.lit("\n\nScore: "), F.coalesce(F.col("geo_score").cast("string"), F.lit("none")), F.lit(" (rank "), F.col("priority_rank").cast("string"), F.lit(")\nWeakest: "), F.coalesce("weakest_criteria", F.lit("")), F.lit("\n\n"), body)
