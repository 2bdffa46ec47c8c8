"""The product-page chain: index, sections, layouts, scores, briefs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.config import PRIORITY_CATEGORIES, QUESTION_KEYS
from gaugeworks.functions import text as t
from gaugeworks.operators import constraints as k
from gaugeworks.operators import layouts as lay
from gaugeworks.operators import relational as r
from gaugeworks.operators import variants as v
from gaugeworks.operators.scoring import cosmo

CARRIED = ("current_screenshot", "sections_json", "layout_template", "cosmo_score", "priority", "edit_docx", "after_image", "status")


def build_index(specs: Sequence[DataFrame], old: DataFrame | None = None, gate: bool = True, colours: Sequence[str] | None = None) -> DataFrame:
    """A row for each product with its variant group; values of the old index stay while the group does."""
    grouped = v.variant_groups(v.long_specs(specs), colours)
    if gate:
        v.check_collisions(grouped)
    new = grouped.select("variant_group", "product_name", "sku", "url", "category")
    if old is None:
        old = new.where("false").select("sku", "variant_group", *[F.lit("").alias(c) for c in CARRIED])
    return r.upsert(new, old, "sku", "variant_group", CARRIED).select("variant_group", "product_name", "sku", "url", "category", *CARRIED).orderBy("category", "variant_group", "product_name")


def representatives(index: DataFrame) -> DataFrame:
    """(variant_group, url, variant_urls): the page to capture is that of the smallest product name."""
    return index.groupBy("variant_group").agg(F.min_by("url", "product_name").alias("url"), F.transform(F.array_sort(F.collect_list(F.struct("product_name", "url"))), lambda x: x.url).alias("variant_urls"))


def fan_out(index: DataFrame, by_group: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Group results on all of the group's products."""
    side = by_group.select("variant_group", *[F.col(c).alias(f"_{c}") for c in columns])
    out = index.join(side, "variant_group", "left")
    return out.withColumns({c: F.coalesce(f"_{c}", c) if c in index.columns else F.col(f"_{c}") for c in columns}).drop(*[f"_{c}" for c in columns])


def mine_layouts(sections: DataFrame, groups: DataFrame, share: float = 0.5) -> dict[str, DataFrame]:
    """fixed, shapes, templates, steps, differences and assigned of captured sections (variant_group, h1, index, heading, text, visible)."""
    fixed = lay.fixed_headings(sections, share=share)
    shapes = lay.skeletons(lay.tokens(sections, fixed)).join(groups.select("variant_group", "category").distinct(), "variant_group")
    named = lay.templates(shapes)
    assigned = named.select("template", F.explode("members").alias("variant_group"))
    return {"fixed": fixed, "shapes": shapes, "templates": named, "steps": lay.template_steps(shapes, named, fixed), "differences": lay.differences(named), "assigned": assigned}


def rank_scores(scored: DataFrame, priority: Sequence[str] = PRIORITY_CATEGORIES) -> DataFrame:
    """Priority categories first, then low scores, then more missing attributes, then the name."""
    return r.global_rank(scored, (~F.col("category").isin(*priority)).asc(), F.col("cosmo_score").asc(), F.col("missing").desc(), F.col("variant_group").asc(), name="priority")


def apply_scores(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """Scores, ranks and statuses on the index; groups without a score lose theirs."""
    side = ranked.select("variant_group", F.col("cosmo_score").cast("string").alias("_s"), F.col("priority").cast("string").alias("_p"))
    out = index.join(side, "variant_group", "left")
    have = F.col("_s").isNotNull()
    return out.withColumns({"cosmo_score": F.coalesce("_s", F.lit("")), "priority": F.coalesce("_p", F.lit("")), "status": r.status_after(F.col("status"), have, F.lit(False), F.lit(0))}).drop("_s", "_p")


def page_texts(sections: DataFrame) -> DataFrame:
    """(variant_group, page): H1, headings and texts in order, the haystack of quotes."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("index", F.concat_ws("\n", "heading", "text").alias("t")))), lambda x: x.t)
    return sections.groupBy("variant_group").agg(F.concat_ws("\n", F.first("h1"), F.array_join(parts, "\n")).alias("page"))


def check_scores(files: DataFrame, groups: DataFrame, pages: DataFrame) -> DataFrame:
    """Score files with the page of the group that they name: errors, and scores where there are none."""
    known = groups.select("variant_group", "category", F.lit(True).alias("known")).dropDuplicates(["variant_group"])
    rows = files.join(known, "variant_group", "left").join(pages, "variant_group", "left")
    return k.validate_scores(rows.withColumns({"known": F.coalesce("known", F.lit(False)), "captured": F.col("page").isNotNull()}))


def score_counts(checked: DataFrame, groups: DataFrame) -> DataFrame:
    """One row: groups with a valid score, files that aren't valid, groups not scored yet."""
    files = checked.agg(F.count_if(F.size("errors") == 0).alias("valid"), F.count_if(F.size("errors") > 0).alias("invalid"))
    known = groups.agg(F.count_distinct("variant_group").alias("n"))
    return files.crossJoin(known).select("valid", "invalid", (F.col("n") - F.col("valid") - F.col("invalid")).alias("not_scored"))  # one row each


def select_groups(index: DataFrame, group: str | None = None, refresh: bool = False, done: DataFrame | None = None) -> DataFrame:
    """The groups to work on: one by name, or all; those that are done only if asked to do them again."""
    rows = index.where(F.col("variant_group") == group) if group else index
    if group and rows.isEmpty():
        raise r.GateError(f"unknown group: {group}")
    return rows if refresh or done is None else r.skip_done(rows, done, "variant_group")


def check_briefs(files: DataFrame, groups: DataFrame, pages: DataFrame, scores: DataFrame) -> DataFrame:
    """Brief files with errors; one without index row, page or score is INVALID as such."""
    known = groups.groupBy(F.col("variant_group").alias("file")).agg(F.first("category").alias("category"), F.first("priority").alias("priority"))
    rows = files.join(known, "file", "left").join(pages.withColumnRenamed("variant_group", "file"), "file", "left")
    rows = rows.join(scores.select("file", F.col("cosmo_score").alias("now"), F.col("questions").alias("_q")), "file", "left")
    lacking = k.messages(("B0", F.col("category").isNull(), "not in the index"), ("B0", F.col("page").isNull(), "page not captured"), ("B0", F.col("now").isNull(), "no valid score"))
    target = F.when(F.map_keys("target_scores").isNotNull(), cosmo(F.map_values("target_scores")))
    return rows.withColumns({"errors": F.concat(lacking, k.brief_errors(raw=F.col("raw") if "raw" in files.columns else None)), "target": target})


def brief_markdown(keys: Sequence[str] = QUESTION_KEYS) -> Column:
    """A product brief: scores now and after, questions for editor and owner, edits in order, gifting bullet."""
    get = lambda m, q: F.coalesce(F.try_element_at(m, F.lit(q)).cast("string"), F.lit("-"))
    card = F.concat_ws("\n", *[F.concat(F.lit(f"| {q} | "), F.coalesce(F.try_element_at("_q", F.lit(q))["score"], F.lit("-")), F.lit(" | "), get(F.col("target_scores"), q), F.lit(" |")) for q in keys])
    edits = F.array_join(
        F.transform(
            "edits",
            lambda e, i: F.concat_ws("\n", F.concat(F.lit("### "), (i + 1).cast("string"), F.lit(". "), F.initcap(e.action), F.lit(": "), e.where), F.concat(F.lit("Now: "), F.left(e.current, F.lit(220))), F.concat(F.lit("New: "), e.new), F.concat(F.lit("Why: "), e.why)),
        ),
        "\n\n",
    )
    asks = F.array_join(F.transform("for_client_editor", lambda a: F.concat(F.lit("- "), a.ask, F.lit("\n  - if so: "), a.if_confirmed, F.lit("\n  - if not: "), a.if_not)), "\n")
    section = lambda title, body, n: F.when(n > 0, F.concat(F.lit(f"## {title}\n"), body))
    return F.concat_ws(
        "\n\n",
        F.concat(F.lit("# "), F.coalesce("product_name", "variant_group")),
        F.concat(F.lit("Score: "), F.col("now").cast("string"), F.lit(" -> "), F.col("target").cast("string")),
        F.concat(F.lit("| question | now | target |\n|---|---|---|\n"), card),
        section("For the editor", asks, F.size("for_client_editor")),
        section("For the owner", F.concat(F.lit("- "), F.array_join("for_owner", "\n- ")), F.size("for_owner")),
        section("Edits", edits, F.size("edits")),
        F.when(F.col("gifting_bullet").isNotNull(), F.concat(F.lit("## Gifting\n"), "gifting_bullet.where", F.lit(": "), "gifting_bullet.text")),
    )


def brief_status(index: DataFrame, briefs: DataFrame) -> DataFrame:
    """brief or brief-draft (while the owner has questions) on the index."""
    side = briefs.where(F.size("errors") == 0).select(F.col("file").alias("variant_group"), F.lit(True).alias("_b"), F.size("for_owner").alias("_n"))
    out = index.join(side, "variant_group", "left")
    have = F.coalesce("_b", F.lit(False))
    return out.withColumn("status", F.when(have, F.when(F.col("_n") > 0, "brief-draft").otherwise("brief")).otherwise(F.col("status"))).drop("_b", "_n")


def batch_runs(total: int, done_after: Sequence[int], size: int = 3, most: int = 12) -> int:
    """How many batch runs are made: until all is done, a run makes no progress, or there were `most`."""
    before, runs = 0, 0
    for done in done_after[:most]:
        if before >= total:
            break
        runs += 1
        if done <= before:
            break
        before = done
    return runs


def file_names(df: DataFrame) -> DataFrame:
    return df.withColumn("file_name", t.file_stem(t.int_or_zero(F.col("priority")), F.col("variant_group")))
