"""Validation: rules as conditions that give messages, one row for each that fails."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.config import EDIT_ACTIONS, QUESTION_KEYS
from gaugeworks.functions.text import squash, strip
from gaugeworks.operators.scoring import cosmo

SCORE_SCHEMA = "variant_group string, questions map<string,struct<score:string,evidence:array<struct<quote:string>>,gap:string,missing_attributes:array<string>>>"
EDIT_SCHEMA = "struct<where:string,action:string,current:string,new:string,why:string,questions:array<string>>"
BRIEF_SCHEMA = (
    "variant_group string, product_name string, for_client_editor array<struct<ask:string,if_confirmed:string,if_not:string>>, for_owner array<string>, "
    "spec_backfill array<struct<column:string,value:string,quote:string>>, layout_note string, "
    f"edits array<{EDIT_SCHEMA}>, gifting_bullet struct<where:string,text:string>, target_scores map<string,int>, warnings array<string>"
)
REPLY_SCHEMA = (
    "warnings array<string>, proposed_meta_title string, proposed_meta_description string, proposed_h1 string, answer_first string, "
    "comparison_table struct<caption:string,headers:array<string>,rows:array<array<string>>>, added_product_copy array<struct<product:string,url:string,sentence:string,placement:string>>, "
    "fanout_answers array<struct<fan_out:string,heading:string,answer:string,placement:string>>, faq_block array<struct<q:string,a:string>>, schema_recommendation string, editorial_notes string"
)


def whole_score(c: Column) -> Column:
    """0..3 of a score's text, else null; true and false are 1 and 0."""
    text = F.lower(F.trim(c))
    return F.when(text.isin("0", "1", "2", "3"), text.try_cast("int")).when(text == "true", F.lit(1)).when(text == "false", F.lit(0))


def blank(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def messages(*rules: tuple[str, Column, Column | str]) -> Column:
    """Array of (rule, detail) of the rules whose condition holds; a null condition doesn't."""
    rows = [F.when(cond, F.struct(F.lit(rule).alias("rule"), (F.lit(d) if isinstance(d, str) else d).cast("string").alias("detail"))) for rule, cond, d in rules]
    return F.filter(F.array(*rows), lambda x: x.isNotNull())


def report(df: DataFrame, entity: str, found: Column) -> DataFrame:
    """(entity, rule, detail) rows."""
    return df.select(entity, F.explode(found).alias("e")).select(entity, "e.rule", "e.detail")


def _keys_differ(m: Column, keys: Sequence[str]) -> Column:
    return F.coalesce(F.array_sort(F.map_keys(m)) != F.array(*map(F.lit, sorted(keys))), F.lit(True))


def _no_list(raw: Column | None, path: str) -> Column:
    """Whether a value of a JSON text is there and no list; without the text it can't be told from one that is missing."""
    if raw is None:
        return F.lit(False)
    v = F.try_variant_get(F.try_parse_json(raw), path, "variant")
    return v.isNotNull() & ~F.schema_of_variant(v).startswith("ARRAY")


def score_errors(keys: Sequence[str] = QUESTION_KEYS, raw: Column | None = None) -> Column:
    """Of a row with file, variant_group, known, captured, page, parsed and questions; stops at an unknown or uncaptured group.

    A question without a whole score isn't looked at further, nor one whose evidence is no list; a missing
    question has no score, missing evidence is an empty list.  true and false count as 1 and 0.
    """
    q = F.col("questions")
    no_quotes = F.array().cast("array<struct<quote:string>>")
    parsed = F.lit(None).cast("variant") if raw is None else F.try_parse_json(raw)

    def of_question(s: Column, page: Column) -> Column:
        said = lambda what, *more: F.concat(s["k"], F.lit(f": {what}"), *more)
        n, have = s["n"], s["n"].isNotNull() & s["listed"]
        quotes = F.when(have, F.coalesce(s["x"]["evidence"], no_quotes)).otherwise(no_quotes)
        own = messages(
            ("V6", n.isNull(), said("score ", F.coalesce(s["x"]["score"], F.lit("null")))),
            ("V7", n.isNotNull() & ~s["listed"], said("evidence is no list")),
            ("V8", have & (n > 0) & (F.size(quotes) == 0), said("a score without a quote")),
            ("V11", have & (n < 3) & blank(s["x"]["gap"]), said("no gap")),
        )
        of_quote = lambda e: F.when(blank(e["quote"]), F.struct(F.lit("V9").alias("rule"), said("empty quote").alias("detail"))).when(
            ~F.contains(page, squash(e["quote"])), F.struct(F.lit("V10").alias("rule"), said("not on the page: ", F.left(e["quote"], F.lit(80))).alias("detail"))
        )
        return F.concat(own, F.filter(F.transform(quotes, of_quote), lambda e: e.isNotNull()))

    def of_file(once: Column) -> Column:
        def read(key: Column) -> Column:
            evidence = F.try_variant_get(F.try_element_at(once["raw"], key), "$.evidence", "variant")
            x = F.try_element_at(q, key)
            return F.struct(key.alias("k"), x.alias("x"), whole_score(x["score"]).alias("n"), (evidence.isNull() | F.schema_of_variant(evidence).startswith("ARRAY")).alias("listed"))

        return F.flatten(F.transform(F.transform(F.array(*map(F.lit, keys)), read), lambda s: of_question(s, once["page"])))

    valid = messages(("V1", ~F.col("parsed"), "not valid JSON"), ("V2", F.col("parsed") & ~F.col("variant_group").eqNullSafe(F.col("file")), "group differs from the file's name"))
    stop = messages(("V3", F.col("parsed") & ~F.col("known"), "unknown group"), ("V4", F.col("parsed") & F.col("known") & ~F.col("captured"), "page not captured"))
    # a list of one, so that the page and the text are read once for all questions
    once = F.array(F.struct(squash(F.coalesce("page", F.lit(""))).alias("page"), F.try_variant_get(parsed, "$.questions", "map<string,variant>").alias("raw")))
    body = F.concat(
        messages(("V5", _keys_differ(q, keys), "questions are not the six")),
        F.flatten(F.transform(once, of_file)),
        messages(("V12", F.try_element_at(q, F.lit("capable_of"))["missing_attributes"].isNull(), "capable_of: missing_attributes is no list")),
    )
    return F.concat(valid, F.when(~F.col("parsed"), stop).when(F.size(stop) > 0, stop).otherwise(body))


def validate_scores(scores: DataFrame) -> DataFrame:
    """Adds errors, and cosmo_score and missing where there is none."""
    df = scores.withColumn("errors", score_errors(raw=F.col("raw") if "raw" in scores.columns else None))
    six = F.transform(F.map_values("questions"), lambda x: F.coalesce(whole_score(x["score"]), F.lit(0)))
    ok = F.size("errors") == 0
    return df.withColumns({"cosmo_score": F.when(ok, cosmo(six)), "missing": F.when(ok, F.size(F.try_element_at("questions", F.lit("capable_of"))["missing_attributes"]))})


def brief_errors(keys: Sequence[str] = QUESTION_KEYS, actions: Sequence[str] = EDIT_ACTIONS, raw: Column | None = None) -> Column:
    """Of a row with group, page and the brief's columns.  An edit's questions may be an empty list, the owner's may be missing."""
    page = squash(F.coalesce("page", F.lit("")))
    allowed = F.array(*map(F.lit, keys))
    edits = F.coalesce("edits", F.array().cast(f"array<{EDIT_SCHEMA}>"))

    def of_edit(e: Column, i: Column) -> Column:
        at = F.concat(F.lit("edit "), (i + 1).cast("string"))
        replaces, adds = e["action"].isin("replace", "remove"), e["action"].isin("replace", "add")
        return messages(
            ("B3", ~F.coalesce(e["action"].isin(*actions), F.lit(False)), at),
            ("B4", blank(e["where"]), at),
            ("B5", replaces & blank(e["current"]), at),
            ("B6", replaces & ~blank(e["current"]) & ~F.contains(page, squash(e["current"])), at),
            ("B7", adds & blank(e["new"]), at),
            ("B8", blank(e["why"]), at),
            ("B9", e["questions"].isNull() | F.exists(e["questions"], lambda x: ~F.array_contains(allowed, x)), at),
        )

    asks = F.coalesce("for_client_editor", F.array().cast("array<struct<ask:string,if_confirmed:string,if_not:string>>"))

    def of_ask(a: Column, i: Column) -> Column:
        at = lambda part: F.concat(F.lit("ask "), (i + 1).cast("string"), F.lit(f": {part}"))
        return messages(*[("B11", blank(a[part]), at(part)) for part in ("ask", "if_confirmed", "if_not")])

    return F.concat(
        messages(("B1", ~F.col("variant_group").eqNullSafe(F.col("file")), "group differs from the file's name"), ("B2", F.size(edits) == 0, "no edit")),
        F.flatten(F.transform(edits, of_edit)),
        F.flatten(F.transform(asks, of_ask)),
        messages(
            ("B10", F.col("warnings").isNotNull(), "warnings is a key of old"),
            ("B12", _no_list(raw, "$.for_owner"), "for_owner is no list"),
            ("B13", F.col("gifting_bullet").isNull() | blank(F.col("gifting_bullet.where")) | blank(F.col("gifting_bullet.text")), "no gifting bullet"),
            ("B14", _keys_differ(F.col("target_scores"), keys), "targets are not the six"),
        ),
    )


def strict_brief_errors(most: int = 12) -> Column:
    """What the brief's rules ask for but no renderer checks."""
    return messages(("B15", F.size("edits") > most, F.concat(F.size("edits"), F.lit(f" edits (max {most})"))))


def reply_warnings() -> Column:
    """A reply's own warnings and those that count characters, columns and rows."""
    long = lambda c, n, what: F.when(F.char_length(c) > n, F.concat(F.lit(f"{what} is "), F.char_length(c), F.lit(f" characters (max {n}); shorten before publishing.")))
    wide = lambda c, n, what: F.when(F.size(c) > n, F.concat(F.lit("Comparison table has "), F.size(c), F.lit(f" {what} (max {n}).")))
    own = F.array(
        long(F.col("proposed_meta_title"), 60, "Meta title"),
        long(F.col("proposed_meta_description"), 155, "Meta description"),
        wide(F.col("comparison_table.headers"), 5, "columns"),
        wide(F.col("comparison_table.rows"), 5, "rows"),
    )
    return F.concat(F.coalesce("warnings", F.array().cast("array<string>")), F.filter(own, lambda x: x.isNotNull()))


def refocus_warnings(intent: Column, answers: Column, least: int = 4) -> Column:
    """A refocused page must be informational, and its reply answer the fan-outs."""
    have = F.coalesce(F.size(answers), F.lit(0))
    return F.filter(F.array(F.when(F.coalesce(F.lower(strip(intent)), F.lit("")) != "informational", F.lit("Refocus intent is not informational.")), F.when(have < least, F.concat(F.lit("Refocus has "), have, F.lit(f" fan-out answers (min {least}).")))), lambda x: x.isNotNull())


def vocabulary_audit(texts: DataFrame, key: str, header: str, body: str, vocabulary: Sequence[tuple[str, str, Sequence[str]]], banned: Sequence[str] = ()) -> DataFrame:
    """(key, rule, detail): headers must use a category's canonical name, bodies its allowed ones; banned words anywhere."""
    rules = []
    for category, canonical, allowed in vocabulary:
        own = F.col("category") == category
        rules.append(("header", own & ~F.contains(F.lower(F.col(header)), F.lit(canonical.lower())), canonical))
        names = [canonical, *allowed]
        hit = F.lit(False)
        for n in names:
            hit = hit | F.contains(F.lower(F.col(body)), F.lit(n.lower()))
        rules.append(("body", own & ~hit, canonical))
    for word in banned:
        rules.append(("banned", F.contains(F.lower(F.concat_ws(" ", header, body)), F.lit(word.lower())), word))
    return report(texts.withColumn("_m", messages(*rules)), key, F.col("_m"))


def attribute_audit(rows: DataFrame, key: str, category: str, have: str, required: dict[str, Sequence[str]]) -> DataFrame:
    """(key, missing): required attributes of the row's category that it lacks."""
    want = F.array().cast("array<string>")
    for c, names in required.items():
        want = F.when(F.col(category) == c, F.array(*map(F.lit, names))).otherwise(want)
    return rows.select(key, F.array_except(want, F.col(have)).alias("missing")).where(F.size("missing") > 0)
