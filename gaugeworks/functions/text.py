"""Scalar functions, Column to Column.  A null gives a null unless said otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeworks.config import COLOURS, GIFT_PHRASES, QUESTION_WORDS, Rubric

#: Python's idea of white space, accented letters and digits.
_U = "(?U)"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squash(c: Column) -> Column:
    """White space runs to one blank, none at the ends."""
    return F.btrim(F.regexp_replace(c, r"(?U)\s+", " "))


def normalize_slug(c: Column) -> Column:
    return F.regexp_replace(F.lower(strip(c)), r"/+$", "")


def slug(c: Column, plus: bool = True) -> Column:
    """Lower-case words joined by '-'; '+' becomes the word plus if asked for."""
    low = F.lower(c)
    if plus:
        low = F.replace(low, F.lit("+"), F.lit(" plus "))
    return F.btrim(F.regexp_replace(low, r"[^a-z0-9]+", "-"), F.lit("-"))


def section_slug(c: Column, length: int = 50) -> Column:
    short = F.left(slug(c, plus=False), F.lit(length))
    return F.coalesce(F.nullif(short, F.lit("")), F.lit("section"))


def base_name(c: Column, colours: Sequence[str] = COLOURS, same: dict[str, str] | None = None) -> Column:
    """The name without a last ', colour'; `same` maps name prefixes to the base that they join."""
    head, tail = F.regexp_extract(c, r"(?s)^(.*),([^,]*)$", 1), F.regexp_extract(c, r"(?s)^(.*),([^,]*)$", 2)
    out = F.when(F.lower(strip(tail)).isin(*colours), strip(head)).otherwise(strip(c))
    for prefix, base in reversed(list((same or {}).items())):
        out = F.when(c.startswith(prefix), F.lit(base)).otherwise(out)
    return out


def last_part(c: Column) -> Column:
    """What stands after the last comma, or null."""
    return F.nullif(F.regexp_extract(c, r"(?s)^.*,([^,]*)$", 1), F.lit(""))


def norm(c: Column, brand: str | None = None) -> Column:
    """Lower-case letters, digits and blanks; the brand's word left out."""
    low = F.regexp_replace(F.lower(c), r"[^a-z0-9 ]+", " ")
    if brand:
        low = F.replace(low, F.lit(f"{brand.lower()} "), F.lit(" "))
    return squash(low)


def heading_key(c: Column) -> Column:
    return F.upper(squash(c))


def number(c: Column) -> Column:
    """First signed decimal, thousands commas ignored."""
    return F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), r"-?\d+(?:\.\d+)?", 0).try_cast("double")


def stat_count(c: Column, pattern: str = r"(?U)\b\d+(?:\.\d+)?%?\b") -> Column:
    return F.regexp_count(c, F.lit(pattern))


def words(c: Column, stopwords: Sequence[str] = ()) -> Column:
    found = F.regexp_extract_all(F.lower(c), F.lit(r"([a-z']+)"), 1)
    return F.filter(found, lambda w: ~w.isin(*stopwords)) if stopwords else found


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != ""))


def netloc(href: Column) -> Column:
    return F.regexp_extract(href, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def has_gift_phrase(c: Column, phrases: Sequence[str] = GIFT_PHRASES) -> Column:
    return F.lower(c).rlike(_U + r"\b(?:" + "|".join(phrases) + r")\b")


def is_question(c: Column, first_words: Sequence[str] = QUESTION_WORDS) -> Column:
    """Ends with '?' or starts with a question word."""
    low = F.lower(strip(c))
    return F.coalesce((low != "") & (low.endswith("?") | F.get(F.split(low, r"(?U)\s+"), F.lit(0)).isin(*first_words)), F.lit(False))


def top_count(tokens: Column) -> Column:
    """Count of the commonest token: a fold over the sorted tokens, within the row."""
    start = F.struct(F.lit("").alias("w"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s, x):
        run = F.when(s.w == x, s.run + 1).otherwise(F.lit(1))
        return F.struct(x.alias("w"), run.alias("run"), F.greatest(s.best, run).alias("best"))

    return F.aggregate(F.sort_array(tokens), start, step, lambda s: s.best)


def density(tokens: Column) -> Column:
    """Share of the commonest token; null without tokens."""
    return F.when(F.size(tokens) > 0, top_count(tokens) / F.size(tokens))


def stuffing_penalty(share: Column, rubric: Rubric = Rubric()) -> Column:
    over = F.least((share - rubric.low_density) / F.lit(rubric.high_density - rubric.low_density), F.lit(1.0))
    return F.when(share > rubric.low_density, -15 * over).otherwise(F.lit(0.0))


def iso_timestamp(c: Column) -> Column:
    """ISO 8601 with or without time and zone (no zone: the session's); anything else is null."""
    good = c.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:\.\d+)?)?)?(?:Z|[+-]\d{2}:?\d{2})?)?$")
    return F.when(good, F.try_to_timestamp(F.regexp_replace(F.regexp_replace(c, r"([T ]\d{2})(Z|[+-]|$)", "$1:00$2"), r"([+-]\d{2})(\d{2})$", "$1:$2")))


def age_days(ts: Column, as_of: Column) -> Column:
    return F.floor((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))) / 86_400_000_000)


def freshness(days: Column, weight: float = 5.0, tiers: tuple[int, int] = (365, 730)) -> Column:
    return F.when(days <= tiers[0], weight).when(days <= tiers[1], weight / 2).otherwise(0.0)


def capped(n: Column, most: int, weight: float) -> Column:
    """least(n, most) / most of the weight; a null counts as none."""
    return F.least(F.coalesce(n, F.lit(0)), F.lit(most)) / most * weight


def clamp(c: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(F.btrim(c.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def strip_fence(c: Column) -> Column:
    """A reply without its ``` fence."""
    inner = F.regexp_extract(c, r"(?s)^\s*```[A-Za-z]*\s*\n(.*?)\n?\s*```\s*$", 1)
    return F.when(c.rlike(r"(?s)^\s*```"), F.nullif(inner, F.lit(""))).otherwise(strip(c))


def lines(c: Column) -> Column:
    """splitlines: any line break ends a line; none after the last."""
    parts = F.split(c, r"\R")
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def term_pattern(term: str, whole_word_max: int = 5) -> str:
    """A term as a case-blind pattern; short ones match whole words only."""
    import re

    body = re.escape(term)
    return r"(?iU)" + (rf"\b{body}\b" if len(term) <= whole_word_max else body)


def file_stem(rank: Column, name: Column) -> Column:
    return F.format_string("%02d_%s", rank.cast("int"), name)


def int_or_zero(c: Column) -> Column:
    return F.coalesce(F.btrim(c).try_cast("int"), F.lit(0))


def template_id(category: Column, n: Column) -> Column:
    return F.concat(F.lit("T-"), category, F.lit("-"), n.cast("string"))


def repeat_label(low: Column, high: Column) -> Column:
    return F.when(high == 1, "").when(low == high, F.concat(F.lit(" x"), low)).otherwise(F.concat(F.lit(" x"), low, F.lit("-"), high))


def is_blocked(status: Column, title: Column, h1: Column, block_words: Sequence[str]) -> Column:
    """A page that says no: an error status, a blocking word, or no H1."""
    probe = F.lower(F.concat_ws(" ", title, h1))
    hit = F.lit(False)
    for w in block_words:
        hit = hit | probe.contains(w)
    return F.coalesce(status >= 400, F.lit(False)) | hit | (F.coalesce(strip(h1), F.lit("")) == "")
