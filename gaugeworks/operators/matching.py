"""Theta joins: prefixes, patterns, substrings."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.text import squash
from gaugeworks.operators.multisearch import occurrences, slices, windows
from gaugeworks.operators.relational import GateError
from gaugeworks.session import materialise

#: Bins of the hashes of needles' windows, which keep other windows out of the shuffle.
FILTER_BINS = 1 << 24


def prefix_pairs(left: DataFrame, right: DataFrame, a: str, b: str, n: int = 35) -> DataFrame:
    """Pairs of which one starts with the first n characters of the other, or the other way round.

    Both sides of n characters or more must share those n, which is an equi-join; a shorter one is
    joined on each length that shorter names have, so no side is compared with all of the other.
    """
    x = left.where(F.col(a) != "").withColumn("_a", F.left(F.col(a), F.lit(n)))
    y = right.where(F.col(b) != "").withColumn("_b", F.left(F.col(b), F.lit(n)))
    lengths = lambda c: F.transform(F.sequence(F.lit(1), F.char_length(c)), lambda k: F.left(F.col(c), k))
    one = x.withColumn("_k", F.explode(lengths("_a"))).join(y, F.col("_k") == F.col("_b"))
    two = x.join(y.withColumn("_k", F.explode(lengths("_b"))).where(F.col("_k") != F.col("_b")), F.col("_k") == F.col("_a"))
    return one.select(*left.columns, *right.columns).unionAll(two.select(*left.columns, *right.columns))


def matches_prefix(name: Column, known: Column, n: int = 35) -> Column:
    """Whether a name matches one of an array of names by prefix."""
    return F.exists(known, lambda k: (k != "") & (name.startswith(F.left(k, F.lit(n))) | k.startswith(F.left(name, F.lit(n)))))


def numbered_terms(terms: Sequence[str] | DataFrame, spark: SparkSession, whole_word_max: int = 5) -> DataFrame:
    """(number, string, whole) of terms, given as a list or a frame `term` (with `whole`, if lengths don't decide)."""
    if not isinstance(terms, DataFrame):
        terms = spark.createDataFrame([(x,) for x in dict.fromkeys(terms)], "term string")
    whole = F.col("whole") if "whole" in terms.columns else F.char_length("term") <= whole_word_max
    return materialise(terms.where("term <> ''").groupBy("term").agg(F.first(whole).alias("whole")).select(F.monotonically_increasing_id().alias("number"), F.col("term").alias("string"), "whole"))


def term_hits(texts: DataFrame, text: str, terms: Sequence[str] | DataFrame, whole_word_max: int = 5, block: int | None = None, each: str = "line") -> DataFrame:
    """(row, line, term): a row for each line of a text (from 1) and each term in it, case aside; `row` has the other columns.

    Terms of at most `whole_word_max` characters hit whole words only.  One pass over the texts serves all terms (some millions of
    characters of them, or `block` terms) and no plan grows with their number.  A hit doesn't cross a line break.
    """
    strings = numbered_terms(terms, texts.sparkSession, whole_word_max)
    found = occurrences(texts, text, strings.where(~F.col("string").rlike(r"\R")), each, blind=True, most=block)
    return found.join(strings.select("number", F.col("string").alias("term")), "number").select("row", "line", "term")


def scan_terms(lines: DataFrame, text: str, terms: Sequence[str] | DataFrame, whole_word_max: int = 5) -> DataFrame:
    """A row for each (line, term) that hits, with all columns of the line."""
    found = term_hits(lines.withColumn("_scanned", F.col(text)), "_scanned", terms, whole_word_max, each="text")
    return found.select(*[F.col("row")[c].alias(c) for c in lines.columns], "term")


def scan_report(files: DataFrame, terms: Sequence[str] | DataFrame, text: str = "text", path: str = "path", block: int | None = None) -> tuple[DataFrame, int, int]:
    """(path, line, term) of every hit, line 0 for the path itself, the number of hits and of files; nothing scanned is an error, as nothing is certified then."""
    scanned = files.count()
    if not scanned:
        raise GateError("no files were scanned")
    names = files.select(F.col(path).alias("path"), F.col(path).alias("text"), F.lit(True).alias("name"))
    both = files.select(F.col(path).alias("path"), F.col(text).alias("text"), F.lit(False).alias("name")).unionAll(names)
    line = F.when(F.col("row")["name"], 0).otherwise(F.col("line")).cast("int").alias("line")
    out = materialise(term_hits(both, "text", terms, block=block).select(F.col("row")["path"].alias(path), line, "term"))
    return out, out.count(), scanned


def numbered_lines(files: DataFrame, text: str = "text", path: str = "path") -> DataFrame:
    """(path, line, content): line 0 is the path itself."""
    from gaugeworks.functions.text import lines as split

    body = files.select(path, F.posexplode(split(F.col(text))).alias("_i", "content")).select(path, (F.col("_i") + 1).alias("line"), "content")
    return body.unionAll(files.select(path, F.lit(0).alias("line"), F.col(path).alias("content")))


def audit_quotes(quotes: DataFrame, pages: DataFrame, key: str, quote: str, page: str) -> DataFrame:
    """Adds `found`: the squeezed quote stands in its page's squeezed text."""
    texts = pages.select(key, squash(F.col(page)).alias("_page"))
    return quotes.join(texts, key, "left").withColumn("found", F.coalesce(F.contains("_page", squash(F.col(quote))), F.lit(False))).drop("_page")


def _anchor_windows(batches: Iterator[pa.RecordBatch], inner: bool, known: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, texts in slices(batch.column(batch.num_columns - 1)):
            row, place, h = windows([t.encode() for t in texts], inner)
            if known is not None:
                some = np.flatnonzero(known[h & (len(known) - 1)])
                row, place, h = row[some], place[some], h[some]
            rows = pa.array(a + row)
            yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in batch.columns[:-1]), pa.array(place), pa.array(h)], [*batch.schema.names[:-1], "place", "h"])


def anchored(needles: DataFrame, hay: DataFrame) -> DataFrame:
    """(name, key, th) of needles (name, needle) whose rarest inner window stands in a text (key, th, text) with all of the needle around it.

    Rows of windows hold a hash and a place, never a text; of the texts' windows only those that some needle may have are
    made at all.  Of a needle's windows the one that fewest texts' places have names its candidates.
    """
    own = materialise(needles.select("name", "needle").mapInArrow(lambda b: _anchor_windows(b, True), "name long, place long, h long"))
    bins = own.select(F.col("h").bitwiseAND(F.lit(FILTER_BINS - 1)).cast("int").alias("bin")).distinct().toArrow().column(0).to_numpy()
    known = np.zeros(FILTER_BINS, bool)
    known[bins] = True
    sent = hay.sparkSession.sparkContext.broadcast(known)
    kinds = ", ".join(f"{c} {hay.schema[c].dataType.simpleString()}" for c in ("key", "th"))
    seen = hay.select("key", "th", "text").mapInArrow(lambda b: _anchor_windows(b, False, sent.value), f"{kinds}, place long, h long")
    seen = materialise(seen)
    counts = materialise(seen.groupBy("h").agg(F.count(F.lit(1)).alias("n")))
    anchors = materialise(own.join(counts, "h").groupBy("name").agg(F.min(F.struct("n", "place", "h")).alias("a")).select("name", F.col("a.place").alias("into"), F.col("a.h").alias("h")))
    at = seen.join(anchors, "h").select("key", "th", "name", (F.col("place") - F.col("into")).alias("begin")).where("begin >= 0")
    raw = lambda c: F.encode(c, "UTF-8")
    at = at.join(needles.select("name", raw("needle").alias("needle")), "name")
    same = F.substring(raw("text"), F.col("begin") + 1, F.octet_length("needle")) == F.col("needle")
    texts = hay.withColumnRenamed("key", "_key").withColumnRenamed("th", "_th")
    found = at.join(texts, F.col("key").eqNullSafe(F.col("_key")) & (F.col("th") == F.col("_th"))).where(same)
    return found.select("name", "key", "th").distinct()


def contained(needles: DataFrame, haystack: DataFrame, text: str, needle: str = "needle", name: str = "needle_id", key: str = "doc_id") -> DataFrame:
    """Pairs (name, key) of the needles that stand in a text, word borders or not; each row of either side counts on its own.

    A needle's words but the first and the last must be words of the text.  So where there are three of them or more, a
    window of three, the rarest in all texts, names the places to look at (`anchored`).  Shorter needles
    go through the texts in one automaton.  No text is copied for its words and no side is crossed with the other.
    """
    own = materialise(needles.where(F.col(needle) != "").select(F.col(name).alias("label"), F.col(needle).alias("needle")).withColumn("name", F.monotonically_increasing_id()))
    words = F.size(F.filter(F.split("needle", r"[\x09-\x0D ]+"), lambda w: w != ""))
    long, short = own.where(words >= 5), own.where(words < 5)
    hay = haystack.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    found = anchored(long, hay)
    rows = hay.groupBy("key", "th").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("key", "_key").withColumnRenamed("th", "_th")
    each = found.join(rows, F.col("key").eqNullSafe(F.col("_key")) & (F.col("th") == F.col("_th"))).select("name", "key", F.explode(F.sequence(F.lit(1), F.col("n"))))
    few = occurrences(hay.select("key", "text"), "text", short.select(F.col("name").alias("number"), F.col("needle").alias("string"), F.lit(False).alias("whole")), "text")
    both = each.select("name", "key").unionAll(few.select(F.col("number").alias("name"), F.col("row.key").alias("key")))
    return both.join(own.select("name", "label"), "name").select(F.col("label").alias(name), F.col("key").alias(key))
