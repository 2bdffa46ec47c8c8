"""Rule bitmask ledger: every rule is evaluated once and leaves one bit and its measurements.

Policies are versioned masks over those bits, so a new policy, or an ablation of an old one, is
bitwise arithmetic over the stored ledger and never reads a text again.

All of it is DataFrame expressions; a document never leaves its row, so there is no shuffle.

Edge cases: a null text counts as an empty one (no words, fails `few_words`); repeated rows are
judged each on its own; an empty table gives an empty ledger; other columns of the input are
ignored, whatever their names; texts of over 2**24 words take the exact slower path.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import WS_CHARS, WS_CLASS

#: Low bits of a window key that hold the position of the window.
POSITION_BITS = 24
_LOW = (1 << POSITION_BITS) - 1


@dataclass(frozen=True)
class Rule:
    """A named bit; `fails` is SQL over the measurement columns."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule(5, "capitals", "100 * n_upper > 40 * n_letters"),
    Rule(6, "short_lines", "n_words < 2 * n_lines"),
)

#: Policy version -> names of the rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "duplicate_lines"),
    "v2": tuple(r.name for r in RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[n] for n in set(names))


def _covered(positions: Column) -> Column:
    """Words covered by 3-word windows that start at these sorted positions."""
    last = F.size(positions) - 1
    steps = F.transform(positions, lambda p, j: F.when(j < last, F.least(F.lit(3), F.get(positions, j + 1) - p)).otherwise(3).cast("long"))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def _hashes(words: Column) -> Column:
    """A 64-bit hash for each 3-word window."""
    n = F.size(words)
    return F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(F.array().cast("array<bigint>"))


def _window_keys(hashes: Column) -> Column:
    """Sorted longs: 40 bits of the window's hash, then its position.  Primitive sort, no objects.

    Most texts repeat no window; the primitive distinct count finds that and skips the rest.
    """
    some = (F.size(F.array_distinct(hashes)) < F.size(hashes)) & (F.size(hashes) <= _LOW)
    key = lambda h, i: h.bitwiseAND(F.lit(~_LOW)).bitwiseOR(i.cast("long"))
    return F.when(some, F.sort_array(F.transform(hashes, key))).otherwise(F.array().cast("array<bigint>"))


def _same(a: Column, b: Column) -> Column:
    return F.shiftright(a, POSITION_BITS) == F.shiftright(b, POSITION_BITS)


def _clash(keys: Column, words: Column) -> Column:
    """Whether two neighbours share the 40 bits but not the words."""

    def differ(k: Column, j: Column) -> Column:
        before = F.get(keys, j - 1)
        p, q = k.bitwiseAND(F.lit(_LOW)).cast("int"), before.bitwiseAND(F.lit(_LOW)).cast("int")
        unequal = (F.get(words, p) != F.get(words, q)) | (F.get(words, p + 1) != F.get(words, q + 1)) | (F.get(words, p + 2) != F.get(words, q + 2))
        return F.when((j > 0) & _same(k, before), unequal).otherwise(F.lit(False))

    return F.size(F.filter(keys, differ)) > 0


def _repeat_fast(keys: Column) -> Column:
    last = F.size(keys) - 1
    dup = F.filter(keys, lambda k, j: F.coalesce(F.when(j > 0, _same(F.get(keys, j - 1), k)), F.lit(False)) | F.coalesce(F.when(j < last, _same(F.get(keys, j + 1), k)), F.lit(False)))
    return F.sort_array(F.transform(dup, lambda k: k.bitwiseAND(F.lit(_LOW)).cast("int")))


def _repeat_exact(words: Column) -> Column:
    """The same positions from the words themselves, for clashes of hashes and gigantic texts."""
    n = F.size(words)
    rows = F.array_sort(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"), i.alias("i"))))
    runs = F.aggregate(
        rows,
        F.struct(F.lit(None).cast("struct<a:string,b:string,c:string,i:int>").alias("p"), F.array().cast("array<int>").alias("o")),
        lambda s, x: F.struct(
            x.alias("p"),
            F.when((s.p.a == x.a) & (s.p.b == x.b) & (s.p.c == x.c), F.concat(s.o, F.array(s.p.i, x.i))).otherwise(s.o).alias("o"),
        ),
        lambda s: F.sort_array(F.array_distinct(s.o)),
    )
    return F.when(n >= 3, runs).otherwise(F.array().cast("array<int>"))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and measurements.  Stacked projections: each array is made once and then referred to."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    df = df.withColumns(
        {
            "w": F.when(F.btrim("t", F.lit(WS_CHARS)) == "", F.array().cast("array<string>")).otherwise(F.split(F.btrim("t", F.lit(WS_CHARS)), f"{WS_CLASS}+")),
            "l": F.filter(F.split("t", "\n"), lambda x: F.trim(x, F.lit(WS_CHARS)) != ""),
            "n_symbols": F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_upper": F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long"),
        }
    )
    df = df.withColumns({"h": _hashes(F.col("w")), "joined": F.array_join("w", "")})
    df = df.withColumn("k", _window_keys(F.col("h")))
    df = df.withColumn("p", F.when((F.size("w") > _LOW) | _clash(F.col("k"), F.col("w")), _repeat_exact(F.col("w"))).otherwise(_repeat_fast(F.col("k"))))
    return df.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.char_length("joined").cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("p")).alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        "n_upper",
        F.char_length(F.regexp_replace("joined", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
    )


def build_ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements plus `failure_bits`: bit r.bit is set where rule r fails."""
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, id_col, text_col).withColumn("failure_bits", bits)


def apply_policy(ledger: DataFrame, policy: str, policies: dict = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds `base_failed`, `kept` and `policy` from stored bits."""
    hit = lambda names: F.col("failure_bits").bitwiseAND(F.lit(mask(names, rules)).cast("long")) != 0
    failed = hit(policies["base"])
    return ledger.withColumns({"base_failed": failed, "kept": ~failed & ~hit(policies[policy]), "policy": F.lit(policy)})


def ablate(ledger: DataFrame, policy: str, policies: dict = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of a policy: documents it rejects, and those that only it rejects.

    Counts by bit pattern first, so at most 2**rules rows pass the shuffle for each task.
    """
    whole = mask(policies[policy], rules)
    patterns = ledger.groupBy(F.col("failure_bits").bitwiseAND(F.lit(whole).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    own = [r for r in rules if r.name in policies[policy]]
    rows = patterns.select("n", "bits", F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in own])).alias("r"))
    return rows.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("rejected"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only_this_rule"),
    )
