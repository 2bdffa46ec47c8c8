"""Keyed joins with gates, upserts, classification, ranks, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.config import FALLBACK_TYPE, OVERRIDES, PATTERNS
from gaugeworks.session import materialise


#: Accuracy of the sketches that bracket quantiles, and values between a bracket's ends that are read.
SKETCH, FEW = 10_000, 20_000


class GateError(ValueError):
    """A check on cardinality or content failed."""


def left_join_indicator(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] = ()) -> DataFrame:
    """Left join on a key with `_merge`: both or left_only.  Spark picks the strategy by the sides' sizes."""
    side = right.select(key, *columns).withColumn("_seen", F.lit(True))
    return left.join(side, key, "left").withColumn("_merge", F.when(F.col("_seen"), "both").otherwise("left_only")).drop("_seen")


def unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key), key, "left_anti")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, count) of keys that occur more than once, in order."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(key)


def check_merge(joined: DataFrame, key: str, expected: int, inventory: DataFrame, listed: int = 20) -> None:
    """Raises unless the join has the expected rows, all matched, and the inventory no repeated key."""
    seen = joined.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_merge") == "left_only").alias("lost")).first()
    twice = duplicate_keys(inventory.where(F.col(key).isNotNull()), key).limit(listed).collect()
    if seen.n != expected or seen.lost or twice:
        lost = [r[key] for r in joined.where("_merge = 'left_only'").select(key).distinct().orderBy(key).limit(listed).collect()]
        raise GateError(f"expected {expected} rows, got {seen.n}; without a match: {lost}; more than once: {[r[key] for r in twice]}")


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise GateError(f"missing columns: {missing}")


def require_rows(df: DataFrame, expected: int | None = None) -> None:
    """The expected number of rows, or at least one."""
    if expected is None:
        if df.isEmpty():
            raise GateError("no rows")
    elif (n := df.count()) != expected:
        raise GateError(f"expected {expected} rows, got {n}")


def lookup_last(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """Left join on the last row of each key by `order`: one partial aggregate, no window."""
    others = [c for c in right.columns if c not in (key, order)]
    last = right.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_r")).select(key, *[F.col("_r")[c].alias(c) for c in others])
    return left.join(last, key, "left")


def upsert(new: DataFrame, old: DataFrame, key: str, group: str, carried: Sequence[str], status: str = "status", default: str = "indexed") -> DataFrame:
    """New rows; carried values of the old ones where the group is the same; an empty status is the default."""
    before = old.select(key, F.col(group).alias("_group"), *[F.col(c).alias(f"_{c}") for c in carried])
    same = F.col(group) == F.col("_group")
    out = new.join(before, key, "left")
    values = {c: F.coalesce(F.nullif(F.when(same, F.col(f"_{c}")), F.lit("")), F.lit("")) for c in carried}
    values[status] = F.coalesce(F.nullif(values.get(status, F.lit("")), F.lit("")), F.lit(default))
    return out.withColumns(values).drop("_group", *[f"_{c}" for c in carried])


def skip_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return todo.join(done.select(key), key, "left_anti")


def next_batch(todo: DataFrame, done: DataFrame, key: str, priority: str, n: int) -> DataFrame:
    """The next n by priority that aren't done: a top-k, not a sort."""
    return skip_done(todo, done, key).orderBy(F.col(priority).cast("int").asc_nulls_last(), key).limit(n)


def classify(df: DataFrame, fields: Sequence[str] = ("slug",), patterns=PATTERNS, overrides: dict | None = None, fallback: str = FALLBACK_TYPE, slug: str = "slug") -> DataFrame:
    """content_type, decision_content, matched_on: the first pattern in list order that hits; an override by exact slug comes first."""
    blob = F.lower(F.concat_ws(" ", *[F.col(f"`{c}`") for c in fields]))
    df = df.withColumn("_blob", blob)
    kind, decision, on = F.lit(fallback), F.lit(False), F.lit("")
    for name, pats, yes in reversed(patterns):
        for p in reversed(pats):
            hit = F.col("_blob").rlike(f"(?U){p}")
            kind, decision = F.when(hit, name).otherwise(kind), F.when(hit, F.lit(yes)).otherwise(decision)
            on = F.when(hit, F.regexp_extract("_blob", f"(?U)({p})", 1)).otherwise(on)
    for s, (name, yes) in (OVERRIDES if overrides is None else overrides).items():
        own = F.col(slug) == s
        kind, decision, on = F.when(own, name).otherwise(kind), F.when(own, F.lit(yes)).otherwise(decision), F.when(own, "override").otherwise(on)
    return df.withColumns({"content_type": kind, "decision_content": decision, "matched_on": on}).drop("_blob")


def value_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key)


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles (exact, linear) and max."""
    whole = df.agg(F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).alias("min"), F.max(column).alias("max"))
    return whole.crossJoin(quantiles(df, column, {"p25": 0.25, "p50": 0.5, "p75": 0.75})).select("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def quantiles(df: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """One row of exact quantiles, linear between neighbours; nulls don't count, without values all are null."""
    found = select_quantiles(df, {name: (column, share) for name, share in shares.items()})
    return df.sparkSession.createDataFrame([tuple(found.values())], ", ".join(f"`{n}` double" for n in found))


def select_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> dict[str, float | None]:
    """Exact quantiles of (column, share), linear between neighbours, by selection: no sort and no writes.

    A sketch of each column brackets the two ranks of each quantile; what lies below, at and between a
    bracket's ends is counted, so a bracket that missed is known and widened.  One with more than FEW values between its ends is bracketed
    again, among these alone.  At last the distinct values between the ends, few by then, are read with their counts.
    The rows are read once for each of these steps, for all quantiles together: three times in all, up to some 10^8 values.
    """
    names = list(wanted)
    v = {n: F.col(f"`{c}`").cast("double") for n, (c, _) in wanted.items()}
    cells = [x for n in names for x in (F.count(v[n]).alias(f"n_{n}"), F.min(v[n]).alias(f"min_{n}"), F.max(v[n]).alias(f"max_{n}"), F.percentile_approx(v[n], F.lit(_around(wanted[n][1])), SKETCH).alias(f"q_{n}"))]
    whole = df.agg(*cells).first()
    size = {n: whole[f"n_{n}"] for n in names}
    at = {n: wanted[n][1] * (size[n] - 1) for n in names if size[n]}
    ends = {n: tuple(whole[f"q_{n}"]) for n in at}
    for _ in range(12):
        counts = df.agg(*[F.count_if(x).alias(f"{k}_{n}") for n in at for k, x in _zones(v[n], *ends[n]).items()]).first() if at else None
        again = []
        for n, (low, high) in ends.items():
            below, edge, inner, top = (counts[f"{k}_{n}"] for k in ("below", "edge", "inner", "top"))
            first, last = int(at[n]), min(int(at[n]) + 1, size[n] - 1)
            if first < below or last >= below + edge + inner + top:  # the sketch missed
                ends[n] = whole[f"min_{n}"], whole[f"max_{n}"]
                again.append((n, None))
            elif inner > FEW and (last < below + edge or first >= below + edge + inner):  # both ranks are at one end
                ends[n] = (low, low) if last < below + edge else (high, high)
                again.append((n, None))
            elif inner > FEW:
                again.append((n, tuple(min(1.0, max(0.0, (k - below - edge) / inner)) for k in (first, last))))
        if not again:
            break
        narrow = [(n, x) for n, x in again if x]
        if narrow:
            inside = lambda n: F.when(_zones(v[n], *ends[n])["inner"], v[n])
            found = df.agg(*[F.percentile_approx(inside(n), F.lit([_around(x)[0], _around(y)[1]]), SKETCH).alias(n) for n, (x, y) in narrow]).first()
            for n, (x, y) in narrow:
                low, high = found[n]
                ends[n] = (ends[n][0] if x <= 2 / SKETCH else low, ends[n][1] if y >= 1 - 2 / SKETCH else high)
    else:
        raise GateError("quantiles were not found")  # each step leaves some 1/2,000 of the values between the ends
    out: dict[str, float | None] = dict.fromkeys(names)
    if not at:
        return out
    cases = F.array(*[F.when(_zones(v[n], *ends[n])["inner"], F.struct(F.lit(n).alias("name"), v[n].alias("v"))) for n in at])
    between: dict[str, list] = {n: [] for n in at}
    for r in df.select(F.explode(cases).alias("x")).where("x is not null").groupBy("x").agg(F.count(F.lit(1)).alias("n")).collect():
        between[r.x.name].append((r.x.v, r.n))
    for n, (low, high) in ends.items():
        first, last = int(at[n]), min(int(at[n]) + 1, size[n] - 1)
        steps = [(low, counts[f"edge_{n}"]), *sorted(between[n]), (high, counts[f"top_{n}"])]
        passed, values = counts[f"below_{n}"], {}
        for value, k in steps:
            for rank in (first, last):
                if passed <= rank < passed + k:
                    values[rank] = value
            passed += k
        x, y = values[first], values[last]
        out[n] = x + (y - x) * (at[n] - first)
    return out


def _around(share: float) -> list[float]:
    return [max(0.0, share - 2 / SKETCH), min(1.0, share + 2 / SKETCH)]


def _zones(v: Column, low: float, high: float) -> dict[str, Column]:
    """Below a bracket, at its low end, between its ends, at its high end (if that is another)."""
    low, high = F.lit(low), F.lit(high)
    return {"below": v < low, "edge": v == low, "inner": (v > low) & (v < high), "top": (v == high) & (low < high)}


def gaps(df: DataFrame, key: str, expected: Sequence[str], least: int = 1) -> DataFrame:
    """Expected values with fewer than `least` rows."""
    seen = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    want = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, expected))).alias(key))
    return want.join(seen, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") < least)


def share_above(df: DataFrame, key: str, group: str, share: float) -> DataFrame:
    """Keys that `share` of all groups have: (key, groups)."""
    pairs = df.where(F.col(key).isNotNull()).select(key, group).distinct()
    total = df.agg(F.count_distinct(group).alias("_total"))
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias("groups")).crossJoin(F.broadcast(total)).where(F.col("groups") >= share * F.col("_total")).drop("_total")


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """1..n in an order, without one task for all rows.

    The input is written first, as a range-partitioned sort reads it twice; so is the sort, and its
    partitions are numbered by their sizes, of which there are as many as partitions.
    """
    at = materialise(materialise(df).orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    low = (1 << 33) - 1
    sizes = at.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    offsets = sizes.select("_part", before.alias("_before"))
    rows = at.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(offsets), "_part")
    return rows.withColumn(name, (F.col("_before") + F.col("_at").bitwiseAND(F.lit(low)) + 1).cast("long")).drop("_part", "_before", "_at")


def gsc_signals(df: DataFrame, position: str, impressions: str, ctr: str) -> DataFrame:
    """striking_distance: a position in 5..20; low_ctr_high_impr: impressions above, rate below the medians."""
    mid = select_quantiles(df, {"i": (impressions, 0.5), "c": (ctr, 0.5)})
    out = df.withColumns({"_median_i": F.lit(mid["i"]), "_median_c": F.lit(mid["c"])})
    return out.withColumns({"striking_distance": F.col(position).between(5, 20), "low_ctr_high_impr": (F.col(impressions) > F.col("_median_i")) & (F.col(ctr) < F.col("_median_c"))}).drop("_median_i", "_median_c")


def status_after(old: Column, scored: Column, briefed: Column, owner_items: Column) -> Column:
    """indexed -> captured -> scored -> brief-draft / brief; a withdrawn score falls back to captured."""
    with_score = F.when(scored & F.coalesce(old, F.lit("")).isin("", "indexed", "captured"), "scored").when(~scored & (old == "scored"), "captured").otherwise(old)
    return F.when(briefed, F.when(owner_items > 0, "brief-draft").otherwise("brief")).otherwise(with_score)
