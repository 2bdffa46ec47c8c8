"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are cut into blocks of BLOCK_DOCS.  While a set of sources lasts (a phase), a source
of weight w of a total W owns block i between its release floor(i * W / w) and its deadline
ceil((i + 1) * W / w); one block runs in each slot, the released one of the earliest deadline.  So at any
slot of a phase each source is less than one block from its weight's share of the phase's slots.  Weights are
exact whole numbers (rounded only where products pass 62 bits).  When a source ends, the others' weights
make up the whole and a new phase begins; no document is dropped or repeated.

Weights are whole numbers, so the choice of the earliest deadline repeats after a period of W slots.  The driver
knows one count for each source and plans at most one phase for each; it follows one period of a phase
(or the phase, if that is shorter) with a heap, one step for a block of BLOCK_DOCS documents, and keeps the state
at every RUN_SLOTS slots only.  From these states SQL makes the schedule, each run of slots on its own.  Ranks and slots
are SQL expressions; a source's ranks are made in two levels, by ranges of a hash and within them, so
that a source with most of the rows is no single task.

Edge cases: a null source is a source of its own; a weight that is missing is 1, of zero or less
means after all others; texts may be null; repeated rows keep their number; an empty table gives
an empty result; `mix_*` columns are made anew, all others stay whatever their names.
"""

from __future__ import annotations

import heapq
import json
import math
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import field, whole_rows

BLOCK_DOCS = 64
#: Slots that are scheduled in one piece; rows of a schedule that is still broadcast.
RUN_SLOTS = 1024
BROADCAST_ROWS = 1 << 17
_NULL = "\x00null"


def whole_weights(weights: dict[str, Fraction], blocks: int) -> dict[str, int]:
    """Whole numbers in the proportion of the weights, so small that their sum times `blocks` fits 62 bits."""
    scale = math.lcm(*[w.denominator for w in weights.values()])
    whole = {s: int(w * scale) for s, w in weights.items()}
    common = math.gcd(*whole.values())
    whole = {s: n // common for s, n in whole.items()}
    total, most = sum(whole.values()), (1 << 62) // (blocks + 2)
    return whole if total <= most else {s: max(1, n * most // (2 * total)) for s, n in whole.items()}


def follow(w: list[int], slots: int, run: int) -> tuple[list[list[int]], list[int]]:
    """Blocks of each source that the earliest deadline has first done at every `run` slots, and after all `slots`."""
    total, done, states = sum(w), [0] * len(w), []
    waiting = [(0, k) for k in range(len(w))]
    ready: list[tuple[int, int]] = []
    for t in range(slots):
        if t % run == 0:
            states.append(list(done))
        while waiting and waiting[0][0] <= t:
            _, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(done[k] + 1) * total // w[k]), k))
        _, k = heapq.heappop(ready)
        done[k] += 1
        heapq.heappush(waiting, (done[k] * total // w[k], k))
    return states, done


def phases(blocks: dict[str, int], weights: dict[str, float], run: int = RUN_SLOTS) -> list[dict]:
    """Phases in order: names, whole weights `w`, first blocks, `slots`, first slot `base`, and the states of its runs.

    A phase ends when its first source does.  Its last slot is a run of its own, as a source
    that ends within it may have no further block.
    """
    out: list[dict] = []
    base, first = 0, dict.fromkeys(blocks, 0)
    for tier in (True, False):  # sources without a positive weight come after the others
        left = {s: n for s, n in sorted(blocks.items()) if n and (weights.get(s, 1.0) > 0) == tier}
        if not left:
            continue
        whole = whole_weights({s: Fraction(str(weights.get(s, 1.0))) if tier else Fraction(1) for s in left}, sum(left.values()))
        while left:
            names, w, cap = list(left), [whole[s] for s in left], list(left.values())
            total = sum(w)
            slots = min(-(-n * total // x) for n, x in zip(cap, w))
            body = slots - 1
            period = min(total, body)
            states, done = follow(w, period, run)
            if body > period:
                done = [n + body // total * x for n, x in zip(follow(w, body % total, run)[1], w)]
            runs = [{"begin": k * run, "past": min(period, (k + 1) * run), "n": n, "last": False} for k, n in enumerate(states)]
            runs.append({"begin": body, "past": slots, "n": list(done), "last": True})
            out.append({"names": names, "w": w, "cap": cap, "first": [first[s] for s in names], "slots": slots, "base": base, "total": total, "runs": runs})
            _, k = min((-(-(n + 1) * total // x), k) for k, (n, x) in enumerate(zip(done, w)) if n < cap[k] and n * total // x <= body)
            done[k] += 1
            base += slots
            for s, n in zip(names, done):
                left[s] -= n
                first[s] += n
            left = {s: n for s, n in left.items() if n}
    return out


#: Earliest deadline first over the slots [begin, past) from the state `n`.
_EDF = """
  aggregate(
    sequence(begin, past - 1),
    named_struct('n', n, 'out', cast(array() as array<struct<d:bigint,s:int,i:bigint>>)),
    (state, t) -> element_at(transform(
      array(array_min(transform(w, (x, s) -> if((not last or get(state.n, s) < get(cap, s)) and (get(state.n, s) * total) div x <= t,
        named_struct('d', ((get(state.n, s) + 1) * total + x - 1) div x, 's', s, 'i', get(state.n, s)), null)))),
      e -> named_struct('n', transform(state.n, (y, j) -> if(j = e.s, y + 1, y)), 'out', concat(state.out, array(e)))), 1),
    state -> state.out)
"""


def schedule(spark, planned: list[dict]) -> DataFrame:
    """(mix_source, mix_block, slot, release, deadline): the slot of each block."""

    def read(rows: list[dict], kind: str) -> DataFrame:
        return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{kind}>>")).alias("x")).select("x.*")

    own = read([{k: v for k, v in p.items() if k != "runs"} | {"phase": i} for i, p in enumerate(planned)], "phase:int,names:array<string>,w:array<bigint>,cap:array<bigint>,first:array<bigint>,slots:bigint,base:bigint,total:bigint")
    runs = read([{"phase": i, **r} for i, p in enumerate(planned) for r in p["runs"]], "phase:int,begin:bigint,past:bigint,n:array<bigint>,last:boolean")
    df = runs.join(own, "phase").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "phase", "begin")
    df = df.select("names", "w", "first", "base", "slots", "total", "begin", "last", F.posexplode(F.expr(_EDF)).alias("t", "e"))
    # a period's slots come again until the last slot of the phase
    df = df.withColumn("turn", F.explode(F.expr("sequence(0L, if(last, 0L, (slots - 2 - begin - t) div total))")))
    df = df.withColumns({"x": F.expr("get(w, e.s)"), "i": F.expr("e.i + turn * get(w, e.s)")})
    return df.select(F.expr("get(names, e.s)").alias("mix_source"), F.expr("get(first, e.s) + i").alias("mix_block"), F.expr("base + begin + t + turn * total").alias("slot"), F.expr("base + (i * total) div x").alias("release"), F.expr("base + ((i + 1) * total + x - 1) div x").alias("deadline"))


def interleave(docs: DataFrame, weights: dict[str, float] | None = None, block_docs: int = BLOCK_DOCS, source_col: str = "source", id_cols: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """The input with mix_source, mix_block, mix_release, mix_deadline, mix_slot and mix_position (the order)."""
    spark = docs.sparkSession
    packed = whole_rows(docs)
    key = F.coalesce(field(source_col).cast("string"), F.lit(_NULL))
    counts = {r.s: r.n for r in packed.groupBy(key.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    planned = phases({s: -(-n // block_docs) for s, n in counts.items()}, {_NULL if k is None else k: w for k, w in (weights or {}).items()})
    # exact rank within a source, in two levels
    bits = max(6, math.ceil(math.log2(4 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))))
    rows = packed.withColumns({"mix_source": key, "_h": F.xxhash64(*map(field, id_cols)), "_row": F.monotonically_increasing_id()})
    rows = rows.withColumn("_range", F.shiftrightunsigned("_h", 64 - bits))
    ranges = rows.groupBy("mix_source", "_range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("mix_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    order = [F.expr("_h >= 0").desc(), F.col("_h"), *[field(c) for c in id_cols if c != "text"], F.col("_row")]
    ranked = rows.withColumn("_own", F.row_number().over(Window.partitionBy("mix_source", "_range").orderBy(*order)) - 1)
    ranked = ranked.join(ranges.select("mix_source", "_range", before.alias("_before")), ["mix_source", "_range"]).withColumn("_rank", F.col("_before") + F.col("_own"))
    ranked = ranked.withColumn("mix_block", F.expr(f"_rank div {block_docs}"))
    table = schedule(spark, planned).withColumnsRenamed({"slot": "_slot", "release": "_release", "deadline": "_deadline"})
    if sum(p["slots"] for p in planned) <= BROADCAST_ROWS:
        table = F.broadcast(table)
    joined = ranked.join(table, ["mix_source", "mix_block"])
    added = {
        "mix_source": F.col("mix_source"),
        "mix_block": F.col("mix_block"),
        "mix_release": F.col("_release"),
        "mix_deadline": F.col("_deadline"),
        "mix_slot": F.col("_slot"),
        "mix_position": F.col("_slot") * block_docs + F.col("_rank") % block_docs,
    }
    return joined.select(*[field(c).alias(c) for c in docs.columns if c not in added], *[x.alias(c) for c, x in added.items()])


def in_order(mixed: DataFrame, partitions: int | None = None) -> DataFrame:
    """The mix dealt to partitions by ranges of its order and sorted in each: files hold it in order."""
    n = partitions or int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartitionByRange(n, "mix_position").sortWithinPartitions("mix_position")
