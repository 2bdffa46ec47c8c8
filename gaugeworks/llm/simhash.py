"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

A fingerprint is split into four 16-bit blocks.  Two fingerprints that differ in at most two bits
agree on two blocks at least, so each of the six pairs of blocks is a join key of 32 bits.

A key that many distinct fingerprints share is not joined pairwise.  There, two fingerprints at
distance two or less have a common point at distance one or less from each, so each of them is
dealt to the 33 points around its free half, and those that meet at a point are linked as a star:
the closure of the links is the same, and the rows grow linearly.

Edge cases: a null or wordless text has fingerprint zero and is linked like any other; exact
copies share one fingerprint row before any join; a null id counts only where a whole component
has no other; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import durable, field, whole_rows
from gaugeworks.llm.components import connected_components
from gaugeworks.llm.filters import filter_of, held, mixed
from gaugeworks.llm.textbatch import LOWER, Words, text_slices, xxh64

#: Distinct fingerprints of a block key that are still compared pairwise.
PAIRWISE = 64
#: Bins of the counts that order shingles by how common they are.
ORDER_BINS = 1 << 20
_MASKS = tuple(sum(0xFFFF << (16 * b) for b in pair) for pair in combinations(range(4), 2))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingle_hashes(buf: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of each text's word shingles in order, and how many each text has."""
    w = Words(buf, offs)
    joined, starts, lens = w.joined(buf)
    n = np.where(w.counts >= width, w.counts - width + 1, np.minimum(w.counts, 1))
    base = np.cumsum(w.counts) - w.counts
    take = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    last = take + np.repeat(np.minimum(w.counts, width) - 1, n)
    return xxh64(joined, starts[take], starts[last] + lens[last] - starts[take]), n


def majority(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A bit is set where more than half of a text's hashes have it.

    Eight counters of a byte are added as one 64-bit word, over runs of at most 255 hashes.
    """
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    n = n[full]
    first = np.cumsum(n) - n
    runs = -(-n // 255)
    run_of = np.cumsum(runs) - runs
    at = np.repeat(first - 255 * run_of, runs) + 255 * np.arange(int(runs.sum()))
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").view("<u8").reshape(-1, 8)
    sums = np.add.reduceat(bits, at, axis=0).view(np.uint8).reshape(-1, 64).astype(np.int64)
    counts = np.add.reduceat(sums, run_of, axis=0)
    out[full] = np.packbits(2 * counts > n[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the signed 64-bit fingerprint of each whole text's `width`-word shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for _, _, buf, offs in text_slices(batch.column(1)):
                made.append(majority(*shingle_hashes(LOWER[buf], offs, width)))
            fp = np.concatenate(made) if made else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, fp bigint")


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) whose closure is that of all pairs of the distinct `fp` at two bits or fewer."""
    keys = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("which"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(_MASKS)])).alias("k")).select("k.*", "fp")
    sizes = durable(keys.groupBy("which", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    few = keys.join(sizes.where(F.col("n") <= PAIRWISE).drop("n"), ["which", "key"], "left_semi")
    x, y = few.alias("x"), few.alias("y")
    pairs = x.join(y, F.expr("x.which = y.which and x.key = y.key and x.fp < y.fp and bit_count(x.fp ^ y.fp) <= 2")).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    many = keys.join(sizes.where(F.col("n") > PAIRWISE).drop("n"), ["which", "key"], "left_semi")
    free = [[b for b in range(64) if not m >> b & 1] for m in _MASKS]
    flips = F.array(*[F.array(*[F.lit(_signed(x)).cast("long") for x in (0, *(1 << b for b in bits))]) for bits in free])
    points = many.select("which", "fp", F.explode(F.get(flips, F.col("which"))).alias("flip")).select("which", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    stars = points.groupBy("which", "point").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = points.join(stars.drop("n"), ["which", "point"]).select("a", F.col("fp").alias("b"))
    return pairs.unionAll(met).where("a <> b and bit_count(a ^ b) <= 2").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest id that links reach."""
    prints = durable(fingerprints(docs, width, id_col, text_col))
    fps = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(links(fps))
    member = roots.join(fps, roots["node"] == fps["fp"]).select("root", "fp", "least")
    linked = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(linked, "root").select("fp", "component_id")
    of_fp = fps.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return prints.join(of_fp, "fp").select("doc_id", "fp", "component_id")


#: Words of a long fingerprint; blocks that a set is found by at each of its two levels, at least.
WORDS, KEYS = 16, 24
#: Standard deviations over the expected distance at which a pair is still proposed.
SLACK = 3.0


def distinct_hashes(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashes in order, and how many each text has."""
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(n))


def set_ids(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64-bit ids of sets of distinct hashes."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(h), dtype=np.uint64)])
        ends = np.cumsum(n)
        return mixed(sums[ends] - sums[ends - n], n.astype(np.uint64)).view(np.int64)


def levels(similarity: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Least sizes of the size classes up to `most`, and the blocks of each level.

    Sets of this similarity or more are in one class or in neighbouring ones.  At level k meet the
    sets of classes k - 1 and k; such a pair differs in at most D hashes, so of D + 1 blocks one is equal.
    """
    least = [1, 2]
    while least[-1] <= most:
        least.append(max(least[-1] + 1, int(np.ceil(least[-1] / similarity - 1e-9))))
    least.append(int(np.ceil(least[-1] / similarity)))
    least = np.array(least)
    return least, (2 * (least[1:] - 1) * (1 - similarity) / (1 + similarity) + 1e-9).astype(np.int64) + 1


def block_keys(h: np.ndarray, n: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each set's blocks, and how many each set has.  Blocks are parts of the hashes' space.

    Small sets are cut anew until they have KEYS blocks, as a block may hold nothing; of large
    ones KEYS blocks are read, of about (1 + similarity) / (2 - 2 * similarity) hashes each, so the rows don't grow with a text.
    """
    least, blocks = levels(similarity, int(n.max(initial=1)))
    kind = np.searchsorted(least, n, "right") - 1
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for level in (kind, kind + 1):
        parts = np.where(n > 0, blocks[np.minimum(level, len(blocks) - 1)], 1)
        turns = np.where(parts > 1, -(-KEYS // parts), 0)
        for turn in range(int(turns.max(initial=0))):
            sets = turns > turn
            rows = np.repeat(sets, n)
            doc = np.repeat(np.arange(len(n)), n)[rows]
            with np.errstate(over="ignore"):
                x = h[rows] * np.uint64((2 * turn * 0x9E3779B97F4A7C15 + 1) & ((1 << 64) - 1))
                part = (((x >> np.uint64(32)) * parts[doc].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
                read = (part < KEYS) | (parts[doc] < KEYS)
                doc, part, x = doc[read], part[read], mixed(h[rows][read])
                at = doc * (2 * KEYS) + part
                sums = np.zeros(len(n) * 2 * KEYS, np.uint64)
                np.add.at(sums, at, x)
            some = np.unique(at)
            doc = some // (2 * KEYS)
            keys.append(mixed(sums[some], (level[doc] * 4096 + turn * 64 + some % (2 * KEYS)).astype(np.uint64)))
            owners.append(doc)
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    return keys[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(n))


def long_prints(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """WORDS independent 64-bit fingerprints of each set."""
    sig = np.empty((len(n), WORDS), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WORDS):
            x = (h + np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(29)
            x *= np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(32)
            sig[:, k] = majority(x, n)
    return sig


def _lists(values: np.ndarray, n: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(values.view(np.int64)))


def block_prints(docs: DataFrame, width: int, similarity: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, sid, keys): of each row the text's hash, the id of its set of distinct shingles and the set's block keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offs in text_slices(batch.column(2)):
                h, n = distinct_hashes(*shingle_hashes(LOWER[buf], offs, width))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(a, b - a) for k in (0, 1)), pa.array(set_ids(h, n)), _lists(*block_keys(h, n, similarity))], ["doc_id", "th", "sid", "keys"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, th bigint, sid bigint, keys array<bigint>")


def shingle_sets(docs: DataFrame, wanted: DataFrame, width: int, text_col: str = "text") -> DataFrame:
    """(sid, sig, hashes): long fingerprint and hashes of the sets whose `sid` is wanted, and of few others that a filter lets through."""
    sent = docs.sparkSession.sparkContext.broadcast(filter_of(wanted.select(F.xxhash64("sid").alias("x"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, offs in text_slices(batch.column(0)):
                h, n = distinct_hashes(*shingle_hashes(LOWER[buf], offs, width))
                sid = set_ids(h, n)
                ok = held(sent.value, mixed(sid))
                h, n = h[np.repeat(ok, n)], n[ok]
                yield pa.RecordBatch.from_arrays([pa.array(sid[ok]), _lists(long_prints(h, n).ravel(), np.full(len(n), WORDS)), _lists(h, n)], ["sid", "sig", "hashes"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "sid bigint, sig array<bigint>, hashes array<bigint>")
    return found.groupBy("sid").agg(F.first("sig").alias("sig"), F.first("hashes").alias("hashes"))


def most_bits(similarity: float) -> int:
    """Bits of a long fingerprint in which sets of this Jaccard similarity differ, SLACK deviations over what is expected."""
    bits, p = 64 * WORDS, np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return int(bits * p + SLACK * np.sqrt(bits * p * (1 - p)))


def far(x: str, y: str) -> F.Column:
    """Bits in which two long fingerprints differ."""
    return sum((F.bit_count(F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))) for k in range(1, WORDS)), F.bit_count(F.get(x, F.lit(0)).bitwiseXOR(F.get(y, F.lit(0)))))


def near_in_fingerprint(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The distinct pairs (a, b) whose long fingerprints don't rule the similarity out."""
    one, two = sets.select(F.col("sid").alias("a"), F.col("sig").alias("x")), sets.select(F.col("sid").alias("b"), F.col("sig").alias("y"))
    return pairs.distinct().join(one, "a").join(two, "b").where(far("x", "y") <= most_bits(similarity)).select("a", "b")


def alike(near: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of this Jaccard similarity or more."""
    x, y = sets.select(F.col("sid").alias("a"), F.col("hashes").alias("x")), sets.select(F.col("sid").alias("b"), F.col("hashes").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return near.join(x, "a").join(y, "b").where(both / (F.size("x") + F.size("y") - both) >= similarity).select("a", "b")


def still_apart(met: DataFrame, found: DataFrame) -> DataFrame:
    """Rows whose member `sid` and `first` are in different components.  met: a row for each such pair, however many keys both have."""
    of = lambda c, r: found.select(F.col("node").alias(c), F.col("root").alias(r))
    both = met.join(of("sid", "_r"), "sid", "left").join(of("first", "_q"), "first", "left")
    return both.where(F.coalesce("_r", "sid") != F.coalesce("_q", "first")).drop("_r", "_q")


def with_roots(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members (key, sid, ...) of keys with their components so far, `root`."""
    return members.join(found.select(F.col("node").alias("sid"), "root"), "sid", "left").select(*members.columns, F.coalesce("root", "sid").alias("root"))


def mixed_keys(at: DataFrame) -> DataFrame:
    """(key, main, others) of keys with several components: the largest of them, and how many members are outside it."""
    sizes = at.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    return split.select("key", F.col("top.root").alias("main"), (F.col("n") - F.col("top.n")).alias("others"))


_APART = "x.key = y.key and x.root <> y.root and (y.root = y.main or x.sid < y.sid)"
_PAIR = ("least(x.sid, y.sid) as a", "greatest(x.sid, y.sid) as b")


def open_pairs(at: DataFrame, split: DataFrame, keys: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) that share a key of `split`, are in different components and whose long fingerprints don't rule the similarity out.

    Each is made once, at the least key that it shares.  at: (key, sid, root); keys: (sid, keys).
    """
    at = durable(at.join(split.select("key", "main"), "key").join(sets.select("sid", "sig"), "sid").join(keys.select("sid", "keys"), "sid"))
    x, y = at.where("root <> main").alias("x"), at.alias("y")
    pairs = x.join(y, F.expr(_APART) & (far("x.sig", "y.sig") <= most_bits(similarity)) & F.expr("array_min(array_intersect(x.keys, y.keys)) = x.key"))
    return pairs.selectExpr(*_PAIR)


def rare_prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(key, sid, rank, size): each set's rarest hashes, so many that two sets of this similarity or more have one of them in common.

    Of n hashes in one order for all sets, similar sets share one among the first n - ceil(similarity * n) + 1.  Any order
    will do; hashes that many of the sets have come last, by counts in ORDER_BINS bins, so what unrelated
    texts share is in no prefix unless a text has little else.  `rank` is a hash's place in its set's order, from 0.
    """
    counted = sets.select(F.explode("hashes").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bins = counted.groupBy(F.col("h").bitwiseAND(F.lit(ORDER_BINS - 1)).cast("int").alias("bin")).agg(F.max("n").alias("n")).toArrow()
    weight = np.ones(ORDER_BINS, np.int64)
    weight[bins.column(0).to_numpy()] = bins.column(1).to_numpy()
    sent = sets.sparkSession.sparkContext.broadcast(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offs = lists.offsets.to_numpy().astype(np.int64)
            h, n = lists.values.to_numpy()[offs[0] : offs[-1]], np.diff(offs)
            doc = np.repeat(np.arange(len(n)), n)
            h = h[np.lexsort((h, sent.value[h & (ORDER_BINS - 1)], doc))]
            first = n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1
            rank = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
            keep = rank < np.minimum(first, n)[doc]
            yield pa.RecordBatch.from_arrays([pa.array(h[keep]), batch.column(0).take(pa.array(doc[keep])), pa.array(rank[keep]), pa.array(n[doc[keep]])], ["key", "sid", "rank", "size"])

    return sets.select("sid", "hashes").mapInArrow(run, "key bigint, sid bigint, rank bigint, size bigint")


def prefix_pairs(sets: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs (a, b) of the sets that share a hash of their prefixes and are in different components.

    At the first hash in the order that two sets share, all that they have in common is still to come: of n and m hashes
    at least (n + m) * similarity / (1 + similarity).  So a pair counts only where both ranks leave that many, and in the
    smaller set (of `brief` rows) the rank is below about a half of the prefix.  Copies of one text that each
    differ from it too much have what they share at higher ranks, and don't meet.
    Where sets have their long fingerprint `sig`, those that it rules out are left out within the join.
    """
    at = durable(with_roots(rare_prefixes(sets, similarity), found))
    at = at.join(mixed_keys(at), "key")
    share = similarity / (1 + similarity)
    close = F.expr(f"least(x.size - x.rank, y.size - y.rank) >= (x.size + y.size) * {share!r}D - 1e-6D")
    if "sig" in sets.columns:
        at, close = at.join(sets.select("sid", "sig"), "sid"), close & (far("x.sig", "y.sig") <= most_bits(similarity))
    at = durable(at.withColumn("brief", F.expr(f"size - rank >= 2 * size * {share!r}D - 1e-6D")))
    # x is the smaller set; those of the largest component are held against the others alone
    meet = F.expr("x.key = y.key and x.root <> y.root and struct(x.size, x.sid) < struct(y.size, y.sid)") & close
    brief = at.where("brief")
    pairs = [brief.where(x).alias("x").join(at.where(y).alias("y"), meet) for x, y in (("root <> main", "true"), ("root = main", "root <> main"))]
    return pairs[0].selectExpr(*_PAIR).unionAll(pairs[1].selectExpr(*_PAIR)).distinct()


def similar_components(blocks: DataFrame, docs: DataFrame, similarity: float, width: int, text_col: str = "text") -> DataFrame:
    """(node, root) of distinct shingle sets (sid, keys) that links of a Jaccard similarity join.

    First stars: a key's members are held against one of them, that which meets most others over all
    keys, as the original of a group of copies does; a member first against the most met of all its
    keys, then against those to which no link joins it yet.  Members of keys of more than PAIRWISE that are
    still apart from it form the next round, while rounds at least halve them.  Then all pairs that share a key and that
    no link has joined are judged.  In keys with at most PAIRWISE members outside their largest component
    these are compared with the key's others by fingerprints, which makes rows only of pairs that are close in them.
    Larger keys hold texts that share some passage and little else; their members are dealt
    anew by their rarest shingles (`rare_prefixes`), which loses no similar pair and brings no two together that share the passage alone.
    """
    keys = blocks.select("sid", F.explode("keys").alias("key"))
    sizes = durable(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = durable(keys.join(sizes, "key").select("key", "sid", "n"))
    sets = durable(shingle_sets(docs, members.select("sid").distinct(), width, text_col))
    close = lambda pairs: alike(durable(near_in_fingerprint(pairs, sets, similarity)), sets, similarity)
    degree = durable(members.groupBy("sid").agg(F.sum(F.col("n") - 1).alias("met")))
    best = F.max(F.struct("met", F.xxhash64("key", "sid").alias("tie"), "sid")).alias("best")
    links, live, before = None, members, None
    while True:
        firsts = live.join(degree, "sid").groupBy("key").agg(best).select("key", F.col("best.sid").alias("first"), F.col("best.met").alias("top"))
        met = durable(live.join(firsts, "key").where("sid <> first"))
        # sets that share many keys have one first in most of them: judged once
        once = durable(met.groupBy("sid", "first").agg(F.max("top").alias("top"), F.max("n").alias("n")))
        # each member's most met first, before all its others: links of a large group come from its original
        chosen = once.groupBy("sid").agg(F.max(F.struct("top", "first")).alias("c")).select(F.col("sid").alias("a"), F.col("c.first").alias("b"))
        made = close(chosen)
        links = durable(made if links is None else links.unionAll(made))
        apart = durable(still_apart(once, connected_components(links)))
        links = durable(links.unionAll(close(apart.select(F.col("sid").alias("a"), F.col("first").alias("b")))))
        found = connected_components(links)
        still = still_apart(apart.where("n > 2"), found).select("sid", "first")
        rest = durable(met.where("n > 2").join(still, ["sid", "first"], "left_semi").select("key", "sid"))
        again = rest.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PAIRWISE)
        live = durable(rest.join(again, "key"))
        left = live.count()
        if not left or before is not None and 2 * left > before:
            break
        before = left
    at = durable(with_roots(members.select("key", "sid"), found))
    split = durable(mixed_keys(at))
    few = open_pairs(at, split.where(F.col("others") <= PAIRWISE), blocks, sets, similarity)
    links = durable(links.unionAll(alike(durable(few), sets, similarity)))
    many = durable(at.join(split.where(F.col("others") > PAIRWISE), "key", "left_semi").select("sid").distinct())
    if not many.isEmpty():
        dealt = durable(sets.join(many, "sid", "left_semi"))
        links = durable(links.unionAll(alike(durable(prefix_pairs(dealt, found, similarity)), sets, similarity)))
    return connected_components(links)


def similar_groups(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, n, least): each distinct id and text hash, its rows, and its component's least (no_id, doc_id, th).

    At two bits of 64 only texts of a similarity near one are found.  Here the blocks are parts of
    the space of the distinct shingles' hashes, and the pigeonhole holds for the similarity itself: see `levels`.
    Pairs that share a block are compared by long fingerprints and decided by the Jaccard similarity of
    their distinct shingles' 64-bit hashes.
    """
    prints = durable(block_prints(docs, width, similarity, id_col, text_col).groupBy("doc_id", "th", "sid").agg(F.first("keys").alias("keys"), F.count(F.lit(1)).alias("n")))
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    blocks = durable(prints.groupBy("sid").agg(F.first("keys").alias("keys"), F.min(own).alias("least")))
    roots = similar_components(blocks, docs, similarity, width, text_col)
    member = roots.join(blocks.select("sid", "least"), roots["node"] == blocks["sid"]).select("root", "sid", "least")
    named = member.join(member.groupBy("root").agg(F.min("least").alias("whole")), "root").select("sid", "whole")
    of_sid = blocks.select("sid", "least").join(named, "sid", "left").select("sid", F.coalesce("whole", "least").alias("least"))
    return prints.select("doc_id", "th", "n", "sid").join(of_sid, "sid").select("doc_id", "th", "n", "least")


def similar_documents(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component_id) of each distinct id and text; component_id is the smallest id that links reach."""
    return similar_groups(docs, width, similarity, id_col, text_col).select("doc_id", F.col("least.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input without near-duplicates: of each component, one row of the smallest id stays.

    Rows are told apart by id and text: different texts under one id, or without an id, each stay
    unless they are near-duplicates; of several texts of the smallest id in one component that of the
    smallest hash stays, of equal rows any.  Null and wordless texts are one component.  Columns stay as they are.
    """
    found = similar_groups(docs, width, similarity, id_col, text_col)
    stay = durable(found.where(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th") == F.col("least")).select(F.col("doc_id").alias("_stays"), F.col("th").alias("_hash"), F.col("n").alias("_n")))
    rows = whole_rows(docs).withColumns({"_id": field(id_col), "_th": F.xxhash64(field(text_col))})
    rows = rows.join(stay, F.col("_id").eqNullSafe(F.col("_stays")) & (F.col("_th") == F.col("_hash")))
    return rows.where("_n = 1").select("_all.*").unionAll(rows.where("_n > 1").dropDuplicates(["_id", "_th"]).select("_all.*"))


def hex_fingerprint(col: str = "fp") -> F.Column:
    return F.lower(F.lpad(F.hex(col), 16, "0"))
