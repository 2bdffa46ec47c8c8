"""Ranked lexical search: a blocked sparse matrix product of items and documents.

A is the multiplicity of each term in each item, B the impact of each term in each document (64-bit whole numbers), and
the scores are A x B.  Documents' texts are read once: each gives one sparse column of B, its query terms with their
counts, written with the number of its terms.  From that table come the numbers of documents and terms and
each term's document frequency, over all documents, and from those the weights.

The product runs in blocks of documents.  Each block's columns are turned into rows by term; after
Gustavson, an item's score row is the sum of the rows of its terms, merged in a dense accumulator of the
block.  Of a row the `k` best are kept, those of a task's blocks are merged there, and those of all tasks
in two levels, so that an item's rows never meet in one task while there are many.

Items travel with the tasks: blocks of about BLOCK_ENTRIES (item, term) pairs at most, or a single item, each with a pass of
its own.  Terms are found by hash and compared byte for byte.

Ranking: the term weight is floor(1000 ln((2N + 2) / (2 df + 1))); a document of n terms has m = 75 + 25 n N div L; a
term that occurs tf times counts 10^9 tf div (1000 tf + 12 m) of its weight, as often as the item repeats it.

Edge cases: a null, empty or termless text is no document of N and is never found; an item without terms finds
nothing; texts of any length are read whole; equal scores go by ascending doc_id, a null id last; repeated rows
of documents are ranked each on its own, as are repeated items; without documents or items the result is empty;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import durable
from gaugeworks.llm.textbatch import LOWER, Words, text_slices, xxh64

#: (item, term) pairs that travel with the tasks of one pass.
BLOCK_ENTRIES = 1 << 20
#: Documents of a block at least, where a task has as many.
BLOCK_DOCS = 1 << 14
#: Groups of tasks in which an item's best are merged first.
MERGE_GROUPS = 64
#: Bytes that part terms: ASCII but for digits and letters.  All of a longer UTF-8 sequence is term.
APART = np.zeros(256, bool)
APART[:128] = True
APART[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def terms(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, Words]:
    """The lower-cased buffer, 8 bytes longer, and its terms."""
    found = Words(buf, offs, APART)
    out = np.zeros(len(buf) + 8, np.uint8)
    out[:-8] = LOWER[buf]
    return out, found


def item_entries(items: DataFrame, text: str, item_id: str) -> DataFrame:
    """(_item, item_id, term, times): the terms of each item; `_item` numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offs in text_slices(batch.column(2)):
                low, found = terms(buf, offs)
                raw = low.tobytes()
                pairs: dict[tuple[int, str], int] = {}
                for d, s, e in zip(found.doc.tolist(), found.starts.tolist(), found.ends.tolist()):
                    key = d, raw[s:e].decode()
                    pairs[key] = pairs.get(key, 0) + 1
                rows = pa.array([a + d for d, _ in pairs], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array([t for _, t in pairs], pa.string()), pa.array(list(pairs.values()), pa.int64())], ["_item", "item_id", "term", "times"])

    numbered = durable(items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")).withColumn("_item", F.monotonically_increasing_id()))
    return durable(numbered.select("_item", "item_id", "text").mapInArrow(run, "_item long, item_id long, term string, times long"))


class Vocabulary:
    """The terms of a block of items, found by hash and told apart by their bytes."""

    def __init__(self, names: list[str]):
        raw = [x.encode() for x in names]
        lens = np.array([len(x) for x in raw], np.int64)
        starts = np.cumsum(lens) - lens
        self.bytes = np.frombuffer(b"".join(raw) + bytes(8), np.uint8)
        hashes = xxh64(self.bytes, starts, lens)
        self.order = np.argsort(hashes, kind="stable").astype(np.int32)
        self.hashes, self.starts, self.lens = hashes[self.order], starts[self.order], lens[self.order]
        if len(self.hashes) > 1 and (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two terms have one hash")  # of 2^64; a seed of xxh64 would part them

    def find(self, low: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the ranges are terms, and their numbers."""
        hashes = xxh64(low, starts, lens)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero((self.hashes[at] == hashes) & (self.lens[at] == lens))
        at = at[hit]
        same = np.ones(len(hit), bool)
        size = lens[hit]
        begin = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(begin, size)
        differ = low[np.repeat(starts[hit], size) + step] != self.bytes[np.repeat(self.starts[at], size) + step]
        if differ.any():
            same[np.repeat(np.arange(len(hit)), size)[differ]] = False
        return hit[same], self.order[at[same]]


def document_columns(docs: DataFrame, words: Vocabulary, text: str, doc_id: str) -> DataFrame:
    """(doc_id, n, terms, counts) of every document: its number of terms, and which of the vocabulary's it has how often."""
    size = len(words.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offs in text_slices(batch.column(1)):
                low, found = terms(buf, offs)
                hit, number = words.find(low, found.starts, found.ends - found.starts)
                key, count = np.unique(found.doc[hit] * size + number, return_counts=True)
                ends = np.searchsorted(key, np.arange(b - a + 1) * size).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (key % size, count)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(found.counts.astype(np.int64)), *lists], ["doc_id", "n", "terms", "counts"])

    return durable(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>"))


def weights(columns: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """Each term's weight, and N and L: of all documents."""
    whole = columns.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    out = np.zeros(size, np.int64)
    for r in columns.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        out[r.t] = math.floor(1000 * math.log((2 * whole.n + 2) / (2 * r.df + 1)))
    return out, whole.n, whole.l


def by_score(score: np.ndarray, lost: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then least id, null last."""
    if len(score) > k:
        near = np.flatnonzero(score >= np.partition(score, -k)[-k])
        return near[np.lexsort((doc[near], lost[near], -score[near]))][:k]
    return np.lexsort((doc, lost, -score))


class Product:
    """Score rows of a block of items over blocks of documents, and the k best of each so far."""

    def __init__(self, entries: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, n: int, l: int, k: int):  # noqa: E741
        self.entries, self.weight, self.n, self.l, self.k = entries, weight, n, max(l, 1), k
        none = np.zeros(0, np.int64)
        self.best = [(none, none.astype(bool), none)] * len(entries)

    def add(self, doc: np.ndarray, lost: np.ndarray, length: np.ndarray, offs: np.ndarray, term: np.ndarray, count: np.ndarray) -> None:
        """One block: documents with `term` and `count` between their offsets."""
        m = 75 + (25 * length * self.n) // self.l
        column = np.repeat(np.arange(len(doc)), np.diff(offs))
        count = count.astype(np.int64)
        value = self.weight[term] * ((1_000_000_000 * count) // (1000 * count + 12 * m[column]))
        order = np.argsort(term, kind="stable")
        column, value = column[order], value[order]
        row = np.searchsorted(term[order], np.arange(len(self.weight) + 1))
        merged = np.zeros(len(doc), np.int64)
        for i, (own, times) in enumerate(self.entries):
            merged[:] = 0
            for t, x in zip(own.tolist(), times.tolist()):
                a, b = row[t], row[t + 1]
                if a < b:  # a term has a document once at most, so no two of these fall together
                    merged[column[a:b]] += value[a:b] if x == 1 else x * value[a:b]
            score, unknown, known = self.best[i]
            least = score[-1] if len(score) == self.k else 1
            near = np.flatnonzero(merged >= least)
            if len(near):
                score, unknown, known = (np.concatenate(x) for x in ((score, merged[near]), (unknown, lost[near]), (known, doc[near])))
                top = by_score(score, unknown, known, self.k)
                self.best[i] = score[top], unknown[top], known[top]


def search(docs: DataFrame, items: DataFrame, k: int = 20, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, scores above 0 only."""
    entries = item_entries(items, item_text, item_id)
    parts = max(1, math.ceil(entries.count() / BLOCK_ENTRIES))
    out = None
    for p in range(parts):
        block = entries.where(F.pmod(F.xxhash64("_item"), F.lit(parts)) == p) if parts > 1 else entries
        found = search_block(docs, block, k, text, doc_id)
        out = found if out is None else out.unionAll(found)
    return out


def search_block(docs: DataFrame, entries: DataFrame, k: int, text: str, doc_id: str) -> DataFrame:
    rows = entries.orderBy("_item", "term").collect()
    names = sorted({r.term for r in rows})
    if not names:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    number = {t: i for i, t in enumerate(names)}
    own: dict[int, list] = {}
    ids = {}
    for r in rows:
        own.setdefault(r._item, []).append((number[r.term], r.times))
        ids[r._item] = r.item_id
    of_items = [tuple(np.array(x, np.int64) for x in zip(*v)) for v in own.values()]
    labels, id_list = pa.array(list(own), pa.int64()), pa.array([ids[i] for i in own], pa.int64())
    columns = document_columns(docs, Vocabulary(names), text, doc_id)
    weight, n, l = weights(columns, len(names))  # noqa: E741

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product = Product(of_items, weight, n, l, k)
        held: list[pa.RecordBatch] = []

        def multiply() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            doc, length, term, count = (t.column(i).chunk(0) for i in range(4))
            offs = term.offsets.to_numpy().astype(np.int64)
            flat = (x.values.slice(offs[0], offs[-1] - offs[0]).to_numpy() for x in (term, count))
            product.add(doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False), length.to_numpy(), offs - offs[0], *flat)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_DOCS:
                multiply()
        if held:
            multiply()
        sizes = np.array([len(s) for s, _, _ in product.best])
        if sizes.sum():
            item = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            score, lost, doc = (np.concatenate(x) for x in zip(*product.best))
            group = np.full(len(score), TaskContext.get().partitionId() % MERGE_GROUPS, np.int32)
            yield pa.RecordBatch.from_arrays([labels.take(item), id_list.take(item), pa.array(doc, mask=lost), pa.array(score), pa.array(group)], ["_item", "item_id", "doc_id", "score", "_group"])

    best = columns.mapInArrow(run, "_item long, item_id long, doc_id long, score long, _group int")
    order = F.desc("score"), F.asc_nulls_last("doc_id")
    for by in (("_item", "_group"), ("_item",)):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")
