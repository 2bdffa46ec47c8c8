"""Language ID by language-bitmask n-gram filters.

One Bloom filter serves all languages: a slot holds a mask with a bit for each language, so the AND
of an n-gram's slots returns every language that contains it (a bit-sliced filter).  A text's
popcount for a language is corrected for the filter's false positives,
(hits - n * rate) / (1 - rate), and the largest decides.

The languages are those of all labelled rows.  Model fitting reads at most `SAMPLE` labelled rows of each language,
those of the smallest hash of id and text.  An n-gram enters a language's filter if `SHARE` of that language's sample
rows hold it, so the number of entries is bounded by the texts' mean number of n-grams over SHARE, whatever the
corpus.  A mask has 64 languages; more have further masks.

Edge cases: null texts and texts without a letter give `und` and score 0; texts too short for an
n-gram, or without a known one, get the commonest learned language and score 0; ties go to the
first language in order; without labelled rows all is `und`; null languages teach nothing; extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import bounded_sample, durable, field, whole_rows
from gaugeworks.llm.textbatch import LOWER, text_slices

#: Bytes of an n-gram, labelled rows of a language read at most, least share of a language's rows, bits of the slot number.
GRAM = 4
SAMPLE = 5_000
SHARE = 0.002
SLOT_BITS = 20
#: Languages of a mask.
MASK = 64
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))
_LETTERS = LOWER.copy()
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 32


@dataclass
class Filter:
    languages: list[str]
    slots: list[np.ndarray]
    rates: np.ndarray
    default: str


def grams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of each text, lower-cased, other ASCII than letters as blanks; and how many each has."""
    folded = _LETTERS[buf]
    if len(buf):
        accent = (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97) & (buf[:-1] == 0xC3)
        folded[1:] += accent.astype(np.uint8) * np.uint8(32)
    n = np.maximum(np.diff(offs) - GRAM + 1, 0)
    if len(buf) < GRAM:
        return np.zeros(0, np.uint32), np.zeros(len(n), np.int64)
    wide = folded.astype(np.uint32)
    all_grams = wide[: len(buf) - GRAM + 1].copy()
    for k in range(1, GRAM):
        all_grams |= wide[k : len(buf) - GRAM + 1 + k] << np.uint32(8 * k)
    inside = np.ones(len(all_grams), bool)
    for k in range(1, GRAM):
        at = offs[1:-1] - k
        inside[at[(at >= 0) & (at < len(inside))]] = False
    tail = offs[-1] - GRAM + 1
    inside[max(0, tail) :] = False
    short = np.flatnonzero(np.diff(offs) < GRAM)
    for d in short:
        inside[offs[d] : offs[d + 1]] = False
    return all_grams[inside], n


def places(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = g.astype(np.uint64)
    return tuple(((wide * m) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for m in _MIX)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, share: float = SHARE) -> Filter:
    """Learns the filter from text and language of a bounded sample of each language's rows."""
    rows = labelled.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("doc_id is not null and lang is not null")
    rows = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    chosen = bounded_sample(rows.select("h", "lang"), sample, "h", "lang").distinct()
    taken = durable(rows.join(F.broadcast(chosen), ["h", "lang"]).dropDuplicates(["h", "lang"]).select("text", "lang"))

    def count(batches):
        for batch in batches:
            lang = batch.column(1).dictionary_encode()
            codes = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            keys = []
            for a, b, buf, offs in text_slices(batch.column(0)):
                g, n = grams(buf, offs)
                held = np.unique(np.repeat(np.arange(a, b, dtype=np.uint64), n) << np.uint64(32) | g)
                keys.append(codes[(held >> np.uint64(32)).astype(np.int64)].astype(np.uint64) << np.uint64(32) | (held & np.uint64(0xFFFFFFFF)))
            keys, n = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            names = lang.dictionary.take(pa.array((keys >> np.uint64(32)).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([names, pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    sizes = {r.lang: r.n for r in taken.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    all_rows = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    slots = [np.zeros(1 << SLOT_BITS, np.min_scalar_type((1 << min(MASK, len(languages) - a)) - 1)) for a in range(0, len(languages), MASK)]
    if languages:
        least = F.create_map(*[x for n in languages for x in (F.lit(n), F.lit(max(2.0 if sizes[n] > 20 else 1.0, share * sizes[n])))])
        kept = taken.select("text", "lang").mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= F.element_at(least, F.col("lang"))).select("lang", "gram").toPandas()
        for lang, own in kept.groupby("lang")["gram"]:
            k, bit = divmod(languages.index(lang), MASK)
            for at in places(own.to_numpy(np.int64)):
                slots[k][at] |= slots[k].dtype.type(1 << bit)
    fill = np.array([np.mean(_bit(slots[b // MASK], b % MASK)) for b in range(len(languages))])
    return Filter(languages, slots, fill ** len(_MIX), max(languages, key=lambda x: (all_rows[x], x), default="und"))


def _bit(masks: np.ndarray, bit: int) -> np.ndarray:
    return (masks >> masks.dtype.type(bit)) & masks.dtype.type(1)


def decide(model: Filter, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language numbers (-1: none known) and scores: the corrected share of the n-grams that it holds."""
    g, n = grams(buf, offs)
    first, second = places(g)
    ends = np.cumsum(n)
    corrected = np.zeros((len(n), len(model.languages)))
    for k, slots in enumerate(model.slots):
        masks = slots[first] & slots[second]
        for b in range(k * MASK, min((k + 1) * MASK, len(model.languages))):
            ones = np.zeros(len(masks) + 1, np.int64)
            np.cumsum(_bit(masks, b % MASK), out=ones[1:])
            hits = ones[ends] - ones[ends - n]
            corrected[:, b] = np.maximum(0, hits - n * model.rates[b]) / max(1e-9, 1 - model.rates[b])
    if not model.languages:
        return np.full(len(n), -1), np.zeros(len(n))
    best = corrected.argmax(axis=1)
    top = corrected[np.arange(len(n)), best]
    return np.where(top > 0, best, -1), np.clip(top / np.maximum(n, 1), 0, 1)


def with_language(docs: DataFrame, model: Filter, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "lang_score")) -> DataFrame:
    """The input's columns and the predicted language and score of every whole text, without a join.

    The model sent along has a fixed size.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.columns
    at = own.index(text_col)

    def run(batches):
        m = sent.value
        langs = np.array([*m.languages, m.default], object)
        for batch in batches:
            found = [decide(m, buf, offs) for _, _, buf, offs in text_slices(batch.column(at))]
            lettered = batch.column(len(own)).to_numpy(zero_copy_only=False).astype(bool)
            which = np.concatenate([x for x, _ in found]) if found else np.zeros(0, int)
            score = np.concatenate([x for _, x in found]) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], pa.array(np.where(lettered, langs[which], "und"), pa.string()), pa.array(np.where(lettered, score, 0.0))], [*own, *names])

    letters = F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.select("*", letters.alias(f"{names[0]}_lettered")).mapInArrow(run, schema)


def identify(docs: DataFrame, model: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_language(narrow, model, names=("lang_pred", "score")).drop("text")


def accepted(docs: DataFrame, model: Filter, least: float = 0.05, text_col: str = "text") -> DataFrame:
    """The rows whose text is in a learned language: not `und`, and LEAST of its n-grams are the language's.  All, if none was learned."""
    if not model.languages:
        return docs
    rows = whole_rows(docs).withColumn("_text", field(text_col))
    found = with_language(rows, model, "_text", ("_lang_pred", "_lang_score"))
    return found.where((F.col("_lang_pred") != "und") & (F.col("_lang_score") >= least)).select("_all.*")
