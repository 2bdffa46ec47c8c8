"""The corpus pipeline: each stage works on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a frame, which run() writes as Parquet into the
shared folder and reads again, so a lost executor costs a re-read of files.

Edge cases, of every stage: null and empty texts, null ids, repeated rows and ids, ties, extra columns of any
name and an empty table pass without an error; each stage's docstring says what it makes of them.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gaugeworks.llm import language_id, line_dedup, mixing, packing, simhash
from gaugeworks.llm.common import shared_dir, table

#: Target weights of the mix; sources that aren't named weigh 1.
WEIGHTS: dict[str, float] = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in none of the languages that `lang` teaches go, and null, empty and letterless ones; all stay where no row has a `lang`.

    Rows are judged each on its own, so repeated ones share their fate; ties go to the first language in order.
    """
    return language_id.accepted(docs, language_id.fit(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks that an earlier document has go; documents of which nothing is left go with them.

    Rows without a removed line stay as they are, null and empty texts too; n_chars counts what is left.  Rows of
    one id and text are one document; a null id comes after all others.
    """
    left = line_dedup.dedup_lines(docs)
    return left.where("dedup_removed = 0 or text rlike '[^\\\\s]'").selectExpr(*["if(dedup_removed = 0, n_chars, char_length(text)) as n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the smallest id, null ids last.

    Different texts under one id, or without one, are told apart; null and wordless texts are one group; of equal rows one stays.
    """
    return simhash.keep_one(docs, width=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mix; a null source is a source of its own."""
    return mixing.in_order(mixing.interleave(docs, WEIGHTS)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows, packed into sequences that follow the mix: ascending ids hold stretch after stretch of its rows.

    The mix is the order of the rows in their files, or in the frame if it wasn't read from files.  A null or empty text is a piece of the end id.
    """
    return packing.pack_in_order(docs, TOKENIZER)


STAGES = [("language_id", identify_language), ("line_dedup", dedup_lines), ("simhash", dedup_near), ("mixing", mix), ("packing", pack)]
#: Tokens and alignments can't be expressed in SQL; tests hold each stage, and all together, against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
