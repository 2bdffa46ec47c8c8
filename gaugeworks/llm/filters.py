"""Bloom filters of fixed size over 64-bit hashes: what they turn away needs no shuffle; a false yes costs work only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.textbatch import P1, P2, P3, P4, P5

#: Bits of a filter (16 MB, whatever the corpus) and parts in which it is built.
FILTER_BITS, FILTER_PARTS = 1 << 27, 64


def held(bits: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of the hashes a filter may hold.  By low bits, as the high bits of least hashes are nearly alike."""
    at = (x & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def mixed(*columns: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of 64-bit columns."""
    h = np.full(len(columns[0]), 42, np.uint64)
    rotl = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    with np.errstate(over="ignore"):
        for c in columns:
            h = (h + P5 + np.uint64(8)) ^ (rotl(c.view(np.uint64) * P2, 31) * P1)
            h = rotl(h, 27) * P1 + P4
            h ^= h >> np.uint64(33)
            h *= P2
            h ^= h >> np.uint64(29)
            h *= P3
            h ^= h >> np.uint64(32)
    return h


def filter_of(hashes: DataFrame) -> np.ndarray:
    """Bits of a filter of fixed size over a frame's one column of 64-bit hashes, built in parts."""
    width = FILTER_BITS // FILTER_PARTS

    def bits(batches):
        part, made = None, np.zeros(width // 8, np.uint8)
        for batch in batches:
            place = batch.column(1).to_numpy()
            for p in np.unique(batch.column(0).to_numpy()).tolist():
                assert part in (None, p)
                part = p
            np.bitwise_or.at(made, place >> 3, np.left_shift(np.uint8(1), (place & 7).astype(np.uint8)))
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([made.tobytes()], pa.binary())], ["part", "bits"])

    place = F.col(hashes.columns[0]).bitwiseAND(F.lit(FILTER_BITS - 1))
    split = hashes.select(F.floor(place / width).cast("int").alias("part"), (place % width).cast("int").alias("place"))
    whole = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in split.repartitionById(FILTER_PARTS, F.col("part")).mapInArrow(bits, "part int, bits binary").collect():
        whole[r.part * (width // 8) : (r.part + 1) * (width // 8)] = np.frombuffer(r.bits, np.uint8)
    return whole
