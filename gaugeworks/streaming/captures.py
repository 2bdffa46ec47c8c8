"""New captures as a stream: each micro-batch is upserted into a versioned state table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.sources import state


def capture_stream(spark: SparkSession, folder: str, schema: str, per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).json(folder)


def upsert_into(stream: DataFrame, base: str, key: str, order: str, checkpoint: str, available_now: bool = True, range_rows: int = state.RANGE_ROWS) -> StreamingQuery:
    """Keeps `base` at the last row of each key.

    A micro-batch rewrites only the key ranges that it touches; one that was committed before a crash is known by its number and skipped.
    """

    def each(batch: DataFrame, number: int) -> None:
        state.merge(batch, base, key, order, writer=checkpoint, batch_id=number, range_rows=range_rows)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def first_hits(stream: DataFrame, keys: Sequence[str], ts: str, late: str = "1 hour") -> DataFrame:
    """Rows of keys not seen before within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))
