"""Breakers over runs that arrive as a stream: the same rows run as over the whole table, however they are split into micro-batches.

Each entity's state is a few numbers in the state store; a timer can close a tripped breaker again.  Runs of an entity
arrive in order from micro-batch to micro-batch; within one they are put in order, so an entity's rows of one
micro-batch are held at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Breaker(StatefulProcessor):
    """Lets an entity's rows through until `step` says stop.

    A state is (a, b, stopped); step(a, b, row) gives the next a and b and whether the rows after this one are stopped.
    """

    def __init__(self, order: Sequence[str], reset_ms: int | None):
        self.order, self.reset_ms = list(order), reset_ms

    def step(self, a: int, b: int, row: dict) -> tuple[int, int, bool]:
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("breaker", "a long, b long, stopped boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        a, b, stopped = self.state.get() if self.state.exists() else (0, 0, False)
        if stopped:
            return
        pdf = pd.concat(list(rows))
        pdf.columns = self.columns  # Spark numbers columns whose names start with an underscore
        pdf = pdf.sort_values(self.order, kind="stable")
        ran = 0
        for row in pdf[["_done", "_total", "_fails"]].to_dict("records"):
            ran += 1
            a, b, stopped = self.step(int(a), int(b), row)
            if stopped:
                break
        self.state.update((int(a), int(b), bool(stopped)))
        if stopped and self.reset_ms is not None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.reset_ms)
        yield pdf.iloc[:ran, :-3]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


class Strikes(Breaker):
    """Stops after `most` failures in a row; `a` counts them."""

    def __init__(self, order: Sequence[str], reset_ms: int | None, most: int):
        super().__init__(order, reset_ms)
        self.most = most

    def step(self, a, b, row):
        a = a + 1 if row["_fails"] else 0
        return a, b, a >= self.most


class Progress(Breaker):
    """Stops after a run that got no further, after `most` runs, or when all is done; `a` is what was done, `b` the runs."""

    def __init__(self, order: Sequence[str], reset_ms: int | None, most: int):
        super().__init__(order, reset_ms)
        self.most = most

    def step(self, a, b, row):
        done = int(row["_done"])
        return done, b + 1, done <= a or done >= row["_total"] or b + 1 >= self.most


def _through(stream: DataFrame, by: Sequence[str], breaker: Breaker, done: Column, total: Column, fails: Column) -> DataFrame:
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = stream.withColumns({"_done": done.cast("long"), "_total": total.cast("long"), "_fails": F.coalesce(fails, F.lit(False))})
    breaker.columns = rows.columns
    mode = "none" if breaker.reset_ms is None else "processingTime"
    return rows.groupBy(*by).transformWithStateInPandas(breaker, T.StructType(stream.schema.fields), "append", mode)


def two_strikes(stream: DataFrame, by: Sequence[str], order: Sequence[str], fails: Column, most: int = 2, reset_ms: int | None = None) -> DataFrame:
    """The rows that run: those of each entity up to the `most`-th failure in a row (`sequence.two_strikes` over a stream).

    With reset_ms, a tripped breaker closes after that time, and the entity's later rows run again.
    """
    return _through(stream, by, Strikes(order, reset_ms, most), F.lit(0), F.lit(0), fails)


def while_progress(stream: DataFrame, by: Sequence[str], order: Sequence[str], done: str, total: str, most: int = 12) -> DataFrame:
    """The runs that are made: until all is done, one gets no further, or there were `most` (`sequence.while_progress` over a stream).

    A null count of done rows is none.
    """
    return _through(stream, by, Progress(order, None, most), F.coalesce(done, F.lit(0)), F.coalesce(total, F.lit(0)), F.lit(False))
