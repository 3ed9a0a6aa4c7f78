"""Stateful processors of the streaming operators.

Their state lives in the state store per key and changes row by row; no
processor holds the rows of a key.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks_db(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which custom
    processors need; the session's own setting comes back afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS_DB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def place(values) -> tuple:
    """Sorts like Spark's ascending order: nulls first."""
    return tuple((v is not None, v) for v in values)


class FirstSeen(StatefulProcessor):
    """Passes the first row of each key by the columns ``order``, once."""

    def __init__(self, order: list[str], columns: list[str]):
        self.order, self.columns = order, columns

    def init(self, handle) -> None:
        self.met = handle.getValueState("met", T.StructType([T.StructField("met", T.BooleanType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.met.exists():
            return
        first = min(rows, key=lambda r: place(r[c] for c in self.order))
        self.met.update((True,))
        yield Row(*self.columns)(*first)

    def close(self) -> None:
        pass


class RetryState(StatefulProcessor):
    """Counts a task's failed attempts and keeps its first errors."""

    def __init__(self, task: str, most: int, error: T.StructType, ordered: bool):
        self.task, self.most, self.error, self.ordered = task, most, error, ordered

    def init(self, handle) -> None:
        self.counts = handle.getValueState("counts", T.StructType([T.StructField("attempts", T.LongType()), T.StructField("succeeded", T.BooleanType())]))
        self.errors = handle.getListState("errors", self.error)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        attempts, succeeded = self.counts.get() if self.counts.exists() else (0, False)
        first = [(place(e), tuple(e)) for e in self.errors.get()] if self.errors.exists() else []
        first.sort()
        for r in rows:
            if r["ok"]:
                succeeded = True
            elif r["ok"] is not None:
                own = tuple(r[f"o{i}"] for i in range(len(self.error) - 1)) if self.ordered else (attempts,)
                error = (*own, r["error"])
                insort(first, (place(error), error))
                del first[self.most :]
                attempts += 1
        self.counts.update((attempts, succeeded))
        if first:
            self.errors.put([e for _, e in first])
        status = "succeeded" if succeeded else "failed" if attempts >= self.most else "retry"
        text = ";".join(e[-1] for _, e in first if e[-1] is not None)
        yield Row(self.task, "attempts", "attempts_left", "status", "errors")(key[0], attempts, max(self.most - attempts, 0), status, text)

    def close(self) -> None:
        pass
