"""Counters and gauges of a replication, from the data that flows through it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def row_counters(changes: DataFrame) -> DataFrame:
    """(tbl, op, rows): the counter of each table and operation."""
    return changes.groupBy("tbl", "op").agg(F.count("*").alias("rows"))


def observed(changes: DataFrame, name: str = "changes") -> tuple[DataFrame, Observation]:
    """The changes, and what is counted as they are written: rows by operation, the oldest and newest commit time."""
    seen = Observation(name)
    by_op = [F.count_if(F.col("op") == op).alias(op.lower()) for op in ("INSERT", "UPDATE", "DELETE")]
    return changes.observe(seen, F.count("*").alias("rows"), *by_op, F.min("commit_ts_ms").alias("oldest_ms"), F.max("commit_ts_ms").alias("newest_ms")), seen


def delay_ms(newest_ms: int | None, now_ms: int) -> int:
    """How far the newest written commit is behind; 0 before any."""
    return 0 if newest_ms is None else now_ms - newest_ms


class Progress(StreamingQueryListener):
    """Keeps the last progress of each query: rows, rows a second, batch."""

    def __init__(self) -> None:
        self.last: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:
        self.last.setdefault(str(event.id), {})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.last[str(p.id)] = {"batch": p.batchId, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.last.setdefault(str(event.id), {})["ended"] = True
