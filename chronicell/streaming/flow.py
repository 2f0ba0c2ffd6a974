"""A flow of events: filters, then processing steps, then sinks, then what follows a successful write.

The same flow runs over a batch or a stream. Partitions, queues and retries of failed items are Spark's own (tasks,
micro-batches and their offset log); order inside a partition is that of the source.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronicell.operators.resume import partition_of

Step = Callable[[DataFrame], DataFrame]
Sink = Callable[[DataFrame], bool | None]


@dataclass(frozen=True)
class Flow:
    """Each method gives a new flow.

    ``filter``: predicates, all of which have to hold. ``process``: steps applied one after another; a step drops what it
    makes null with ``keep``. ``sink``: writers, called in order with the events of a batch; one that returns False ends
    the batch there. ``post``: called with the events once every sink has taken them.
    """

    predicates: tuple[Column, ...] = ()
    steps: tuple[Step, ...] = ()
    sinks: tuple[Sink, ...] = ()
    after: tuple[Callable[[DataFrame], None], ...] = ()
    partitioner: tuple[str, int] | None = None

    def filter(self, predicate: Column) -> Flow:
        return replace(self, predicates=(*self.predicates, predicate))

    def process(self, step: Step, keep: str | None = None) -> Flow:
        kept = step if keep is None else lambda df: step(df).filter(F.col(keep).isNotNull())
        return replace(self, steps=(*self.steps, kept))

    def partition(self, name: str, n: int) -> Flow:
        """Events of one partition reach the sinks in one task."""
        return replace(self, partitioner=(name, n))

    def sink(self, write: Sink) -> Flow:
        return replace(self, sinks=(*self.sinks, write))

    def post(self, call: Callable[[DataFrame], None]) -> Flow:
        return replace(self, after=(*self.after, call))

    def transformed(self, events: DataFrame) -> DataFrame:
        """Events as the sinks get them, without writing."""
        kept = events.filter(reduce(lambda a, b: a & b, self.predicates)) if self.predicates else events
        out = reduce(lambda df, step: step(df), self.steps, kept)
        if self.partitioner is None:
            return out
        name, n = self.partitioner
        return out.withColumn("partition", partition_of(name, out, n)).repartition(n, "partition")

    def run(self, events: DataFrame) -> bool:
        """Write a batch; False where a sink did not take it."""
        out = self.transformed(events)
        if any(write(out) is False for write in self.sinks):
            return False
        for call in self.after:
            call(out)
        return True

    def start(self, events: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Write a stream, batch by batch; a batch that a sink does not take fails the query, which a restart repeats."""

        def batch(df: DataFrame, batch_id: int) -> None:
            if not self.run(df):
                raise RuntimeError(f"a sink did not take batch {batch_id}")

        return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
