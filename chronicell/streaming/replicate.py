"""Streaming replication: recorded events in, cells out, by micro-batches with the batch operators.

Transactions that a batch does not complete wait in the state of ``assemble_stream``; what comes out of it is whole
transactions, so every batch is written with the same transformations as a batch run, and a repeated batch overwrites
its own folders.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from chronicell.operators.txn import CLOSING, SEQ_CYCLE, last_at_same_micros
from chronicell.sources.payloads import write_cells

_ROW = "file string, position bigint, op string, tbl string, pk string, image string"
_OUT = f"server string, {_ROW}, txn_no bigint, commit_ts_ms bigint, seq bigint, row_idx bigint"
_COUNTERS = "file string, closed bigint, begun boolean, newest bigint, seq bigint, held bigint"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def follow_sequence(times, newest: int, seq: int):
    """Sequence numbers of commits in log order, and the newest time and number after them."""
    import numpy as np

    out = np.empty(len(times), np.int64)
    for k, t in enumerate(times):
        if seq >= SEQ_CYCLE:
            seq = 0
        if t > newest:
            newest, seq = t, 0
        elif t == newest:
            seq += 1
        out[k] = seq
    return out, newest, seq


class _Assembler(StatefulProcessor):
    """State of a server: a row of counters, and a list of the rows of its open transaction, which only ever grows or is
    cleared. Columns are computed whole; the only loop is over commits."""

    def init(self, handle) -> None:
        self._counters = handle.getValueState("counters", _COUNTERS)
        self._held = handle.getListState("held", _ROW)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        events = pd.concat(list(rows), ignore_index=True).sort_values(["file", "position"], kind="stable")
        state = self._counters.get() if self._counters.exists() else ("", 0, False, -1, 0, 0)
        for file, part in events.groupby("file", sort=False):
            if file != state[0]:  # an open tail of a file is never committed
                self._held.clear()
                state = (file, 0, False, *state[3:5], 0)
            found, state = self._file(key[0], part.reset_index(drop=True), state)
            yield found
        self._counters.update(state)

    def _file(self, server: str, events, state: tuple) -> tuple:
        import numpy as np
        import pandas as pd

        file, closed, begun, newest, seq, held = state
        closing = events["kind"].isin(CLOSING).to_numpy()
        no = np.cumsum(closing) - closing
        inside = (events["kind"] == "BEGIN").groupby(no).cummax().to_numpy() | ((no == 0) & begun)
        times = events["ts_ms"].to_numpy()[closing]
        seqs, newest, seq = follow_sequence(times, newest, seq)
        row = (events["kind"] == "ROW").to_numpy()
        done, wait = row & inside & (no < len(times)), row & inside & (no == len(times))

        rows = events.loc[done, _names(_ROW)].assign(_no=no[done])
        if len(times) and held:
            rows = pd.concat([pd.DataFrame(list(self._held.get()), columns=_names(_ROW)).assign(_no=0), rows], ignore_index=True)
            self._held.clear()
            held = 0
        at = rows["_no"].to_numpy(np.int64)
        txns = rows.drop(columns="_no").assign(txn_no=closed + at, commit_ts_ms=times[at], seq=seqs[at], row_idx=rows.groupby("_no").cumcount())
        alone = events.loc[row & ~inside, [*_names(_ROW), "ts_ms"]].rename(columns={"ts_ms": "commit_ts_ms"}).assign(txn_no=pd.NA, seq=pd.NA, row_idx=0)
        if wait.any():
            self._held.appendList(list(events.loc[wait, _names(_ROW)].astype(object).itertuples(index=False, name=None)))
        out = pd.concat([x for x in (txns, alone) if len(x)] or [txns]).assign(server=server)[_names(_OUT)]
        after = (file, int(closed + len(times)), bool(inside[-1] and not closing[-1]), int(newest), int(seq), int(held + wait.sum()))
        return out.astype({"txn_no": "Int64", "seq": "Int64"}), after


def assemble_stream(events: DataFrame) -> DataFrame:
    """Rows (server, file, position, kind, op, tbl, pk, image, ts_ms) to rows of committed transactions.

    Numbers are those of the batch operators (``assemble``, ``commit_sequence``), also where commit times go back and
    over file changes. A log is followed in order, so one task takes a server's part of a batch; servers are spread over
    tasks. Files have to arrive in order. The session's state store is set to one on disk, which holds transactions of
    any length.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    return events.groupBy("server").transformWithStateInPandas(_Assembler(), _OUT, "append", "none")


def write_stream(events: DataFrame, to_cells: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start a query that turns each micro-batch into cells under ``path``, by table and batch.

    A batch that is repeated overwrites what it wrote. ``compact`` makes large files of many batches.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        cells = last_at_same_micros(to_cells(batch), ["tbl", "row_key", "qualifier", "ts_us"], ["file", "position", "row_idx"])
        out = cells.withColumn("batch", F.lit(batch_id).cast("long")).repartition("tbl", "row_key").sortWithinPartitions("tbl", "row_key", "qualifier", "ts_us")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tbl", "batch").parquet(path)

    return events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("tbl", F.col("tbl").cast("string")).drop("batch")


def newest_only(cells: DataFrame) -> DataFrame:
    """Of cells with one key and microsecond (a replay, or late commits that share a number) only the last written."""
    return last_at_same_micros(cells, ["tbl", "row_key", "qualifier", "ts_us"], ["file", "position", "row_idx"]).select(cells.columns)


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Write the cells of all batches so far to another folder, by table, the rows of a key together."""
    write_cells(newest_only(read_cells(spark, path)), target, mode="overwrite")
