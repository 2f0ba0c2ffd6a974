"""Transactions and time: assembly, sequence numbers, the microsecond at which every change counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronicell.operators.running import present, running_max

CLOSING = ("COMMIT", "XID")
#: Sequence numbers of one commit time start again at 1 after this one (the 0 only opens the time).
SEQ_CYCLE = 9999
#: Changes of one key in one transaction keep apart for so many microseconds.
SPAN_US = 50


def assemble(events: DataFrame, log: Sequence[str] = ("server", "file"), order: str = "position", kind: str = "kind", transactions: bool = True) -> DataFrame:
    """Add txn_no, the number of the transaction inside its log, to rows between BEGIN and COMMIT or XID.

    Events outside a transaction get null. A second BEGIN without a commit goes on with the same transaction. An open
    tail is not visible: its rows are left out. Transactions never span two files, so windows are by file. With
    ``transactions`` off every event stands alone, at once and without a number.
    """
    if not transactions:
        return events.withColumn("txn_no", F.lit(None).cast("long"))
    closing = F.col(kind).isin(*CLOSING).cast("int")
    by_log = Window.partitionBy(*log).orderBy(order)
    closed = F.coalesce(F.sum(closing).over(by_log.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = events.withColumn("_no", closed)
    by_txn = Window.partitionBy(*log, "_no").orderBy(order)
    begun = F.max((F.col(kind) == "BEGIN").cast("int")).over(by_txn.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = F.max(closing).over(Window.partitionBy(*log, "_no"))
    out = out.withColumns({"_begun": begun, "_ends": ends})
    out = out.filter((F.col("_begun") == 0) | (F.col("_ends") == 1))
    return out.withColumn("txn_no", F.when(F.col("_begun") == 1, F.col("_no"))).drop("_no", "_begun", "_ends")


def commit_sequence(
    commits: DataFrame, second: str = "commit_ts_ms", order: str = "position", name: str = "seq", log: Sequence[str] | None = None, file: Sequence[str] | None = None, ascending: bool = False
) -> DataFrame:
    """Number of each commit inside its commit time: 0 for the first, then 1, 2, ... up to SEQ_CYCLE and 1 again.

    Follows each log: a later time than any before starts at 0, the newest time so far counts on, and a commit with an
    earlier time leaves the counter as it is (but for a counter that has passed its limit, which goes to 0). The newest
    time so far is a running maximum from file to file; numbers are then counted by log and that time. ``ascending``
    states that times never go back in a log, which saves the running maximum. ``log`` and ``file`` are the columns server
    and file, where there are such.
    """
    log = present(commits, "server") if log is None else log
    file = present(commits, "file") if file is None else file
    place = [*file, order]
    newest = commits.withColumn("_newest", F.col(second)) if ascending else running_max(commits, F.col(second), log, file, [order], "_newest")
    by_time = Window.partitionBy(*log, "_newest").orderBy(*place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = F.count(F.when(F.col(second) == F.col("_newest"), 1)).over(by_time) - 1
    counter = F.when(n == 0, 0).otherwise((n - 1) % SEQ_CYCLE + 1)
    late = (F.col(second) < F.col("_newest")) & (counter == SEQ_CYCLE)
    return newest.withColumn(name, F.when(late, 0).otherwise(counter).cast("long")).drop("_newest")


def stamp_commits(assembled: DataFrame, log: Sequence[str] = ("server",), file: Sequence[str] = ("file",), order: str = "position", kind: str = "kind", ts: str = "ts_ms") -> DataFrame:
    """Adds commit_ts_ms, commit_gtid, commit_xid and seq, those of their commit, to the events of transactions.

    The columns gtid (that in force) and xid are used where the log has them. Events outside of transactions get nulls,
    and every commit of the log counts for the sequence, whatever it holds. One row a transaction is joined to its events.
    """
    value = {c: F.col(c) if c in assembled.columns else F.lit(None).cast(t) for c, t in (("gtid", "string"), ("xid", "long"))}
    commits = assembled.filter(F.col(kind).isin(*CLOSING)).select(*log, *file, order, "txn_no", F.col(ts).alias("commit_ts_ms"), value["gtid"].alias("commit_gtid"), value["xid"].alias("commit_xid"))
    stamps = commit_sequence(commits, order=order, log=log, file=file).drop(order).filter("txn_no IS NOT NULL")
    return assembled.join(stamps, [*log, *file, "txn_no"], "left").select(*assembled.columns, "commit_ts_ms", "commit_gtid", "commit_xid", "seq")


def commit_micros(commit_ts_ms: Column, seq: Column) -> Column:
    """The commit's microsecond: 100 for each sequence number."""
    return commit_ts_ms * 1000 + seq * 100


def row_micros(changes: DataFrame, txn: Sequence[str], key: Sequence[str], order: Sequence[str], base: str = "base_us", name: str = "ts_us") -> DataFrame:
    """Changes of one key in one transaction get base - 50, base - 49, ... and at most base (the last one wins there)."""
    rank = F.row_number().over(Window.partitionBy(*txn, *key).orderBy(*order))
    return changes.withColumn(name, F.least(F.col(base) - SPAN_US + rank - 1, F.col(base)))


def chunk_no(rows: DataFrame, txn: Sequence[str], order: Sequence[str], limit: int, name: str = "chunk") -> DataFrame:
    """Number of the piece that a row of a long transaction belongs to, ``limit`` rows each."""
    rank = F.row_number().over(Window.partitionBy(*txn).orderBy(*order))
    return rows.withColumn(name, F.floor((rank - 1) / limit).cast("long"))


def last_at_same_micros(cells: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of cells with one key and microsecond only the last written: what a versioned store keeps."""
    latest = F.max_by(F.struct(*[c for c in cells.columns if c not in key]), F.struct(*order)).alias("_last")
    return cells.groupBy(*key).agg(latest).select(*key, "_last.*")
