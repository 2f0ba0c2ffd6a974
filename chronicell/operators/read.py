"""Queries over versioned cells.

Changes 51 and on of a key in one transaction share a microsecond, and the last written wins. Cells that still carry
their place in the log (position, row_idx, as ``to_cells`` gives them) are ordered by it inside a microsecond; cells
without it have to have one version for each microsecond, as ``last_at_same_micros`` and every sink leave them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronicell.operators.cells import PLACE, STATUS, TXN_ID

#: Versions of a cell that a store keeps.
KEPT_VERSIONS = 1000


def written_order(cells: DataFrame) -> list[str]:
    """The columns that order the versions of a cell, oldest first."""
    return ["ts_us", *[c for c in PLACE if c in cells.columns]]


def history(cells: DataFrame, tbl: str, key: str) -> DataFrame:
    """All versions of one row; the filter reaches the scan."""
    return cells.filter((F.col("tbl") == tbl) & (F.col("row_key") == key))


def changes_between(cells: DataFrame, start_us: int | Column, stop_us: int | Column) -> DataFrame:
    """Versions written at or after start and before stop."""
    return cells.filter((F.col("ts_us") >= start_us) & (F.col("ts_us") < stop_us))


def latest_cells(cells: DataFrame) -> DataFrame:
    """(tbl, row_key, qualifier, ts_us, value): the newest version of every cell; one partial aggregate, one shuffle."""
    newest = F.max_by(F.struct("ts_us", "value"), F.struct(*written_order(cells))).alias("_v")
    return cells.groupBy("tbl", "row_key", "qualifier").agg(newest).select("tbl", "row_key", "qualifier", "_v.ts_us", "_v.value")


def latest_state(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row for each live key: the newest value of each column, and the time of the newest change.

    A row whose newest status is D is gone. Values are those written since the row was last inserted: what an earlier
    life of the key wrote does not show through. One aggregation by key; columns are conditional aggregates, not a pivot.
    """
    order = written_order(cells)
    newest = lambda q: F.max(F.when(F.col("qualifier") == q, F.struct(*order, "value")))
    place = lambda c: F.struct(*[F.col(f"{c}.{o}").alias(o) for o in order])
    born = F.max(F.when((F.col("qualifier") == STATUS) & (F.col("value") != "U"), F.struct(*order))).alias("_born")
    found = cells.groupBy("tbl", "row_key").agg(newest(STATUS).alias("_status"), born, *[newest(c).alias(f"_{c}") for c in columns])
    alive = found.filter(F.col("_status.value") != "D")
    shown = [F.when(F.col("_born").isNull() | (place(f"_{c}") >= F.col("_born")), F.col(f"_{c}.value")).alias(c) for c in columns]
    return alive.select("tbl", "row_key", *shown, F.col("_status.ts_us").alias("changed_us"))


def state_as_of(cells: DataFrame, columns: Sequence[str], at_us: int | Column) -> DataFrame:
    """The live rows as they were at a moment (changes of that microsecond included)."""
    return latest_state(cells.filter(F.col("ts_us") <= at_us), columns)


def newest_versions(cells: DataFrame, n: int = KEPT_VERSIONS) -> DataFrame:
    """At most n versions of each cell, newest first."""
    rank = F.row_number().over(Window.partitionBy("tbl", "row_key", "qualifier").orderBy(*[F.desc(c) for c in written_order(cells)]))
    return cells.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def daily_changes(cells: DataFrame) -> DataFrame:
    """Changes and last status of each row and day."""
    day = F.to_date(F.timestamp_micros("ts_us")).alias("day")
    status = cells.filter(F.col("qualifier") == STATUS)
    last = F.max_by("value", F.struct(*written_order(cells))).alias("last_status")
    return status.groupBy(day, "tbl", "row_key").agg(F.count("*").alias("n_changes"), last)


def with_context(cells: DataFrame, payload: DataFrame) -> DataFrame:
    """Row statuses with the payload row of their transaction (payload cells are keyed by transaction)."""
    txns = cells.filter(F.col("qualifier") == TXN_ID).select("tbl", "row_key", "ts_us", F.col("value").alias("txn_id"))
    return txns.join(payload.withColumnRenamed("row_key", "txn_id"), "txn_id")
