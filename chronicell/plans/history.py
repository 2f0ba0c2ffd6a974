"""Read-side queries over the cells of ``events``."""

from pyspark.sql import functions as F

from chronicell.operators import read
from chronicell.operators.cells import to_cells
from chronicell.plans.cells import CELL, CELLS, event_cells
from chronicell.sources.changes import EVENT_COLUMNS, event_changes, one_load


def _middle(cells):
    """The middle of the stream's time, from one aggregate row."""
    row = cells.agg(F.min("ts_us").alias("lo"), F.max("ts_us").alias("hi")).first()
    return None if row.lo is None else (row.lo + row.hi) // 2


def full_version_scan(spark, sf):
    return event_cells(spark, sf).groupBy("tbl", "row_key", "qualifier").agg(F.count("*").alias("versions"), F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"))


def key_history(spark, sf):
    return read.history(event_cells(spark, sf), "events", "c4ca4238;1").select(*CELL)


def latest_cells(spark, sf):
    return read.latest_cells(event_cells(spark, sf))


def latest_state(spark, sf):
    return read.latest_state(event_cells(spark, sf), EVENT_COLUMNS)


def as_of_state(spark, sf):
    cells = event_cells(spark, sf)
    return read.state_as_of(cells, EVENT_COLUMNS, F.lit(_middle(event_changes(spark, sf))))


def changes_between(spark, sf):
    changes = event_changes(spark, sf)
    middle = _middle(changes)
    day = 24 * 3600 * 1_000_000
    return read.changes_between(event_cells(spark, sf), F.lit(middle), F.lit(None if middle is None else middle + day)).select(*CELL)


def daily_changes(spark, sf):
    return read.daily_changes(event_cells(spark, sf))


def txn_context_join(spark, sf):
    c = event_changes(spark, sf)
    payload = c.select(F.col("txn_id").alias("row_key"), F.concat(F.lit("role-"), (F.col("position") % 7).cast("string")).alias("server_role"))
    return read.with_context(to_cells(c), payload).select("tbl", "row_key", "ts_us", "txn_id", "server_role")


def retain_newest_n(spark, sf):
    return read.newest_versions(event_cells(spark, sf), 5).select(*CELL)


def load_latest_state(spark, sf):
    """Latest state after one transaction with far more than 50 changes of every key."""
    return read.latest_state(to_cells(one_load(spark, sf)), EVENT_COLUMNS)


def load_newest_cells(spark, sf):
    """The newest two versions of every cell after that transaction, and what the last of a microsecond was."""
    return read.newest_versions(to_cells(one_load(spark, sf)), 2).select(*CELL, "position")


_COLS = "tbl, row_key, qualifier, ts_us, value"


def _state(where: str = "", cells: str = CELLS, order: str = "{'t': ts_us, 'p': position}") -> str:
    """Latest state: what was written last, by time and then by place in the log."""
    newest = lambda q: f"max({{'o': {order}, 'v': value}}) FILTER (qualifier = '{q}')"
    cols = ", ".join(f'{newest(c)} AS "{c}_"' for c in EVENT_COLUMNS)
    shown = ", ".join(f'CASE WHEN born IS NULL OR "{c}_".o >= born THEN "{c}_".v END AS {c}' for c in EVENT_COLUMNS)
    return f"WITH c AS ({cells}), s AS (SELECT tbl, row_key, {newest('row_status')} AS st, max({order}) FILTER (qualifier = 'row_status' AND value <> 'U') AS born, {cols} FROM c {where} GROUP BY tbl, row_key) SELECT tbl, row_key, {shown}, st.o.t AS changed_us FROM s WHERE st.v <> 'D'"


_BASE = 1_800_000_000_000_000
_LOAD = f"SELECT * REPLACE (least({_BASE} - 51 + dense_rank() OVER (PARTITION BY row_key ORDER BY position), {_BASE}) AS ts_us, CASE WHEN qualifier = '_transaction_uuid' THEN 'load' ELSE value END AS value) FROM ({CELLS})"
_MID = "(SELECT (min(ts_us) + max(ts_us)) // 2 FROM c)"
PLANS = {
    "full_version_scan": (full_version_scan, f"SELECT tbl, row_key, qualifier, count(*) AS versions, min(ts_us) AS first_us, max(ts_us) AS last_us FROM ({CELLS}) GROUP BY ALL"),
    "key_history": (key_history, f"SELECT {_COLS} FROM ({CELLS}) WHERE row_key = 'c4ca4238;1'"),
    "latest_cells": (latest_cells, f"SELECT tbl, row_key, qualifier, max(ts_us) AS ts_us, arg_max(value, {{'t': ts_us, 'p': position}}) AS value FROM ({CELLS}) GROUP BY tbl, row_key, qualifier"),
    "latest_state": (latest_state, _state()),
    "as_of_state": (as_of_state, _state(f"WHERE ts_us <= {_MID}")),
    "changes_between": (changes_between, f"WITH c AS ({CELLS}) SELECT {_COLS} FROM c WHERE ts_us >= {_MID} AND ts_us < {_MID} + 86400000000"),
    "daily_changes": (daily_changes, f"SELECT make_timestamp(ts_us)::DATE AS day, tbl, row_key, count(*) AS n_changes, arg_max(value, {{'t': ts_us, 'p': position}}) AS last_status FROM ({CELLS}) WHERE qualifier = 'row_status' GROUP BY ALL"),
    "txn_context_join": (txn_context_join, f"SELECT tbl, row_key, ts_us, value AS txn_id, 'role-' || (position % 7) AS server_role FROM ({CELLS}) WHERE qualifier = '_transaction_uuid'"),
    "retain_newest_n": (retain_newest_n, f"SELECT {_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY tbl, row_key, qualifier ORDER BY ts_us DESC, position DESC) AS r FROM ({CELLS})) WHERE r <= 5"),
    "load_latest_state": (load_latest_state, _state(cells=_LOAD, order="{'t': position, 'u': ts_us}").replace("st.o.t", "st.o.u")),
    "load_newest_cells": (load_newest_cells, f"SELECT {_COLS}, position FROM (SELECT *, row_number() OVER (PARTITION BY tbl, row_key, qualifier ORDER BY position DESC) AS r FROM ({_LOAD})) WHERE r <= 2"),
}
