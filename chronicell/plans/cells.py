"""Queries that turn changes into versioned cells."""

from pyspark.sql import functions as F

from chronicell.functions.naming import salted_key
from chronicell.operators import txn
from chronicell.operators.cells import target_table, to_cells
from chronicell.plans.log import LINE_ORDER
from chronicell.session import table
from chronicell.sources.changes import EVENT_COLUMNS, event_changes, order_lines

CELL = ["tbl", "row_key", "qualifier", "ts_us", "value"]


def event_cells(spark, sf):
    """Cells with their place in the log."""
    return to_cells(event_changes(spark, sf))


def cells_all(spark, sf):
    return event_cells(spark, sf).select(*CELL)


def salted_keys(spark, sf):
    return table(spark, sf, "lineitem").select(salted_key([F.col("l_orderkey"), F.col("l_linenumber")]).alias("row_key")).distinct()


def _of(op):
    return lambda spark, sf: to_cells(event_changes(spark, sf).filter(F.col("op") == op)).select(*CELL)


def payload_cells(spark, sf):
    c = event_changes(spark, sf).withColumn("tbl", F.when(F.col("position") % 10 == 0, "context").otherwise(F.col("tbl")))
    return to_cells(c.filter("op = 'INSERT'"), payload_table="context").select(target_table(F.col("tbl"), "NS").alias("tbl"), "row_key", "qualifier", "ts_us", "value")


def line_cells(spark, sf):
    """Cells of the order lines' transactions; of changes that share a microsecond the last one stays."""
    r = txn.row_micros(order_lines(spark, sf), ["l_orderkey"], ["l_linenumber"], LINE_ORDER)
    c = r.select(
        F.lit("lineitem").alias("tbl"), F.lit("INSERT").alias("op"), F.array(F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("pk"),
        F.lit(None).cast("map<string,string>").alias("before"), F.create_map(F.lit("quantity"), "quantity", F.lit("returnflag"), "l_returnflag").alias("after"),
        "ts_us", F.concat(F.lit("txn:"), F.col("l_orderkey").cast("string")).alias("txn_id"), F.lit(0).cast("long").alias("xid"), F.col("l_partkey").alias("position"), F.col("l_suppkey").cast("int").alias("row_idx"),
    )
    kept = txn.last_at_same_micros(to_cells(c), ["tbl", "row_key", "qualifier", "ts_us"], ["position", "row_idx"])
    return kept.select(*CELL)


_N = "CASE WHEN n = 0 THEN 0 ELSE (n - 1) % 9999 + 1 END"
EVENTS = f"""
SELECT *, CASE WHEN op <> 'INSERT' THEN lag(image) OVER (PARTITION BY user_id ORDER BY position) END AS before, commit_ts_ms * 1000 + seq * 100 - 50 AS ts_us FROM (
 SELECT *, ({_N})::BIGINT AS seq FROM (
  SELECT 'binlog.' || lpad((event_id // 1000)::VARCHAR, 6, '0') AS file, event_id AS position, user_id, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op,
    epoch_ms(date_trunc('second', ts)) AS commit_ts_ms, 'events_' || strftime(ts, '%Y%m') AS orig_tbl, 'txn:' || event_id AS txn_id,
    {{'event_type': event_type, 'value': CAST(value AS DECIMAL(18,2))::VARCHAR, 'props': props}} AS image,
    row_number() OVER (PARTITION BY date_trunc('second', ts) ORDER BY event_id) - 1 AS n FROM events))"""
_ENTRIES = " UNION ALL ".join(f"SELECT position, user_id, ts_us, op, txn_id, '{c}' AS qualifier, coalesce(image.{c}, 'NULL') AS value FROM ev WHERE op = 'INSERT' OR (op = 'UPDATE' AND coalesce(before.{c}, 'NULL') <> coalesce(image.{c}, 'NULL'))" for c in EVENT_COLUMNS)
_KEY = "substr(md5(user_id::VARCHAR), 1, 8) || ';' || user_id"
CELLS = f"""
WITH ev AS ({EVENTS}), entries AS ({_ENTRIES}
 UNION ALL SELECT position, user_id, ts_us, op, txn_id, 'row_status', substr(op, 1, 1) FROM ev
 UNION ALL SELECT position, user_id, ts_us, op, txn_id, '_transaction_uuid', txn_id FROM ev
 UNION ALL SELECT position, user_id, ts_us, op, txn_id, '_transaction_xid', '0' FROM ev)
SELECT 'events' AS tbl, {_KEY} AS row_key, qualifier, ts_us, value, op, position, txn_id FROM entries"""
_COLS = "tbl, row_key, qualifier, ts_us, value"
_LINE_KEY = "substr(md5(l_orderkey::VARCHAR), 1, 8) || ';' || l_orderkey || ';' || l_linenumber"


def _line_sql():
    from chronicell.plans.log import LINES

    kept = f"SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, ts_us ORDER BY l_partkey DESC, l_suppkey DESC) AS r FROM (SELECT *, least(base_us - 51 + row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice), base_us) AS ts_us FROM ({LINES}))"
    pairs = (("quantity", "CAST(l_quantity AS DECIMAL(18,2))::VARCHAR"), ("returnflag", "l_returnflag"), ("row_status", "'I'"), ("_transaction_uuid", "'txn:' || l_orderkey"), ("_transaction_xid", "'0'"))
    return f"WITH k AS ({kept}) " + " UNION ALL ".join(f"SELECT 'lineitem' AS tbl, {_LINE_KEY} AS row_key, '{q}' AS qualifier, ts_us, {v} AS value FROM k WHERE r = 1" for q, v in pairs)


PLANS = {
    "salted_keys": (salted_keys, f"SELECT DISTINCT {_LINE_KEY} AS row_key FROM lineitem"),
    "cells_all": (cells_all, f"SELECT {_COLS} FROM ({CELLS})"),
    "cells_insert": (_of("INSERT"), f"SELECT {_COLS} FROM ({CELLS}) WHERE op = 'INSERT'"),
    "cells_update_changed_only": (_of("UPDATE"), f"SELECT {_COLS} FROM ({CELLS}) WHERE op = 'UPDATE'"),
    "cells_delete": (_of("DELETE"), f"SELECT {_COLS} FROM ({CELLS}) WHERE op = 'DELETE'"),
    "payload_cells": (payload_cells, f"SELECT CASE WHEN position % 10 = 0 THEN 'ns:context' ELSE 'ns:events' END AS tbl, CASE WHEN position % 10 = 0 THEN txn_id ELSE row_key END AS row_key, qualifier, ts_us, value FROM ({CELLS}) WHERE op = 'INSERT'"),
    "line_cells": (line_cells, _line_sql()),
}
