"""Message payload, schema document and schema history queries."""

from pyspark.sql import functions as F

from chronicell.operators import ddl
from chronicell.operators.resume import partition_by_xid
from chronicell.plans.cells import EVENTS
from chronicell.session import table
from chronicell.sources import payloads
from chronicell.sources.changes import EVENT_COLUMNS, event_changes


def kafka_json_payload(spark, sf):
    changes = event_changes(spark, sf).withColumn("db", F.lit("web"))
    return payloads.json_message(changes, partition_by_xid(F.col("position"), 8), MESSAGE_COLUMNS, ["user_id"])


def kafka_json_events(spark, sf):
    """Messages of events with several rows: the changes of a user in a second are one event."""
    changes = event_changes(spark, sf).withColumns({"db": F.lit("web"), "event": F.concat_ws("-", "commit_ts_ms", F.get("pk", F.lit(0)), "op"), "row_idx": F.col("position").cast("int")})
    return payloads.json_message(changes, F.lit(0), event=["event"]).select("position", "value")


def avro_wire(spark, sf):
    """Avro records on the wire, as hex, of the last change of each user: a string and the meta fields."""
    changes = event_changes(spark, sf).filter("op <> 'DELETE'")
    found = payloads.avro_message(changes, F.lit(0), "web", "events", [("event_type", "varchar(20)", None)], payloads.SchemaRegistry())
    return found.select("position", F.hex("value").alias("value"), F.decode(F.get("headers", F.lit(0))["value"], "UTF-8").alias("meta"))


def avro_row_payload(spark, sf):
    return payloads.avro_rows(event_changes(spark, sf), EVENT_COLUMNS)


MESSAGE_COLUMNS = (("user_id", "bigint(20)"), ("event_type", "varchar(20)"), ("value", "decimal(18,2)"), ("props", "text"))
AVRO_COLUMNS = (("no", "int(11) unsigned", None), ("copies", "tinyint(3) unsigned", "4"), ("weight", "float(7,4)", None), ("total", "bigint(20) unsigned", None), ("city", "varchar(30)", "Rome"), ("state", "enum('Open','Paid')", None))


def avro_schema_json(spark, sf):
    text = payloads.avro_schema("shop", "parcel", AVRO_COLUMNS, meta=True)
    return table(spark, sf, "region").select("r_regionkey", F.lit(text).alias("avro_schema"))


def schema_keys(spark, sf):
    c = event_changes(spark, sf)
    op = F.when(F.col("position") % 5 == 0, "QUERY").otherwise(F.col("op"))
    return c.select("position", payloads.schema_key(op, F.lit("db"), F.col("tbl")).alias("subject"), payloads.header_text(F.lit("db"), F.col("tbl"), F.col("commit_ts_ms")).alias("header"), payloads.raw_event_key(F.col("commit_ts_ms")).alias("raw_key"))


# A log of DDL, one statement for each key of ``nation`` that has one.
DDL_LOG = (
    "CREATE TABLE invoice (no INT UNSIGNED NOT NULL, total DECIMAL(9,2), state ENUM('Open','Paid') DEFAULT 'Open', PRIMARY KEY (no))",
    "CREATE TABLE invoice_next LIKE invoice",
    "ALTER TABLE invoice_next ADD COLUMN (due DATE, paid DATE), MODIFY total DECIMAL(12,2) NOT NULL",
    "RENAME TABLE invoice TO invoice_past, invoice_next TO invoice",
    "ALTER TABLE invoice RENAME COLUMN due TO due_on, ADD COLUMN note VARCHAR(40) FIRST",
    "CREATE TABLE archive.invoice (no INT)",
    "ALTER TABLE unseen MODIFY size BIGINT(20), ADD flag TINYINT(1) AFTER nothing",
    "DROP TABLE IF EXISTS invoice_past, archive.invoice",
    "ALTER TABLE invoice CHANGE paid paid_on DATE AFTER no, DROP COLUMN note, RENAME TO bill",
    "TRUNCATE TABLE bill",
)


def _statements(spark, sf):
    n = table(spark, sf, "nation")
    return n.select(F.col("n_nationkey").cast("long").alias("position"), (F.col("n_nationkey") * 1000).cast("long").alias("ts_ms"), F.lit("shop").alias("db"), F.get(F.array(*map(F.lit, DDL_LOG)), F.col("n_nationkey")).alias("sql"))


def schema_history(spark, sf):
    return ddl.schema_history(_statements(spark, sf))


def ddl_record(spark, sf):
    history = ddl.schema_history(_statements(spark, sf)).filter("tbl = 'shop.invoice_next'")
    return payloads.ddl_records(history.withColumnRenamed("sql", "query"), "shop", "invoice_next").select("query", "schema", "isCompatibleSchemaChange")


def schema_before_after(spark, sf):
    return ddl.columns_before(ddl.schema_history(_statements(spark, sf)))


def schema_history_cells(spark, sf):
    """The cells of the schema history table whose value the SQL side can state: the statements themselves, and the
    CREATE statements after the first two changes."""
    cells = ddl.history_cells(ddl.schema_snapshots(_statements(spark, sf)), "Shop", "meta")
    return cells.filter("qualifier = 'ddl' OR (qualifier = 'createsPostChange' AND ts_us < 2000000) OR (qualifier = 'createsPreChange' AND ts_us = 0)")


_OLD, _NEXT = "no int unsigned, total decimal(9,2), state enum('Open','Paid')", "no int unsigned, total decimal(12,2), state enum('Open','Paid'), due date, paid date"
_NOTED, _BILL = "note varchar(40), no int unsigned, total decimal(12,2), state enum('Open','Paid'), due_on date, paid date", "no int unsigned, paid_on date, total decimal(12,2), state enum('Open','Paid'), due_on date"
_HISTORY = (
    (0, "shop.invoice", None, _OLD),
    (1, "shop.invoice_next", None, _OLD),
    (2, "shop.invoice_next", _OLD, _NEXT),
    (3, "shop.invoice", _OLD, None),
    (3, "shop.invoice_past", None, _OLD),
    (3, "shop.invoice_next", _NEXT, None),
    (3, "shop.invoice", None, _NEXT),
    (4, "shop.invoice", _NEXT, _NOTED),
    (5, "archive.invoice", None, "no int"),
    (6, "shop.unseen", None, "size bigint(20), flag tinyint(1)"),
    (7, "shop.invoice_past", _OLD, None),
    (7, "archive.invoice", "no int", None),
    (8, "shop.invoice", _NOTED, _BILL),
    (8, "shop.invoice", _BILL, None),
    (8, "shop.bill", None, _BILL),
)
_text = lambda x: "NULL" if x is None else "'" + x.replace("'", "''") + "'"
_ROWS = ", ".join(f"({p}::BIGINT, {_text(DDL_LOG[p])}, {_text(t)}, {_text(b)}, {_text(a)})" for p, t, b, a in _HISTORY)
_CREATE = "(\\n  `no` int unsigned NOT NULL,\\n  `total` decimal(9,2),\\n  `state` enum('Open','Paid') DEFAULT 'Open',\\n  PRIMARY KEY (`no`)\\n)"
_ONE = f'"shop.invoice":"CREATE TABLE `invoice` {_CREATE}"'
_CREATES = ((0, "createsPreChange", "{}"), (0, "createsPostChange", f"{{{_ONE}}}"), (1000, "createsPostChange", f'{{{_ONE},"shop.invoice_next":"CREATE TABLE `invoice_next` {_CREATE}"}}'))
_CELL_ROWS = ", ".join(f"({t}, '{q}', {_text(v)})" for t, q, v in (*((1000 * k, "ddl", x) for k, x in enumerate(DDL_LOG[:9])), *_CREATES))


def _avro(kind: str) -> str:
    """The schemas of the two versions of invoice_next, as text."""
    own = ['{"name":"no","type":["null","long"],"default":null}', '{"name":"total","type":["null","string"],"default":null}', '{"name":"state","type":["null","string"],"default":null}']
    dates = [f'{{"name":"{c}","type":["null","string"],"default":null}}' for c in ("due", "paid")] if kind == "with_dates" else []
    meta = [f'{{"name":"{c}","type":["null","{t}"],"default":null}}' for c, t in (("__timestamp", "long"), ("__is_deleted", "int"), ("__binlog_position", "long"))]
    return '{"type":"record","name":"invoice_next","namespace":"shop","fields":[' + ",".join([*own, *dates, *meta]) + "]}"


_HEADER = """'{"databaseName":"web","tableName":"events","timestamp":' || commit_ts_ms || ',"checkpoint":{"timestamp":' || commit_ts_ms || ',"serverId":null,"gtidSet":null,"gtid":null,"binlog":{"filename":"' || file || '","position":' || position || '}},"eventType":"' || op || '","eventTransaction":{"commitTimestamp":' || commit_ts_ms || ',"identifier":"' || txn_id || '","xxid":0,"transactionSequenceNumber":' || seq || '}}'"""
_json = lambda x: f"coalesce(to_json({x})::VARCHAR, 'null')"
_WRITTEN = "'{' || " + " || ',' || ".join(f"""'"{c}":' || {_json('shown.' + c)}""" for c in EVENT_COLUMNS) + " || '}'"
_CHANGED = "'{' || " + " || ',' || ".join(f"""'"{c}":{{"b":' || {_json('before.' + c)} || ',"a":' || {_json('image.' + c)} || '}}'""" for c in EVENT_COLUMNS) + " || '}'"
_ROW = f"""'{{"transactionUUID":"' || txn_id || '","transactionXid":0,"commitTimestamp":' || commit_ts_ms || ',"rowMicrosecondTimestamp":' || ts_us || ',"values":' || coalesce(CASE WHEN op = 'UPDATE' THEN {_CHANGED} WHEN shown IS NOT NULL THEN {_WRITTEN} END, 'null') || '}}'"""
_META = f"""'{{"eventTable":{{"db":"web","name":"events"}},"eventType":"' || op || '","columns":{payloads.columns_json(MESSAGE_COLUMNS)},"primaryKeyColumns":["user_id"]}}'"""
_BARE = """'{"eventTable":{"db":"web","name":"events"},"eventType":"' || any_value(op) || '","columns":[],"primaryKeyColumns":[]}'"""
_SHOWN = f"(SELECT *, CASE WHEN op = 'DELETE' THEN before ELSE image END AS shown FROM ({EVENTS}))"
_zigzag = lambda n: f"(2 * {n})"  # noqa: E731  of numbers that are not negative
_varint = lambda n, size: " || ".join(f"CASE WHEN {n} >= {128 ** k} THEN printf('%02X', ({n} // {128 ** k} % 128)::INT + CASE WHEN {n} >= {128 ** (k + 1)} THEN 128 ELSE 0 END) ELSE '{'00' if k == 0 else ''}' END" for k in range(size))
_WIRE = f"'0000000001' || '02' || {_varint(_zigzag('length(image.event_type)'), 2)} || hex(image.event_type) || '02' || {_varint(_zigzag('commit_ts_ms'), 9)} || '0200' || '02' || {_varint(_zigzag('position'), 9)}"
_AVRO = (
    '{"type":"record","name":"parcel","namespace":"shop","fields":[{"name":"no","type":["null","long"],"default":null},{"name":"copies","type":["int","null"],"default":4},'
    '{"name":"weight","type":["null","float"],"default":null},{"name":"total","type":["null","string"],"default":null},{"name":"city","type":["string","null"],"default":"Rome"},'
    '{"name":"state","type":["null","string"],"default":null},{"name":"__timestamp","type":["null","long"],"default":null},{"name":"__is_deleted","type":["null","int"],"default":null},'
    '{"name":"__binlog_position","type":["null","long"],"default":null}]}'
)
_IMAGE = lambda c: f"CASE WHEN op = 'DELETE' THEN before.{c} ELSE image.{c} END AS {c}"
PLANS = {
    "kafka_json_payload": (kafka_json_payload, f"""SELECT position, {_HEADER} AS key, '{{"metadata":' || {_META} || ',"rows":[' || {_ROW} || ']}}' AS value, (position % 8)::INT AS partition, commit_ts_ms AS timestamp FROM {_SHOWN}"""),
    "kafka_json_events": (kafka_json_events, f"""SELECT min(position) AS position, '{{"metadata":' || {_BARE} || ',"rows":[' || string_agg(row, ',' ORDER BY position) || ']}}' AS value FROM (SELECT *, {_ROW} AS row FROM {_SHOWN}) GROUP BY commit_ts_ms, user_id, op"""),
    "avro_wire": (avro_wire, f"SELECT position, {_WIRE} AS value, 'web-events-' || commit_ts_ms AS meta FROM ({EVENTS}) WHERE op <> 'DELETE'"),
    "avro_row_payload": (avro_row_payload, f"SELECT {', '.join(map(_IMAGE, EVENT_COLUMNS))}, commit_ts_ms AS __timestamp, (op = 'DELETE')::INT AS __is_deleted, position AS __binlog_position FROM ({EVENTS})"),
    "avro_schema_json": (avro_schema_json, f"SELECT r_regionkey, '{_AVRO}' AS avro_schema FROM region"),
    "schema_keys": (schema_keys, f"SELECT position, CASE WHEN position % 5 = 0 THEN 'bigdata-ddl-schema' ELSE 'bigdata-db-events' END AS subject, 'db-events-' || commit_ts_ms AS header, reverse(commit_ts_ms::VARCHAR) AS raw_key FROM ({EVENTS})"),
    "schema_history": (schema_history, f"SELECT * FROM (VALUES {_ROWS}) v(position, sql, tbl, before, after)"),
    "ddl_record": (
        ddl_record,
        f"""SELECT query, schema, compatible AS "isCompatibleSchemaChange" FROM (VALUES ({_text(DDL_LOG[1])}, {_text(_avro('double_as_text'))}, true), ({_text(DDL_LOG[2])}, {_text(_avro('with_dates'))}, true), ({_text(DDL_LOG[3])}, NULL, false)) v(query, schema, compatible)""",
    ),
    "schema_history_cells": (schema_history_cells, f"SELECT 'meta:shop_schema_history' AS tbl, ts::VARCHAR AS row_key, q AS qualifier, ts::BIGINT * 1000 AS ts_us, v AS value FROM (VALUES {_CELL_ROWS}) c(ts, q, v)"),
    "schema_before_after": (schema_before_after, f"SELECT position, tbl, before, after FROM (VALUES {_ROWS}) v(position, sql, tbl, before, after)"),
}
