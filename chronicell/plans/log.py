"""Queries over the raw log: dispatch, filters, statements, transactions."""

from pyspark.sql import functions as F

from chronicell.functions.naming import merged_table, plain_table, without_database
from chronicell.operators import augment, ddl, txn
from chronicell.session import table
from chronicell.sources.changes import EVENTS_A_FILE, MONTH, event_changes, log_file, order_commits, order_lines, raw_log, with_gtid

# Statements by event id, as a log would carry them: (statement, whether all pairs of a rename stay inside of the schema
# shop, whether a replica of shop keeps it). The last two are stated by hand, for the check.
STATEMENTS = (
    ("BEGIN", True, True),
    ("COMMIT", True, True),
    ("/* release 7 */ CREATE TABLE IF NOT EXISTS shop.invoice (no INT NOT NULL, PRIMARY KEY (no))", True, True),
    ("ALTER TABLE invoice ADD COLUMN paid DATE", True, True),
    ("TRUNCATE TABLE invoice", True, True),
    ("DROP VIEW open_invoices", True, True),
    ("ALTER DEFINER = admin VIEW v AS SELECT 1", True, True),
    ("CREATE TEMPORARY TABLE scratch (a INT)", True, True),
    ("ANALYZE TABLE invoice", True, True),
    ("RENAME TABLE shop.invoice TO shop.invoice_2019, invoice_next TO invoice", True, True),
    ("RENAME TABLE `invoice` TO `archive`.`invoice`", False, False),
    ("use shop; DROP TABLE `shop`.`invoice`", True, True),
    ("ALTER TABLE archive.invoice ADD COLUMN paid DATE", True, False),
    ("RENAME TABLE a TO b, shop.b TO archive.b", False, False),
    ("DROP TABLE `archive`.`invoice`", True, False),
)


def statements(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.get(F.array(*[F.lit(x) for x, _, _ in STATEMENTS]), (F.col("event_id") % len(STATEMENTS)).cast("int")).alias("sql"))


_SQL_LIST = "[" + ", ".join("'" + s.replace("'", "''") + "'" for s, _, _ in STATEMENTS) + "]"
_flag = lambda k: f"[{', '.join(str(s[k]).lower() for s in STATEMENTS)}][event_id % {len(STATEMENTS)} + 1]"
_STATEMENTS = f"SELECT event_id, {_SQL_LIST}[event_id % {len(STATEMENTS)} + 1] AS sql FROM events"


def query_classify(spark, sf):
    s = statements(spark, sf)
    return s.select("event_id", ddl.classify(F.col("sql")).alias("kind"), ddl.ddl_operation(F.col("sql")).alias("operation"), ddl.ddl_table(F.col("sql")).alias("tbl"))


_CLASSIFY = "CASE " + " ".join(f"WHEN regexp_matches(sql, '(?is){p}') THEN '{k}'" for k, p in ddl.PATTERNS) + " ELSE 'UNKNOWN' END"
_OPERATION = r"upper(regexp_extract(sql, '(?is)^(?:/\*.*?\*/\s*)?(alter|drop|create|rename|truncate|modify|analyze)\s', 1))"


def rename_guard(spark, sf):
    s = statements(spark, sf)
    return s.select("event_id", ddl.rename_stays_inside(F.col("sql"), "shop").alias("inside"), ddl.ddl_kept(F.lit("shop"), F.col("sql"), "shop", F.lit(True)).alias("kept"))


def name_rewrite(spark, sf):
    return statements(spark, sf).select("event_id", without_database(F.col("sql"), "shop").alias("sql"), plain_table(F.concat(F.lit("`shop`.`t"), F.col("event_id").cast("string"), F.lit("`"))).alias("tbl"))


RAW_TYPES = ("WRITE_ROWS", "EXT_UPDATE_ROWS", "DELETE_ROWS", "QUERY", "XID", "HEARTBEAT", "TABLE_MAP")


def event_dispatch(spark, sf):
    e = table(spark, sf, "events")
    raw = F.get(F.array(*map(F.lit, RAW_TYPES)), (F.col("event_id") % len(RAW_TYPES)).cast("int"))
    return e.select("event_id", augment.operation(raw).alias("op")).filter("op IS NOT NULL")


def op_counts(spark, sf):
    return event_changes(spark, sf).groupBy("op").agg(F.count("*").alias("n"))


def table_include_exclude(spark, sf):
    p = table(spark, sf, "part")
    kept = augment.table_allowed(F.col("p_brand"), include=["Brand#1", "Brand#2", "Brand#13", "Brand#21"], exclude=["Brand#2"], exclude_pattern="#.3$")
    return p.filter(kept & augment.in_schema(F.col("p_type"), "ECONOMY")).select("p_partkey", "p_brand")


def table_merge(spark, sf):
    e = table(spark, sf, "events").select(F.concat(F.lit("events_"), F.date_format(F.col("ts").cast("timestamp"), "yyyyMM")).alias("orig_tbl"))
    return e.groupBy("orig_tbl").agg(F.count("*").alias("n")).select(merged_table(F.col("orig_tbl"), MONTH).alias("tbl"), "orig_tbl", "n")


def _events_log(spark, sf):
    return table(spark, sf, "events").select("*", log_file(F.col("event_id"), EVENTS_A_FILE).alias("file_name"))


def table_map_lookup(spark, sf):
    e = _events_log(spark, sf).select("event_id", "file_name", (F.col("user_id") % 5).alias("table_id"), F.when(F.col("event_type") == "signup", F.concat(F.lit("db.t"), F.col("event_id").cast("string"))).alias("mapped"))
    return augment.known_before(e, F.col("mapped"), ["table_id"], ["event_id"], "name", ["file_name"]).filter("name IS NOT NULL").select("event_id", "table_id", "name")


def gtid_attach(spark, sf):
    return with_gtid(raw_log(spark, sf)).select("file", "position", "kind", "current_gtid")


def log_tracking(spark, sf):
    """File and position in force at every event, from rotation events that name the file (one in 50) and from the
    next positions that events carry (all but one in 7)."""
    e = _events_log(spark, sf).select(
        "event_id", "file_name", (F.col("user_id") % 3).alias("server"), F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("binlog."), F.col("event_id").cast("string"))).alias("rotate"),
        F.when(F.col("event_id") % 7 != 0, F.col("event_id") * 100).alias("next_position"),
    )
    known = augment.known_before(e, F.col("rotate"), ["server"], ["event_id"], "file", ["file_name"])
    return augment.known_before(known, F.col("next_position"), ["server"], ["event_id"], "position", ["file_name"]).select("event_id", "server", "file", "position")


def txn_assemble(spark, sf):
    return txn.assemble(raw_log(spark, sf)).filter("kind = 'ROW'").select("file", "position", "txn_no")


def txn_stamp(spark, sf):
    """The commit's time, id and sequence number on every event of its transaction."""
    log = augment.current_gtid(raw_log(spark, sf)).withColumn("gtid", F.col("current_gtid"))
    return txn.stamp_commits(txn.assemble(log)).select("file", "position", "kind", "txn_no", "commit_ts_ms", "commit_gtid", "seq")


def row_extract(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.array(F.struct(F.lit(None).cast("map<string,string>").alias("before"), F.create_map(F.lit("t"), "event_type").alias("after")), F.struct(F.create_map(F.lit("t"), "event_type").alias("before"), F.create_map(F.lit("t"), F.upper("event_type")).alias("after"))).alias("rows"))
    r = augment.extract_rows(e)
    return r.select("event_id", "row_idx", F.try_element_at("before", F.lit("t")).alias("before"), F.try_element_at("after", F.lit("t")).alias("after"))


def txn_sequence(spark, sf):
    return order_commits(spark, sf).select("position", "commit_ts_ms", "seq")


def commit_override_us(spark, sf):
    return txn_sequence(spark, sf).select("position", txn.commit_micros(F.col("commit_ts_ms"), F.col("seq")).alias("base_us"))


LINE_KEY = ["l_orderkey", "l_linenumber"]
#: Lines of an order that share a number follow one another in this order.
LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def row_us_order(spark, sf):
    r = txn.row_micros(order_lines(spark, sf), ["l_orderkey"], ["l_linenumber"], LINE_ORDER)
    return r.select(*LINE_KEY, "l_partkey", "l_suppkey", "ts_us")


def row_us_cap(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.lit(1_000_000).cast("long").alias("base_us"))
    return txn.row_micros(e, ["user_id"], ["user_id"], ["event_id"]).select("event_id", "user_id", "ts_us")


def txn_chunks(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id")
    return txn.chunk_no(e, ["user_id"], ["event_id"], 20).select("event_id", "user_id", "chunk")


def sequence_sql(commits: str, log: str) -> str:
    """Adds seq to commits (position, commit_ts_ms) of a log that ``log`` tells apart, whose times may go back."""
    n = "count(CASE WHEN commit_ts_ms = newest THEN 1 END) OVER (PARTITION BY {} newest ORDER BY position ROWS UNBOUNDED PRECEDING) - 1".format(log and f"{log},")
    newest = f"max(commit_ts_ms) OVER ({log and f'PARTITION BY {log}'} ORDER BY position ROWS UNBOUNDED PRECEDING)"
    counted = f"SELECT *, CASE WHEN n = 0 THEN 0 ELSE (n - 1) % 9999 + 1 END AS c FROM (SELECT *, {n} AS n FROM (SELECT *, {newest} AS newest FROM ({commits})))"
    return f"SELECT * EXCLUDE (newest, n, c), (CASE WHEN commit_ts_ms < newest AND c = 9999 THEN 0 ELSE c END)::BIGINT AS seq FROM ({counted})"


ORDER_SEQ = f"SELECT *, commit_ts_ms * 1000 + seq * 100 AS base_us FROM ({sequence_sql('SELECT o_orderkey AS position, epoch_ms(o_orderdate) AS commit_ts_ms FROM orders', '')})"
LINES = f"SELECT l.*, s.commit_ts_ms, s.seq, s.base_us FROM lineitem l JOIN ({ORDER_SEQ}) s ON l.l_orderkey = s.position"
RAW_LOG = """
SELECT 'srv1' AS server, 'binlog.' || lpad((k // 500)::VARCHAR, 6, '0') AS file, k * 10 + i AS position, kind, epoch_ms(o_orderdate) AS ts_ms,
  CASE WHEN kind = 'GTID' THEN '85503b0c-ae28-473a-ae70-86af3e61458b:' || (k + 1) END AS gtid
FROM (SELECT o_orderkey AS k, o_orderdate FROM orders) CROSS JOIN (VALUES (0, 'GTID'), (1, 'ROW'), (2, 'BEGIN'), (3, 'ROW'), (4, 'XID')) v(i, kind)
WHERE NOT (i = 1 AND k % 100 <> 14) AND NOT (i = 4 AND k % 100 = 13)"""
ASSEMBLED = f"""
WITH log AS ({RAW_LOG}),
a AS (SELECT *, coalesce(sum((kind IN ('COMMIT', 'XID'))::INT) OVER (PARTITION BY server, file ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS no FROM log),
b AS (SELECT *, max((kind = 'BEGIN')::INT) OVER (PARTITION BY server, file, no ORDER BY position ROWS UNBOUNDED PRECEDING) AS begun, max((kind IN ('COMMIT', 'XID'))::INT) OVER (PARTITION BY server, file, no) AS ends FROM a)
SELECT *, CASE WHEN begun = 1 THEN no END AS txn_no FROM b WHERE begun = 0 OR ends = 1"""
_GTID_LOG = f"SELECT * REPLACE (last_value(gtid IGNORE NULLS) OVER (PARTITION BY server ORDER BY file, position ROWS UNBOUNDED PRECEDING) AS gtid) FROM ({ASSEMBLED})"
_COMMITS = sequence_sql(f"SELECT server, file, position, txn_no, gtid AS commit_gtid, ts_ms AS commit_ts_ms FROM ({_GTID_LOG}) WHERE kind IN ('COMMIT', 'XID')", "server")
PLANS = {
    "op_counts": (op_counts, "SELECT CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op, count(*) AS n FROM events GROUP BY 1"),
    "event_dispatch": (event_dispatch, "SELECT event_id, ['INSERT', 'UPDATE', 'DELETE', 'QUERY', 'QUERY'][event_id % 7 + 1] AS op FROM events WHERE event_id % 7 < 5"),
    "query_classify": (query_classify, f"SELECT event_id, {_CLASSIFY} AS kind, nullif({_OPERATION}, '') AS operation, coalesce(regexp_extract(sql, '(?is){dict(ddl.PATTERNS)['DDL_TABLE']}', 4), '') AS tbl FROM ({_STATEMENTS})"),
    "rename_guard": (rename_guard, f"SELECT event_id, {_flag(1)} AS inside, {_flag(2)} AS kept FROM events"),
    "name_rewrite": (name_rewrite, rf"SELECT event_id, regexp_replace(regexp_replace(sql, ' `?shop`?\.', ' ', 'g'), 'use\s+`?shop`?;\s+', '', 'g') AS sql, 't' || event_id AS tbl FROM ({_STATEMENTS})"),
    "table_include_exclude": (table_include_exclude, "SELECT p_partkey, p_brand FROM part WHERE p_type = 'ECONOMY' AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#13', 'Brand#21') AND p_brand <> 'Brand#2' AND NOT regexp_matches(p_brand, '#.3$')"),
    "table_merge": (table_merge, "SELECT regexp_replace('events_' || strftime(ts, '%Y%m'), '_(19|20)[0-9]{2}(0[1-9]|1[0-2])', '', 'g') AS tbl, 'events_' || strftime(ts, '%Y%m') AS orig_tbl, count(*) AS n FROM events GROUP BY ALL"),
    "table_map_lookup": (
        table_map_lookup,
        "SELECT * FROM (SELECT event_id, user_id % 5 AS table_id, last_value(CASE WHEN event_type = 'signup' THEN 'db.t' || event_id END IGNORE NULLS) OVER (PARTITION BY user_id % 5 ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS name FROM events) WHERE name IS NOT NULL",
    ),
    "gtid_attach": (gtid_attach, f"SELECT file, position, kind, last_value(gtid IGNORE NULLS) OVER (PARTITION BY server ORDER BY file, position ROWS UNBOUNDED PRECEDING) AS current_gtid FROM ({RAW_LOG})"),
    "log_tracking": (log_tracking, "SELECT event_id, user_id % 3 AS server, last_value(CASE WHEN event_id % 50 = 0 THEN 'binlog.' || event_id END IGNORE NULLS) OVER w AS file, last_value(CASE WHEN event_id % 7 <> 0 THEN event_id * 100 END IGNORE NULLS) OVER w AS position FROM events WINDOW w AS (PARTITION BY user_id % 3 ORDER BY event_id ROWS UNBOUNDED PRECEDING)"),
    "row_extract": (row_extract, "SELECT event_id, v.i AS row_idx, CASE WHEN v.i = 1 THEN event_type END AS before, CASE WHEN v.i = 0 THEN event_type ELSE upper(event_type) END AS after FROM events CROSS JOIN (VALUES (0), (1)) v(i)"),
    "txn_assemble": (txn_assemble, f"SELECT file, position, txn_no FROM ({ASSEMBLED}) WHERE kind = 'ROW'"),
    "txn_stamp": (txn_stamp, f"SELECT a.file, a.position, a.kind, a.txn_no, c.commit_ts_ms, c.commit_gtid, c.seq FROM ({ASSEMBLED}) a LEFT JOIN ({_COMMITS}) c ON a.server = c.server AND a.file = c.file AND a.txn_no = c.txn_no"),
    "txn_sequence": (txn_sequence, f"SELECT position, commit_ts_ms, seq FROM ({ORDER_SEQ})"),
    "commit_override_us": (commit_override_us, f"SELECT position, base_us FROM ({ORDER_SEQ})"),
    "row_us_order": (row_us_order, f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, least(base_us - 51 + row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice), base_us) AS ts_us FROM ({LINES})"),
    "row_us_cap": (row_us_cap, "SELECT event_id, user_id, least(1000000 - 51 + row_number() OVER (PARTITION BY user_id ORDER BY event_id), 1000000) AS ts_us FROM events"),
    "txn_chunks": (txn_chunks, "SELECT event_id, user_id, ((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 20)::BIGINT AS chunk FROM events"),
}
