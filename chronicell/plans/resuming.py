"""Partitioning, checkpoints, validation and snapshot queries."""

from pyspark.sql import functions as F

from chronicell.functions.naming import salted_key_of
from chronicell.operators import resume, snapshot, validate
from chronicell.operators.augment import changed_columns
from chronicell.operators.cells import to_cells
from chronicell.session import table
from chronicell.sources.changes import event_changes, raw_log


def partition_by_table(spark, sf):
    e = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("db"), F.col("l_linestatus").alias("tbl"))
    p = resume.partition_by_table(F.col("db"), F.col("tbl"), 8)
    return e.groupBy("db", "tbl", p.alias("partition")).agg(F.count("*").alias("n"))


def partition_by_xid(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", resume.partition_by_xid(F.col("o_orderkey") * 3_000_000_019, 16).alias("partition"))


def partition_by_txn(spark, sf):
    c = event_changes(spark, sf)
    return c.select("position", resume.partition_of("TRID", c, 8).alias("partition"))


def checkpoint_compare(spark, sf):
    """Neighbouring orders' checkpoints: those of one server in three lack an id, every other pair is of two servers."""
    o = table(spark, sf, "orders").filter("o_orderkey >= 0")
    k = F.col("o_orderkey")
    point = lambda n, odd: F.struct(F.when(n % 3 != 0, F.concat(F.lit("u:"), F.floor(n / 4).cast("string"))).alias("gtid"), (F.floor(n / 6) * 1000).alias("ts_ms"), F.when(n % 2 == odd, "a").otherwise("b").alias("server"), F.when(n % 5 != 0, F.concat(F.lit("f"), (n % 2).cast("string"))).alias("file"), n.alias("position"))
    both = o.select(k, point(k, 0).alias("a"), point(k + 1, F.when(k % 4 < 2, 0).otherwise(1)).alias("b"))
    return both.select("o_orderkey", resume.checkpoint_compare(F.col("a"), F.col("b")).alias("compared"))


def _sets(spark, sf):
    """Sets that tasks report: server by nation, upper limits by customer, with gaps."""
    c = table(spark, sf, "customer")
    hi = F.col("c_custkey") + F.floor(F.col("c_custkey") / 700) * 5
    return c.select(F.concat(F.lit("srv-"), (F.col("c_custkey") % 4).cast("string"), F.lit(":1-"), (F.floor(hi / 4) + 10).cast("string"), F.lit(":900000-900001")).alias("gtid_set"))


def safe_gtid_set(spark, sf):
    return resume.safe_gtid_set(_sets(spark, sf))


def parse_gtid_sets(spark, sf):
    return resume.parse_gtid_sets(_sets(spark, sf)).groupBy("server").agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _written(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset"), (F.col("event_id") * 2).alias("checkpoint"))


def last_checkpoint(spark, sf):
    return resume.last_checkpoints(_written(spark, sf))


def seek_resume(spark, sf):
    w = _written(spark, sf)
    last = resume.last_checkpoints(w.filter("event_id % 10 < 6 AND partition < 3 AND event_id < 5000"))
    return resume.skip_seen(w, last).select("event_id", "partition")


def min_checkpoint(spark, sf):
    g = raw_log(spark, sf).filter("gtid IS NOT NULL")
    least = F.min_by(F.struct("gtid", "file", "position", "ts_ms"), resume.checkpoint_order(F.col("gtid"), F.col("ts_ms"), F.col("file"), F.col("position")))
    return g.groupBy("server").agg(least.alias("c")).select("server", "c.*")


def validation_sample(spark, sf):
    c = validate.one_in(event_changes(spark, sf), 100)
    changed = F.when(F.col("op") == "UPDATE", F.array_sort(F.map_keys(changed_columns(F.col("before"), F.col("after"))))).when(F.col("op") == "INSERT", F.array_sort(F.map_keys("after"))).otherwise(F.array().cast("array<string>"))
    c = c.withColumn("changed", changed).filter(validate.eligible(F.col("op"), F.col("changed")))
    task = validate.task("mysql-main", "bigtable-main", F.col("tbl"), F.col("orig_tbl"), "user id", F.get("pk", F.lit(0)), salted_key_of(F.col("pk")), F.col("changed"))
    return c.select("position", task.alias("task"))


def chunk_plan(spark, sf):
    return snapshot.chunk_plan(table(spark, sf, "orders"), "o_orderkey", min_chunk=1000)


def snapshot_cells(spark, sf):
    s = snapshot.snapshot_inserts(table(spark, sf, "nation").select("n_nationkey", "n_name"), "nation", ["n_nationkey"], 1_500_000)
    return to_cells(s).select("tbl", "row_key", "qualifier", "ts_us", "value")


_SETS = "SELECT 'srv-' || (c_custkey % 4) AS server, (c_custkey + c_custkey // 700 * 5) // 4 + 10 AS hi FROM customer"
_TASK = """
'{"source":{"name":"mysql-main","table":"' || orig_tbl || '","primary_keys":{"user+id":"' || user_id || '"},"transformations":{"map_null_columns":"NULL","timestamps_to_epochs":true,"keep_columns":' || cols || '}},"target":{"name":"bigtable-main","table":"events","row":"' || substr(md5(user_id::VARCHAR), 1, 8) || '%3B' || user_id || '","family":"d","transformations":{"keep_columns":' || cols || '}}}'"""


def _task_sql():
    from chronicell.plans.cells import EVENTS

    diff = lambda c: f"CASE WHEN op = 'INSERT' OR coalesce(before.{c}, 'NULL') <> coalesce(image.{c}, 'NULL') THEN '\"{c}\"' END"
    cols = f"'[' || concat_ws(',', {', '.join(diff(c) for c in ('event_type', 'props', 'value'))}) || ']'"
    return f"SELECT position, {_TASK} AS task FROM (SELECT *, {cols} AS cols FROM (SELECT *, row_number() OVER (ORDER BY position) AS r FROM ({EVENTS}))) WHERE r % 100 = 0 AND op <> 'DELETE' AND cols <> '[]'"


_NATION = "substr(md5(n_nationkey::VARCHAR), 1, 8) || ';' || n_nationkey"
_hashed = lambda text: f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % 8)::INT"


def _compare_sql():
    """The comparison of ``checkpoint_compare``, with missing values as the lowest of their kind."""
    side = lambda n, odd: f"CASE WHEN {n} % 3 <> 0 THEN {n} // 4 ELSE -1 END AS g, {n} // 6 AS t, {n} % 2 = {odd} AS s, CASE WHEN {n} % 5 <> 0 THEN {n} % 2 ELSE -1 END AS f, CASE WHEN {n} % 5 <> 0 THEN {n} ELSE -1 END AS p"
    sides = f"(SELECT o_orderkey, {side('o_orderkey', '0')} FROM orders) a JOIN (SELECT o_orderkey, {side('(o_orderkey + 1)', '(CASE WHEN o_orderkey % 4 < 2 THEN 0 ELSE 1 END)')} FROM orders) b USING (o_orderkey)"
    place = "CASE WHEN a.s = b.s THEN coalesce(nullif(sign(a.f - b.f), 0), sign(a.p - b.p)) ELSE 0 END"
    return f"SELECT o_orderkey, coalesce(nullif(sign(a.g - b.g), 0), nullif(sign(a.t - b.t), 0), {place})::INT AS compared FROM {sides}"


PLANS = {
    "partition_by_table": (partition_by_table, f"SELECT l_returnflag AS db, l_linestatus AS tbl, {_hashed("l_returnflag || '.' || l_linestatus")} AS partition, count(*) AS n FROM lineitem GROUP BY ALL"),
    "partition_by_xid": (partition_by_xid, "SELECT o_orderkey, (((o_orderkey * 3000000019) & 4294967295) % 16)::INT AS partition FROM orders"),
    "partition_by_txn": (partition_by_txn, f"SELECT event_id AS position, {_hashed("'txn:' || event_id")} AS partition FROM events"),
    "checkpoint_compare": (checkpoint_compare, _compare_sql()),
    "parse_gtid_sets": (parse_gtid_sets, f"SELECT server, 2 * count(*) AS n, 1::BIGINT AS lo, greatest(max(hi), 900001)::BIGINT AS hi FROM ({_SETS}) GROUP BY server"),
    "safe_gtid_set": (
        safe_gtid_set,
        f"WITH d AS (SELECT DISTINCT server, hi FROM ({_SETS})), i AS (SELECT *, hi - row_number() OVER (PARTITION BY server ORDER BY hi) AS isl FROM d), f AS (SELECT *, min(isl) OVER (PARTITION BY server) AS m FROM i) SELECT server, 1::BIGINT AS lo, max(hi)::BIGINT AS hi FROM f WHERE isl = m GROUP BY server",
    ),
    "last_checkpoint": (last_checkpoint, "SELECT user_id % 4 AS partition, max(event_id) * 2 AS checkpoint FROM events GROUP BY 1"),
    "seek_resume": (
        seek_resume,
        "WITH w AS (SELECT event_id, user_id % 4 AS partition FROM events), l AS (SELECT partition, max(event_id) AS seen FROM w WHERE event_id % 10 < 6 AND partition < 3 AND event_id < 5000 GROUP BY 1) SELECT event_id, partition FROM w LEFT JOIN l USING (partition) WHERE seen IS NULL OR event_id > seen",
    ),
    "min_checkpoint": (min_checkpoint, "SELECT 'srv1' AS server, '85503b0c-ae28-473a-ae70-86af3e61458b:' || (k + 1) AS gtid, 'binlog.' || lpad((k // 500)::VARCHAR, 6, '0') AS file, k * 10 AS position, ts_ms FROM (SELECT min(o_orderkey) AS k, epoch_ms(arg_min(o_orderdate, o_orderkey)) AS ts_ms FROM orders)"),
    "validation_sample": (validation_sample, _task_sql()),
    "chunk_plan": (
        chunk_plan,
        "WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi, greatest(1000, (max(o_orderkey) - min(o_orderkey)) // 100000)::BIGINT AS step FROM orders) SELECT (s - lo) // step AS chunk, s AS lo, least(s + step, hi + 1) AS hi FROM (SELECT *, unnest(generate_series(lo, hi, step)) AS s FROM b)",
    ),
    "snapshot_cells": (
        snapshot_cells,
        f"SELECT 'nation' AS tbl, {_NATION} AS row_key, q AS qualifier, 1500000::BIGINT AS ts_us, CASE q WHEN 'n_nationkey' THEN n_nationkey::VARCHAR WHEN 'n_name' THEN n_name WHEN 'row_status' THEN 'I' WHEN '_transaction_uuid' THEN 'initial-snapshot' ELSE '0' END AS value FROM nation, (SELECT unnest(['n_nationkey', 'n_name', 'row_status', '_transaction_uuid', '_transaction_xid']) AS q)",
    ),
}
