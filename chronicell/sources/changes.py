"""Change streams over the driver tables, deterministic and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicell.functions.naming import merged_table
from chronicell.operators import txn
from chronicell.operators.augment import current_gtid
from chronicell.session import table

EVENT_COLUMNS = ("event_type", "value", "props")
# The part of a table's name that says its month: an underscore, a year, a month.
MONTH = r"_(19|20)[0-9]{2}(0[1-9]|1[0-2])"
#: Events of ``events`` and orders of ``orders`` that fill a file of the log.
EVENTS_A_FILE, ORDERS_A_FILE = 1000, 500


def log_file(number: Column, each: int) -> Column:
    return F.concat(F.lit("binlog."), F.lpad(F.floor(number / each).cast("string"), 6, "0"))


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a log of single-change transactions on one table for each month, merged into ``events``.

    Key: user; signup inserts, error deletes, the rest updates; the commit falls on the event's second.
    """
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    rows = e.select(
        log_file(F.col("event_id"), EVENTS_A_FILE).alias("file"),
        F.col("event_id").alias("position"),
        F.col("user_id").cast("string").alias("key"),
        F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE").alias("op"),
        F.concat(F.lit("events_"), F.date_format(ts, "yyyyMM")).alias("orig_tbl"),
        F.unix_millis(F.date_trunc("second", ts)).alias("commit_ts_ms"),
        F.create_map(F.lit("event_type"), "event_type", F.lit("value"), F.col("value").cast("decimal(18,2)").cast("string"), F.lit("props"), "props").alias("image"),
    )
    rows = txn.commit_sequence(rows, log=(), ascending=True)  # the events' times never go back
    from pyspark.sql import Window

    previous = F.lag("image").over(Window.partitionBy("key").orderBy("position"))
    rows = rows.withColumn("before", F.when(F.col("op") != "INSERT", previous))
    base = txn.commit_micros(F.col("commit_ts_ms"), F.col("seq"))
    return rows.select(
        merged_table(F.col("orig_tbl"), MONTH).alias("tbl"), "orig_tbl", "op", F.array("key").alias("pk"), "before", F.when(F.col("op") != "DELETE", F.col("image")).alias("after"),
        (base - txn.SPAN_US).alias("ts_us"), F.concat(F.lit("txn:"), F.col("position").cast("string")).alias("txn_id"), F.lit(0).cast("long").alias("xid"),
        "file", "position", F.lit(0).alias("row_idx"), "commit_ts_ms", "seq",
    )


def order_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, position, commit_ts_ms, seq): ``orders`` as the commits of one log; their times go back and forth."""
    o = table(spark, sf_dir, "orders")
    commits = o.select(log_file(F.col("o_orderkey"), ORDERS_A_FILE).alias("file"), F.col("o_orderkey").alias("position"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("commit_ts_ms"))
    return txn.commit_sequence(commits, log=())


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as rows inside the transaction of their order, keyed by (order, line number).

    Line numbers repeat inside an order, so several changes of a key fall in one transaction.
    """
    o = order_commits(spark, sf_dir).withColumn("base_us", txn.commit_micros(F.col("commit_ts_ms"), F.col("seq"))).withColumnRenamed("position", "o_orderkey")
    return table(spark, sf_dir, "lineitem").join(o.drop("file"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", F.col("l_quantity").cast("decimal(18,2)").cast("string").alias("quantity"), "l_returnflag", "l_linestatus", "commit_ts_ms", "seq", "base_us"
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as raw log rows (server, file, position, kind, ts_ms, gtid): GTID, BEGIN, ROW, XID of each order.

    Orders that end in 13 lack their XID, so the next BEGIN goes on with their transaction; those that end in 14 have
    a row outside of any transaction before them. 500 orders fill a file.
    """
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    kinds = F.filter(
        F.array(
            F.struct(F.lit(0).alias("i"), F.lit("GTID").alias("kind")),
            F.struct(F.when(k % 100 == 14, 1).otherwise(-1).alias("i"), F.lit("ROW").alias("kind")),
            F.struct(F.lit(2).alias("i"), F.lit("BEGIN").alias("kind")),
            F.struct(F.lit(3).alias("i"), F.lit("ROW").alias("kind")),
            F.struct(F.when(k % 100 == 13, -1).otherwise(4).alias("i"), F.lit("XID").alias("kind")),
        ),
        lambda x: x.i >= 0,
    )
    rows = o.select(k, F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"), F.explode(kinds).alias("x"))
    return rows.select(
        F.lit("srv1").alias("server"), log_file(k, ORDERS_A_FILE).alias("file"), (k * 10 + F.col("x.i")).alias("position"), F.col("x.kind").alias("kind"), "ts_ms",
        F.when(F.col("x.kind") == "GTID", F.concat(F.lit("85503b0c-ae28-473a-ae70-86af3e61458b:"), (k + 1).cast("string"))).alias("gtid"),
    )


def one_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_changes`` as one transaction: far more than 50 changes of a key, most of which share its microsecond."""
    changes = event_changes(spark, sf_dir).withColumns({"txn_id": F.lit("load"), "base_us": F.lit(1_800_000_000_000_000).cast("long")})
    return txn.row_micros(changes, ["txn_id"], ["pk"], ["file", "position", "row_idx"])


def with_gtid(log: DataFrame) -> DataFrame:
    """The GTID in force at every event, also that of an earlier file."""
    return current_gtid(log)
