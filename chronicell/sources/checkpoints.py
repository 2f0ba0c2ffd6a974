"""Checkpoints as JSON files, and which one a run starts from.

A checkpoint is a dict: timestamp, server_id, gtid, gtid_set, file, position. Streams have Spark's own offset log besides;
this is what is exchanged with other tools and what a first run starts from.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronicell.operators.resume import safe_gtid_set

SCHEMA = "timestamp bigint, server_id bigint, gtid string, gtid_set string, file string, position bigint"


def save(spark: SparkSession, path: str, checkpoint: dict) -> None:
    """Overwrite the checkpoint at a path of any file system that Spark writes."""
    text = json.dumps(checkpoint, sort_keys=True)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def load(spark: SparkSession, path: str) -> dict | None:
    """The checkpoint at a path; None where there is none."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    rows = spark.read.text(path).limit(1).collect()
    return json.loads(rows[0].value) if rows else None


def last_of(events: DataFrame) -> dict | None:
    """The checkpoint after all of these raw events (file, position, ts_ms, gtid); None where there are none."""
    last = events.agg(F.max(F.struct("file", "position", "ts_ms")).alias("at"), F.max_by("gtid", F.when(F.col("gtid").isNotNull(), F.struct("file", "position"))).alias("gtid")).first()
    return None if last.at is None else {"timestamp": last.at.ts_ms, "gtid": last.gtid, "file": last.at.file, "position": last.at.position}


def executed_set(events: DataFrame) -> str:
    """The set of all transaction ids (gtid) of these events as text: intervals by server, in order."""
    ids = events.select(F.substring_index("gtid", ":", 1).alias("s"), F.substring_index("gtid", ":", -1).cast("long").alias("n")).filter("n IS NOT NULL").distinct()
    island = F.col("n") - F.row_number().over(Window.partitionBy("s").orderBy("n"))
    spans = ids.withColumn("_i", island).groupBy("s", "_i").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    texts = spans.groupBy("s").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("lo", "hi"))), lambda x: F.concat_ws("-", x["lo"], x["hi"])), ":").alias("t"))
    return ",".join(f"{r.s}:{r.t}" for r in texts.orderBy("s").collect())  # one row for each server


def writer(spark: SparkSession, path: str):
    """For ``Flow.post``: after each batch, the checkpoint that all of its tasks' reports (gtid_set, timestamp) allow."""

    def post(reported: DataFrame) -> None:
        if found := safe_checkpoint(reported):
            save(spark, path, found)

    return post


def resolve(override_file: tuple[str, int] | None = None, override_gtid_set: str | None = None, stored: dict | None = None, default: dict | None = None) -> dict | None:
    """What a run starts from: an override by log position, then one by GTID set, then the stored, then the default."""
    if override_file is not None:
        return {"file": override_file[0], "position": override_file[1]}
    if override_gtid_set is not None:
        return {"gtid_set": override_gtid_set}
    return stored or default


def safe_checkpoint(reported: DataFrame) -> dict | None:
    """The checkpoint that all tasks have surely passed, from (gtid_set, timestamp) rows that they reported.

    Reports without a set or with a time of 0 do not count. The time is that of a report of exactly the safe set, if there
    is one, else the smallest.
    """
    real = reported.filter("gtid_set IS NOT NULL AND gtid_set <> '' AND timestamp > 0")
    parts = sorted((r.server, r.lo, r.hi) for r in safe_gtid_set(real).collect())  # one row for each server
    if not parts:
        return None
    text = ",".join(f"{s}:{lo}-{hi}" for s, lo, hi in parts)
    row = real.agg(F.max(F.when(F.col("gtid_set") == text, F.col("timestamp"))).alias("exact"), F.min("timestamp").alias("least")).first()
    return {"gtid_set": text, "timestamp": row.exact if row.exact is not None else row.least}
