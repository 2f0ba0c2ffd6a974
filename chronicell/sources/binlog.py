"""Recorded raw events: schema, start positions, batch and stream readers.

Recorded logs are JSON lines of one event each, or the database's own binary files (``datasource``), with one schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_IMAGE = "map<string,string>"
RAW_SCHEMA = (
    "server string, file string, position bigint, ts_ms bigint, event_type string, table_id bigint, db string, tbl string, sql string, gtid string, gtid_set string, xid bigint, "
    f"rows array<struct<before:{_IMAGE},after:{_IMAGE}>>"
)


def read_log(spark: SparkSession, path: str, start: dict | None = None) -> DataFrame:
    """Events after a checkpoint (see ``start_filter``)."""
    return start_filter(spark.read.schema(RAW_SCHEMA).json(path), start)


def stream_log(spark: SparkSession, path: str, start: dict | None = None, files_per_batch: int = 10) -> DataFrame:
    return start_filter(spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(path), start)


def start_filter(events: DataFrame, start: dict | None = None, fallback: bool = False) -> DataFrame:
    """``start``: {"gtid_set": "uuid:1-5,..."} leaves out the transactions in the set, {"file", "position"} what lies
    up to there; an empty or missing checkpoint reads everything. A set comes before a file position. A checkpoint that
    has neither (its log is gone, say) is an error, or, with ``fallback``, reads what the log still holds."""
    if not start:
        return events
    if start.get("gtid_set"):
        done = F.lit(False)
        for part in start["gtid_set"].replace(" ", "").split(","):
            server, *intervals = part.split(":")
            n = F.when(F.substring_index("gtid", ":", 1) == server, F.substring_index("gtid", ":", -1).cast("long"))
            for i in intervals:
                lo, _, hi = i.partition("-")
                done = done | n.between(int(lo), int(hi or lo))
        return events.filter(~F.coalesce(done, F.lit(False)))
    if start.get("file") is not None and start.get("position") is not None:
        return events.filter(F.struct("file", "position") > F.struct(F.lit(start["file"]).alias("file"), F.lit(start["position"]).cast("long").alias("position")))
    if fallback:
        return events
    raise ValueError("a checkpoint needs a gtid_set, or a file and a position")


def flatten_config(config: dict, prefix: str = "") -> dict:
    """Nested settings as dotted keys."""
    out: dict = {}
    for k, v in config.items():
        out |= flatten_config(v, f"{prefix}{k}.") if isinstance(v, dict) else {f"{prefix}{k}": v}
    return out
