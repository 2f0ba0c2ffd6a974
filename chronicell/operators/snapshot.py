"""Initial snapshot: chunk planning and the INSERT events that a snapshot stands for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Schemas that belong to the database itself.
SYSTEM_SCHEMAS = ("information_schema", "mysql", "performance_schema", "sys")
MIN_CHUNK, MAX_CHUNKS, LARGE_TABLE_BYTES = 10_000, 100_000, 512 * 1024 * 1024


def chunk_plan(rows: DataFrame, key: str, min_chunk: int = MIN_CHUNK, max_chunks: int = MAX_CHUNKS) -> DataFrame:
    """(chunk, lo, hi): half-open ranges [lo, hi) of an integer key; every key is in exactly one, a lone row too."""
    bounds = rows.agg(F.min(key).cast("long").alias("lo"), F.max(key).cast("long").alias("hi")).filter("lo IS NOT NULL")
    step = F.greatest(F.lit(min_chunk), F.floor((F.col("hi") - F.col("lo")) / max_chunks)).cast("long")
    starts = bounds.withColumn("step", step).select("hi", "step", F.explode(F.sequence("lo", "hi", "step")).alias("lo"))
    return starts.select(F.floor((F.col("lo") - F.min("lo").over(_all())) / F.col("step")).cast("long").alias("chunk"), "lo", F.least(F.col("lo") + F.col("step"), F.col("hi") + 1).alias("hi"))


def _all():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(0))  # the plan has at most max_chunks + 1 rows


def snapshot_inserts(rows: DataFrame, tbl: str, pk: list[str], ts_us: int) -> DataFrame:
    """Changes (tbl, op, pk, before, after, ts_us, txn_id, xid, position, row_idx) that insert every row at one moment."""
    text = {c: F.col(c).cast("string") for c in rows.columns}
    entries = [x for c, v in text.items() for x in (F.lit(c), v)]
    return rows.select(
        F.lit(tbl).alias("tbl"), F.lit("INSERT").alias("op"), F.array(*[text[c] for c in pk]).alias("pk"), F.lit(None).cast("map<string,string>").alias("before"),
        F.create_map(*entries).alias("after"), F.lit(ts_us).cast("long").alias("ts_us"), F.lit("initial-snapshot").alias("txn_id"), F.lit(0).cast("long").alias("xid"),
        F.lit(0).cast("long").alias("position"), F.lit(0).alias("row_idx"),
    )


def schema_filter(schema_name: str):
    """User schemas only."""
    return ~F.col(schema_name).isin(*SYSTEM_SCHEMAS)
