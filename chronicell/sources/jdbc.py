"""Reading a source database: its schemas, and its tables in ranges of their key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicell.operators.snapshot import MAX_CHUNKS, MIN_CHUNK, SYSTEM_SCHEMAS, snapshot_inserts

# The columns of the standard's information schema that describe a table.
_COLUMNS = "SELECT table_schema, table_name, ordinal_position, column_name, column_type, is_nullable, column_key FROM information_schema.columns WHERE table_schema NOT IN ({})"


def schema_columns(spark: SparkSession, url: str, properties: dict | None = None, query: str | None = None) -> DataFrame:
    """(tbl, ordinal, name, column_type, nullable, key) of all user tables, as ``ddl.bootstrap`` takes them.

    ``query`` gives the same seven columns from databases with another catalog.
    """
    own = query or _COLUMNS.format(", ".join(f"'{s}'" for s in SYSTEM_SCHEMAS))
    found = spark.read.jdbc(url, f"({own}) c", properties=properties or {}).toDF("db", "tbl", "ordinal", "name", "column_type", "nullable", "key")
    return found.select(F.concat_ws(".", "db", "tbl").alias("tbl"), F.col("ordinal").cast("int").alias("ordinal"), "name", F.col("column_type").cast("string").alias("column_type"), (F.upper("nullable") == "YES").alias("nullable"), F.col("key").cast("string").alias("key"))


def key_ranges(lo: int, hi: int, min_chunk: int = MIN_CHUNK, max_chunks: int = MAX_CHUNKS) -> list[tuple[int, int]]:
    """Half-open ranges [lo, hi) that hold every key from lo to hi once; at most ``max_chunks`` + 1."""
    step = max(min_chunk, (hi - lo) // max_chunks, 1)
    return [(a, min(a + step, hi + 1)) for a in range(lo, hi + 1, step)]


def read_table(spark: SparkSession, url: str, table: str, key: str | None = None, properties: dict | None = None, min_chunk: int = MIN_CHUNK, max_chunks: int = MAX_CHUNKS) -> DataFrame:
    """A table, one partition for each range of its whole-number ``key``, which is not null; without a key in one piece."""
    properties = properties or {}
    if key is None:
        return spark.read.jdbc(url, table, properties=properties)
    ends = spark.read.jdbc(url, f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) b", properties=properties).toDF("lo", "hi").first()
    if ends.lo is None:
        return spark.read.jdbc(url, table, properties=properties)
    ranges = [f"{key} >= {a} AND {key} < {b}" for a, b in key_ranges(int(ends.lo), int(ends.hi), min_chunk, max_chunks)]
    return spark.read.jdbc(url, table, predicates=ranges, properties=properties)


def snapshot(spark: SparkSession, url: str, table: str, pk: list[str], ts_us: int, key: str | None = None, **options) -> DataFrame:
    """The table's rows as the INSERT changes that an initial snapshot stands for."""
    rows = read_table(spark, url, table, key, **options)
    return snapshot_inserts(rows.toDF(*[c.lower() for c in rows.columns]), table.split(".")[-1].lower(), pk, ts_us)
