"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: space and the controls from tab to carriage return.
SPACE = " \t\n\x0b\x0c\r"
#: The same set for a Java or RE2 pattern, negated: one word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a folder of its own; on a cluster that is an error, because a
    machine's own folder would be invisible to the other machines.
    """
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master.startswith("local[") or master == "local":
        return "file:///tmp/checkpoints/chronicell"
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def materialize(df: DataFrame, label: str, narrow: bool = True) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage and survives the loss of any executor.

    Unless ``narrow`` is false, several partitions share a file (see ``fewer_files``): for small tables after a shuffle.
    Where a scan or heavy work comes before the write, ``narrow=False`` leaves its parallelism as it is.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    (fewer_files(df) if narrow else df).write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._written_to = path
    return out


def free(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote. Only for tables that no DataFrame will read again, a lost task's included:
    what was made of them has to be written too."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fewer_files(df: DataFrame) -> DataFrame:
    """For writing small tables after a shuffle: a task and a file for eight shuffle partitions or so, at least one for
    each core. Shuffle partitions are sized for memory; a file of one would be small, and creating it costs an executor
    more than writing it."""
    spark = df.sparkSession
    return df.coalesce(max(spark.sparkContext.defaultParallelism, shuffle_width(spark) // 8))


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of an Arrow batch that goes to a Python worker: batches are counted in rows, and texts are long.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let the session send at most BATCH_ROWS rows at a time to Python workers: what a batch holds is held by the
    executor and by its worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def give_back_memory() -> None:
    """Return freed memory of a Python worker to the system: workers live on, and the next stage needs room too."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)
