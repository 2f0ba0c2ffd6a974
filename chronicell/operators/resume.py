"""Partitioning, checkpoints and resuming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _hashed(text: Column, n: int) -> Column:
    """The first 32 bits of the text's md5 modulo n: any other engine can name the partition too."""
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % n).cast("int")


def partition_by_table(db: Column, tbl: Column, n: int) -> Column:
    """Events of one table share a partition."""
    return _hashed(F.concat_ws(".", db, tbl), n)


def partition_by_xid(xid: Column, n: int) -> Column:
    """Remainder of the number's low 32 bits, taken without sign."""
    return (xid.bitwiseAND(F.lit(0xFFFFFFFF)) % n).cast("int")


def partition_by_txn(txn_id: Column, n: int) -> Column:
    """Events of one transaction share a partition."""
    return _hashed(txn_id, n)


def partition_at_random(n: int, seed: int | None = None) -> Column:
    return F.floor(F.rand(seed) * n).cast("int") if seed is not None else F.floor(F.rand() * n).cast("int")


#: Partitioners by name: each takes an event's columns (a mapping) and the number of partitions. Events that lack what
#: their partitioner looks at are dealt out at random.
PARTITIONERS = {
    "TABLE_NAME": lambda c, n: F.when(c["tbl"].isNotNull(), partition_by_table(c["db"], c["tbl"], n)).otherwise(partition_at_random(n)),
    "XXID": lambda c, n: F.when(c["xid"].isNotNull(), partition_by_xid(c["xid"], n)).otherwise(partition_at_random(n)),
    "TRID": lambda c, n: F.when(c["txn_id"].isNotNull(), partition_by_txn(c["txn_id"], n)).otherwise(partition_at_random(n)),
    "RANDOM": lambda c, n: partition_at_random(n),
    "NONE": lambda c, n: F.lit(0),
}


def partition_of(name: str, columns, n: int) -> Column:
    """Partition of an event by the partitioner of that name; an unknown name is an error."""
    if name not in PARTITIONERS:
        raise ValueError(f"unknown partitioner {name}, known: {', '.join(PARTITIONERS)}")
    return PARTITIONERS[name](columns, n)


def gtid_number(gtid: Column) -> Column:
    """The transaction number after the server's uuid."""
    return F.element_at(F.split(gtid, ":"), -1).cast("long")


def parse_gtid_sets(sets: DataFrame, gtid_set: str = "gtid_set") -> DataFrame:
    """(server, lo, hi) of every interval: ``uuid:1-5:7,uuid2:1-3``; a number alone is an interval of one."""
    one = sets.select(F.explode(F.split(F.regexp_replace(gtid_set, r"\s", ""), ",")).alias("_s")).filter("_s <> ''")
    parts = one.select(F.substring_index("_s", ":", 1).alias("server"), F.explode(F.slice(F.split("_s", ":"), 2, 1 << 30)).alias("_i"))
    return parts.select("server", F.substring_index("_i", "-", 1).cast("long").alias("lo"), F.substring_index("_i", "-", -1).cast("long").alias("hi"))


def safe_gtid_set(sets: DataFrame, gtid_set: str = "gtid_set") -> DataFrame:
    """(server, lo, hi): what all tasks together have surely done, from the sets that each of them reported.

    Of each set the first interval of a server counts. From the smallest upper limit seen, limits are followed as long
    as each is one more than the one before; the first gap ends the safe interval.
    """
    one = sets.select(F.explode(F.split(F.regexp_replace(gtid_set, r"\s", ""), ",")).alias("_s")).filter("_s <> ''")
    first = F.get(F.split("_s", ":"), F.lit(1))
    limits = one.select(F.substring_index("_s", ":", 1).alias("server"), F.substring_index(first, "-", 1).cast("long").alias("lo"), F.substring_index(first, "-", -1).cast("long").alias("hi"))
    by_server = Window.partitionBy("server").orderBy("hi")
    islands = limits.groupBy("server", "hi").agg(F.min("lo").alias("lo")).withColumn("_island", F.col("hi") - F.row_number().over(by_server))
    first_island = islands.withColumn("_first", F.min("_island").over(Window.partitionBy("server")))
    return first_island.filter("_island = _first").groupBy("server").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def last_checkpoints(written: DataFrame, partition: str = "partition", order: str = "offset", checkpoint: str = "checkpoint") -> DataFrame:
    """The checkpoint in the last record of every partition of a sink."""
    return written.groupBy(partition).agg(F.max_by(checkpoint, order).alias(checkpoint))


def skip_seen(events: DataFrame, last: DataFrame, partition: str = "partition", checkpoint: str = "checkpoint") -> DataFrame:
    """Events after the last checkpoint that their partition has written; all events of a partition without one.

    ``last`` has one row for each partition of the sink, so it is broadcast.
    """
    seen = F.broadcast(last.select(F.col(partition), F.col(checkpoint).alias("_seen")))
    joined = events.join(seen, partition, "left")
    return joined.filter(F.col("_seen").isNull() | (F.col(checkpoint) > F.col("_seen"))).drop("_seen")


def checkpoint_order(gtid: Column, ts_ms: Column, file: Column, position: Column) -> Column:
    """A struct that sorts checkpoints of one server: transaction number (none before any), then time, then place in the log."""
    return F.struct(gtid_number(gtid).alias("n"), ts_ms.alias("ts_ms"), file.alias("file"), position.alias("position"))


def checkpoint_compare(a: Column, b: Column) -> Column:
    """-1, 0 or 1 of two checkpoint structs (gtid, ts_ms, server, file, position).

    By transaction number, a missing id before any; then by time; then, only for checkpoints of the same server, by
    place in the log, a missing place before any. Checkpoints of different servers with equal numbers and times are equal.
    """
    step = lambda x, y: F.when(x.isNull() & y.isNull(), 0).when(x.isNull(), -1).when(y.isNull(), 1).when(x < y, -1).when(x > y, 1).otherwise(0)
    place = lambda c: F.when(c["file"].isNotNull(), F.struct(c["file"], c["position"]))
    by_id, by_time = step(gtid_number(a["gtid"]), gtid_number(b["gtid"])), step(a["ts_ms"], b["ts_ms"])
    by_place = F.when(a["server"].eqNullSafe(b["server"]), step(place(a), place(b))).otherwise(0)
    return F.when(by_id != 0, by_id).when(by_time != 0, by_time).otherwise(by_place)


def position_compare(a: Column, b: Column) -> Column:
    """-1, 0 or 1 of two places (file, position) of one log."""
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)
