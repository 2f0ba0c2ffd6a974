"""Contiguous shards of near equal bytes (DataFrame functions only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronicell.llm.base import materialize, shuffle_width, table, text_or_empty

SHARDS = 8
#: A group of equal texts is kept in one shard unless it weighs more than this part (per cent) of a shard's target.
GROUP_PERCENT = 1


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut the documents, in the order of their texts' md5 and then of their ids, into ``shards`` contiguous runs of near
    equal bytes; equal texts lie next to each other.

    A document weighs the UTF-8 bytes of its text (null: none) plus 1. Global prefix sums come from two levels: the
    rows are range-partitioned by that order, each partition is summed, the totals (one row for each partition) are
    prefix summed, and every row adds its partition's offset to its running sum inside the partition. The byte axis is
    cut at equal targets. A cut that falls inside a group of equal texts moves to the group's nearer end, unless the
    group weighs over GROUP_PERCENT of a shard's target: such a group is split, between its rows. A document belongs
    where its middle falls. So a shard misses its target by at most half of GROUP_PERCENT, or half a document, at each end.

    Returns id, size, text_crc32, shard, slot (0, 1, ... inside each shard, in that order). Only ids, sizes, checksums and
    md5 are shuffled, never texts, and a hot text is spread over ranges by its ids. Null ids come first; rows with equal
    ids and texts keep a slot each; null and empty texts have size 1; an empty table gives no rows; other columns are
    ignored. The driver gets the cuts, one row each.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    small = docs.select(
        F.unhex(F.md5(text.cast("binary"))).alias("_text"),
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = ["_text", "doc_id"]
    ranged = (
        materialize(small, "shard-sizes", narrow=False)
        .repartitionByRange(shuffle_width(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33))
    )
    # Written out, so that both branches below see one and the same dealing of rows to partitions.
    ranged = materialize(ranged, "shard-ranges", narrow=False)
    in_order = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_part").agg(F.sum("size").alias("_bytes"))
    offsets = totals.select("_part", F.coalesce(F.sum("_bytes").over(in_order), F.lit(0)).alias("_before"), F.sum("_bytes").over(Window.partitionBy()).alias("_total"))
    running = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("_upto", F.sum("size").over(running)).join(F.broadcast(offsets), "_part").withColumn("_from", F.col("_before") + F.col("_upto") - F.col("size"))
    placed = materialize(placed.select("doc_id", "size", "text_crc32", "_text", "_from", "_total", "_at", "_part"), "shard-prefixes")
    middle = (2 * F.col("_from") + F.col("size")) * shards
    shard = F.lit(0)
    for cut in _cuts(placed, shards):
        shard = shard + (middle >= F.lit(cut)).cast("int")
    placed = placed.withColumn("shard", shard)
    # A partition holds a run of rows, hence its rows of one shard are a run too: number those, then add what came before.
    by_part = placed.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select("shard", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    numbered = placed.withColumn("_k", F.row_number().over(Window.partitionBy("_part", "shard").orderBy("_at")))
    return numbered.join(F.broadcast(starts), ["shard", "_part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_start") + F.col("_k") - 1).cast("long").alias("slot")
    )


def _cuts(placed: DataFrame, shards: int) -> list[int]:
    """Where shards 1, 2, ... begin on the byte axis, in units of 1 / (2 x shards) of a byte."""
    total = placed.agg(F.max("_total")).first()[0]
    if total is None:
        return []
    units = [2 * k * total for k in range(1, shards)]
    inside = [(F.col("_from") * 2 * shards <= c) & (c < (F.col("_from") + F.col("size")) * 2 * shards) for c in units]
    hit = placed.filter(reduce(lambda a, b: a | b, inside, F.lit(False))).select("_text").distinct()
    groups = placed.join(F.broadcast(hit), "_text").groupBy("_text").agg(F.min("_from").alias("lo"), F.sum("size").alias("size")).collect()  # at most one for each cut
    out = []
    for c in units:
        for g in groups:
            lo, hi = g.lo * 2 * shards, (g.lo + g["size"]) * 2 * shards
            if lo < c < hi and g["size"] * shards * 100 <= GROUP_PERCENT * total:
                c = lo if c - lo <= hi - c else hi
                break
        out.append(c)
    return out


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


# DuckDB has no crc32; its table is built from the rule of the reflected polynomial 0xEDB88320.
OP6_SQL = """
WITH poly AS (
  SELECT list(list_reduce([n] || range(8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)
), sized AS (
  SELECT doc_id, md5(coalesce(text, '')) AS h, strlen(coalesce(text, '')) + 1 AS size,
    CASE WHEN coalesce(text, '') = '' THEN 0 ELSE xor(4294967295, list_reduce(
      [4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) END AS text_crc32
  FROM documents, poly
), summed AS (
  SELECT *, sum(size) OVER (ORDER BY h, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total FROM sized
), groups AS (
  SELECT min(before) * 16 AS lo, (min(before) + sum(size)) * 16 AS hi, sum(size) AS weight FROM summed GROUP BY h
), cuts AS (
  SELECT 2 * k * total AS c, total FROM (SELECT unnest(range(1, 8)) AS k), (SELECT max(total) AS total FROM summed)
), moved AS (
  SELECT CASE WHEN weight * 800 > total OR lo IS NULL THEN c WHEN c - lo <= hi - c THEN lo ELSE hi END AS c FROM cuts LEFT JOIN groups ON lo < c AND c < hi
), placed AS (
  SELECT *, (SELECT count(*) FROM moved WHERE (2 * before + size) * 8 >= c)::INT AS shard FROM summed
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY h, doc_id NULLS FIRST) - 1)::BIGINT AS slot, NULL::INT AS grown_shard
FROM placed
"""
