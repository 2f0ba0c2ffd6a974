"""Decoding queries: raw values made from columns of the driver tables."""

from pyspark.sql import functions as F

from chronicell.functions import decode
from chronicell.session import table


def decode_unsigned(spark, sf):
    p = table(spark, sf, "part")
    raw = F.col("p_size") - 30  # some below 0, as unsigned values arrive
    wide = F.col("p_partkey") * -1 - 1
    return p.select(
        "p_partkey",
        *[decode.integer(raw, f"{k} unsigned").alias(k) for k in ("tinyint", "smallint", "mediumint", "int")],
        decode.integer(raw, "int(11)").alias("signed"),
        decode.bigint_unsigned(wide).alias("wide"),
    )


def decode_bits(spark, sf):
    return table(spark, sf, "part").select("p_partkey", decode.bits(F.col("p_size").cast("long")).alias("bits"))


ENUM, SET = ("animalia", "plantae", "fungi"), ("apple", "banana", "orange")


def decode_set_enum(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", decode.enum_member(F.col("p_partkey") % 4, ENUM).alias("kingdom"), decode.set_members(F.col("p_partkey") % 9 - 1, SET).alias("fruit"))


def decode_binary(spark, sf):
    p = table(spark, sf, "part")
    raw = F.col("p_name").cast("binary")
    return p.select("p_partkey", decode.binary_fixed(raw, 10).alias("fixed"), decode.blob(raw).alias("blob"))


def decode_text(spark, sf):
    p = table(spark, sf, "part")
    raw = F.col("p_name").cast("binary")
    return p.select("p_partkey", decode.text(raw, "latin1_swedish_ci").alias("latin"), decode.text(raw, "utf8_general_ci").alias("utf8"))


def decode_time(spark, sf):
    e = table(spark, sf, "events").withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return e.select("event_id", decode.date_text(F.col("ms")).alias("day"), decode.time_text(F.col("ms")).alias("time"), F.unix_millis(decode.timestamp(F.col("ms"))).alias("ms"))


def decode_decimal(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", decode.decimal_text(F.col("o_totalprice"), 27, 9).alias("price"))


def value_strings(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", decode.value_text(F.when(F.col("user_id") % 3 != 0, F.col("user_id"))).alias("value"))


_MASKED = ", ".join(f"(p_size - 30)::BIGINT & {m} AS {k}" for k, m in (("tinyint", 0xFF), ("smallint", 0xFFFF), ("mediumint", 0xFFFFFF), ('"int"', 0xFFFFFFFF)))
PLANS = {
    "decode_unsigned": (decode_unsigned, f"SELECT p_partkey, {_MASKED}, (p_size - 30)::BIGINT AS signed, CAST(18446744073709551616::HUGEINT - p_partkey - 1 AS DECIMAL(20,0)) AS wide FROM part"),
    "decode_bits": (decode_bits, "SELECT p_partkey, bin(p_size::BIGINT) AS bits FROM part"),
    "decode_set_enum": (
        decode_set_enum,
        "SELECT p_partkey, ['animalia', 'plantae', 'fungi'][p_partkey % 4] AS kingdom, CASE WHEN p_partkey % 9 > 1 THEN array_to_string(list_filter(['apple', 'banana', 'orange'], lambda v, i: ((p_partkey % 9 - 1) >> (i - 1)) & 1 = 1), ',') END AS fruit FROM part",
    ),
    "decode_binary": (decode_binary, "SELECT p_partkey, rpad(hex(encode(p_name)), 20, '0') AS fixed, hex(encode(p_name)) AS blob FROM part"),
    "decode_text": (decode_text, "SELECT p_partkey, p_name AS latin, p_name AS utf8 FROM part"),
    "decode_time": (decode_time, "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M:%S.%g') AS time, epoch_us(ts) // 1000 AS ms FROM events"),
    "decode_decimal": (decode_decimal, "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(27,9))::VARCHAR AS price FROM orders"),
    "value_strings": (value_strings, "SELECT event_id, CASE WHEN user_id % 3 <> 0 THEN user_id::VARCHAR ELSE 'NULL' END AS value FROM events"),
}
