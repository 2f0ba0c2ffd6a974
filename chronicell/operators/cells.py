"""Changes to versioned cells: (tbl, row_key, qualifier, ts_us, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronicell.functions.decode import value_text
from chronicell.functions.naming import salted_key_of
from chronicell.operators.augment import changed_columns

#: Where a cell came from, in the order in which cells of one microsecond were written.
PLACE = ("file", "position", "row_idx")
STATUS, TXN_ID, TXN_XID = "row_status", "_transaction_uuid", "_transaction_xid"


def row_key(pk: Column, tbl: Column | None = None, txn_id: Column | None = None, payload_table: str | None = None) -> Column:
    """Salted key of the key values; rows of the payload table are keyed by their transaction instead."""
    key = F.when(F.size(pk) > 0, salted_key_of(pk)).otherwise(F.raise_error(F.lit("a table without primary key has no row key")).cast("string"))
    if payload_table is None:
        return key
    by_txn = F.coalesce(txn_id, F.raise_error(F.lit("a row of the payload table needs a transaction id")).cast("string"))
    return F.when(tbl == payload_table, by_txn).otherwise(key)


def target_table(tbl: Column, namespace: str = "") -> Column:
    return F.lower(F.concat(F.lit(f"{namespace}:" if namespace else ""), tbl))


def to_cells(changes: DataFrame, payload_table: str | None = None) -> DataFrame:
    """Cells of changes (tbl, op, pk array, before map, after map, ts_us, txn_id, xid, position, row_idx).

    INSERT writes all columns, UPDATE those whose text changed, DELETE none; each also writes its status letter, the
    transaction's id and its number. NULL is written as the word. The key is that of the after image; the key of a
    deleted row that of its before image (``pk`` holds it either way). Cells carry their place in the log (file, where
    there is one, position, row_idx), which orders those of one microsecond.
    """
    place = [c for c in PLACE if c in changes.columns]
    entries = (
        F.when(F.col("op") == "INSERT", F.col("after"))
        .when(F.col("op") == "UPDATE", changed_columns(F.col("before"), F.col("after")))
        .otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    )
    meta = F.create_map(F.lit(STATUS), F.substring("op", 1, 1), F.lit(TXN_ID), F.col("txn_id"), F.lit(TXN_XID), F.col("xid").cast("string"))
    keyed = changes.select(
        "tbl",
        row_key(F.col("pk"), F.col("tbl"), F.col("txn_id"), payload_table).alias("row_key"),
        "ts_us",
        *place,
        F.map_concat(entries, meta).alias("_cells"),
    )
    out = keyed.select("tbl", "row_key", "ts_us", *place, F.explode("_cells").alias("qualifier", "_value"))
    return out.select("tbl", "row_key", "qualifier", "ts_us", value_text(F.col("_value")).alias("value"), *place)
