"""Sampled validation tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronicell.functions.naming import url_encoded
from chronicell.operators.running import present, running_count


def one_in(changes: DataFrame, n: int = 100, log: Sequence[str] = (), block: Sequence[str] | None = None, order: Sequence[str] = ("position", "row_idx")) -> DataFrame:
    """Every n-th change, in log order, counted over the whole log by a prefix sum over its files (``block``: the column
    file, where there is one; ``log``: where there are several logs, what tells them apart; each then has a counter)."""
    block = present(changes, "file") if block is None else block
    return running_count(changes, log, block, order, "_rank").filter(F.col("_rank") % n == 0).drop("_rank")


def eligible(op: Column, changed: Column) -> Column:
    """Changes with updated columns: never deletes."""
    return (op != "DELETE") & (F.size(changed) > 0)


def task(source: str, target: str, table: Column, original: Column, pk_name: str, pk_value: Column, row_key: Column, columns: Column) -> Column:
    """JSON of a task: where the row is at the source and in the store, and which columns to compare."""
    return F.to_json(
        F.struct(
            F.struct(
                F.lit(source).alias("name"), original.alias("table"), F.create_map(url_encoded(F.lit(pk_name)), url_encoded(pk_value)).alias("primary_keys"),
                F.struct(F.lit("NULL").alias("map_null_columns"), F.lit(True).alias("timestamps_to_epochs"), columns.alias("keep_columns")).alias("transformations"),
            ).alias("source"),
            F.struct(F.lit(target).alias("name"), table.alias("table"), url_encoded(row_key).alias("row"), F.lit("d").alias("family"), F.struct(columns.alias("keep_columns")).alias("transformations")).alias("target"),
        )
    )
