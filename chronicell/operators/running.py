"""Running values over whole logs, in two levels: inside a block and from block to block.

A window over a log would put the whole log in one task. Logs come in files of bounded size, so windows are by file, and
what all earlier files add is one small row for each file. ``by`` names the columns that tell logs apart (empty: there
is one), ``block`` those that tell the blocks of a log apart and order them, ``order`` orders events inside a block.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def present(df: DataFrame, *names: str) -> list[str]:
    """Those of the columns that there are: a log of one server or in one file need not say so."""
    return [c for c in names if c in df.columns]


def _inside(by: Sequence[str], block: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*([*by, *block] or [F.lit(0)])).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _with_earlier(events: DataFrame, by: Sequence[str], block: Sequence[str], total: Column, over_earlier) -> DataFrame:
    """Adds _earlier: ``over_earlier`` of the blocks' ``total`` over the blocks before an event's own; null for the first."""
    keys = [*by, *block]
    if not block:
        return events.withColumn("_earlier", F.lit(None))
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    totals = events.groupBy(*keys).agg(total.alias("_total")).withColumn("_earlier", over_earlier(F.col("_total")).over(earlier))
    named = totals.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_earlier")
    same = reduce(lambda a, b: a & b, (events[k].eqNullSafe(named[f"_key{i}"]) for i, k in enumerate(keys)))
    return events.join(named, same, "left").drop(*[f"_key{i}" for i in range(len(keys))])


def running_count(events: DataFrame, by: Sequence[str], block: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number of each event in its log, from 1."""
    out = _with_earlier(events, by, block, F.count("*"), F.sum)
    return out.withColumn(name, F.coalesce("_earlier", F.lit(0)) + F.row_number().over(_inside(by, block, order))).drop("_earlier")


def running_max(events: DataFrame, value: Column, by: Sequence[str], block: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Largest value at or before each event of its log."""
    out = _with_earlier(events, by, block, F.max(value), F.max)
    return out.withColumn(name, F.greatest("_earlier", F.max(value).over(_inside(by, block, order)))).drop("_earlier")


def last_known(events: DataFrame, value: Column, by: Sequence[str], block: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Latest value that is not null at or before each event of its log."""
    newest = F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))
    out = _with_earlier(events, by, block, newest, lambda c: F.last(c, ignorenulls=True))
    return out.withColumn(name, F.coalesce(F.last(value, ignorenulls=True).over(_inside(by, block, order)), "_earlier")).drop("_earlier")
