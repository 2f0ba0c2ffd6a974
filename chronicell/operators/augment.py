"""From raw log events to changes: dispatch, filters, look-ups by position, row extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronicell.functions.decode import value_text
from chronicell.functions.naming import merged_table
from chronicell.operators.running import last_known

# Raw event kinds that carry rows or statements, and what they become.
OPERATIONS = {
    "WRITE_ROWS": "INSERT",
    "EXT_WRITE_ROWS": "INSERT",
    "UPDATE_ROWS": "UPDATE",
    "EXT_UPDATE_ROWS": "UPDATE",
    "DELETE_ROWS": "DELETE",
    "EXT_DELETE_ROWS": "DELETE",
    "QUERY": "QUERY",
    "XID": "QUERY",
}
DATA_OPERATIONS = ("INSERT", "UPDATE", "DELETE")


def operation(event_type: Column) -> Column:
    """INSERT, UPDATE, DELETE or QUERY; null for events that are not replicated."""
    out = F.lit(None).cast("string")
    for raw, op in OPERATIONS.items():
        out = F.when(event_type == raw, op).otherwise(out)
    return out


def data_events(events: DataFrame, op: str = "op") -> DataFrame:
    return events.filter(F.col(op).isin(*DATA_OPERATIONS))


def table_allowed(table: Column, include: Sequence[str] = (), exclude: Sequence[str] = (), exclude_pattern: str | None = None) -> Column:
    """Not excluded by name or pattern, and included if there is an include list: both hold."""
    out = F.lit(True)
    if exclude:
        out = out & ~table.isin(*exclude)
    if exclude_pattern:
        out = out & ~table.rlike(exclude_pattern)
    if include:
        out = out & table.isin(*include)
    return out


def in_schema(db: Column, schema: str) -> Column:
    return db == schema


def known_before(events: DataFrame, value: Column, by: Sequence[str], order: Sequence[str], name: str, block: Sequence[str] = (), required: bool = False) -> DataFrame:
    """The latest non-null ``value`` at or before each event: table of a table id, file of a position, current GTID.

    ``by`` tells logs (or ids inside them) apart. Where that leaves whole logs, ``block`` names the files that they come
    in: windows are then by file, and what earlier files knew is carried over. ``required``: an event before any value
    is an error, as a row event with an unknown table id is.
    """
    if block:
        out = last_known(events, value, by, block, order, name)
    else:
        upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = events.withColumn(name, F.last(value, ignorenulls=True).over(upto))
    if required:
        unknown = F.raise_error(F.concat(F.lit(f"no {name} known at "), F.concat_ws(", ", *[F.col(c).cast("string") for c in (*by, *block, *order)])))
        out = out.withColumn(name, F.coalesce(name, unknown.cast(out.schema[name].dataType)))
    return out


def current_gtid(events: DataFrame, kind: str = "REAL", by: Sequence[str] = ("server",), block: Sequence[str] = ("file",), order: Sequence[str] = ("position",), name: str = "current_gtid") -> DataFrame:
    """The transaction id in force at every event (gtid, pseudo_gtid): GTID events set the REAL one, marker statements
    the PSEUDO one; ids of the other kind than the one asked for are left out."""
    if kind not in ("REAL", "PSEUDO"):
        raise ValueError(f"unknown kind of transaction id: {kind}")
    return known_before(events, F.col("gtid" if kind == "REAL" else "pseudo_gtid"), by, order, name, block)


#: Event filters by name: each takes (events, settings).
FILTERS = {
    "IDENTITY": lambda events, settings: events,
    "TABLE_MERGE_PATTERN": lambda events, settings: events.withColumns({"orig_tbl": F.col("tbl"), "tbl": merged_table(F.col("tbl"), settings["pattern"])}),
}


def event_filter(events: DataFrame, name: str = "IDENTITY", settings: dict | None = None) -> DataFrame:
    """Apply the filter of that name; an unknown name is an error."""
    if name not in FILTERS:
        raise ValueError(f"unknown filter {name}, known: {', '.join(FILTERS)}")
    return FILTERS[name](events, settings or {})


def extract_rows(events: DataFrame, rows: str = "rows") -> DataFrame:
    """One row for each changed row of an event (array of before/after maps), numbered from 0 by row_idx."""
    return events.select(*[c for c in events.columns if c != rows], F.posexplode(rows).alias("row_idx", "_row")).select(
        "*", F.col("_row.before").alias("before"), F.col("_row.after").alias("after")
    ).drop("_row")


def one_table(events: DataFrame, event: Sequence[str], tbl: str = "tbl") -> DataFrame:
    """The rows of events, each of which has to be of one table; an event with rows of several is an error."""
    by_event = Window.partitionBy(*event)
    several = F.min(tbl).over(by_event) != F.max(tbl).over(by_event)
    return events.withColumn(tbl, F.when(several, F.raise_error(F.lit("an event with rows of several tables")).cast("string")).otherwise(F.col(tbl)))


def entry_of(values: Column, name: str) -> Column:
    """The value of a name in a map, whatever the case of its letters; null where there is none."""
    return F.get(F.map_values(F.map_filter(values, lambda k, v: F.lower(k) == name.lower())), F.lit(0))


def named_values(values: Column, columns: Column) -> Column:
    """Positional values by their columns' names; a width that differs is an error (full row images are needed)."""
    checked = F.when(F.size(values) == F.size(columns), values).otherwise(F.raise_error(F.lit("row image and schema differ in width")).cast("array<string>"))
    return F.map_from_arrays(columns, checked)


def changed_columns(before: Column, after: Column) -> Column:
    """Of the after image, the entries whose text differs from the before image (NULL counts as the word)."""
    return F.map_filter(after, lambda k, v: value_text(F.try_element_at(before, k)) != value_text(v))


def columns_projection(columns: Column, keep: Sequence[str] = ("name", "column_type")) -> Column:
    """Column metadata reduced to the fields that a message carries."""
    return F.transform(columns, lambda c: F.struct(*[c[k].alias(k) for k in keep]))
