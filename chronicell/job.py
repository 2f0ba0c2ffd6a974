"""A replication from raw log to written cells, by settings: ``python -m chronicell.job --config source.path=... ...``

| Setting (default) | What |
|---|---|
| source.format (change_log), source.path | binary log files, or ``json`` for recorded lines |
| source.schema | the schema that is replicated |
| start.file, start.position, start.gtid_set | what is left out, see ``start_filter`` |
| checkpoint.path | where the last checkpoint is read from and written to |
| tables.include, tables.exclude, tables.exclude_pattern | which tables |
| filter.type (IDENTITY), filter.pattern | event filter by name |
| transactions.enabled (true), gtid.type (REAL) | assembly of transactions |
| payload.table, namespace | keys of the payload table, prefix of target tables |
| sink.type (CELLS), sink.path, sink.storage (parquet) | writer by name |
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicell.config import from_arguments
from chronicell.operators import augment, ddl, txn
from chronicell.operators.cells import to_cells
from chronicell.sources import binlog, checkpoints, payloads
from chronicell.sources.datasource import ChangeLogSource
from chronicell.sources.logfile import typed_images


@dataclass(frozen=True)
class SchemaVersion:
    """A table's columns from one place of the log on."""

    tbl: str
    place: tuple[str, int]
    columns: tuple[ddl.ColumnInfo, ...] | None


def schema_versions(log: DataFrame, start: ddl.SchemaState | None = None) -> list[SchemaVersion]:
    """What the log's statements make of the tables that ``start`` knows, in log order; the driver gets the statements
    that change schemas, which are few by nature."""
    state = start or ddl.SchemaState()
    out = [SchemaVersion(t, ("", -1), c) for t, c in state.tables.items()]
    found = log.filter("event_type = 'QUERY'").select("file", "position", "db", "sql").filter(ddl.classify(F.col("sql")) == "DDL_TABLE")
    for r in sorted(found.collect(), key=lambda r: (r.file, r.position)):
        out += [SchemaVersion(t, (r.file, r.position), after) for t, _, after in state.apply(r.sql, r.db or None)]
    return out


def typed_changes(rows: DataFrame, versions: Sequence[SchemaVersion]) -> DataFrame:
    """Row events (db, tbl, op, rows with positional images) as changes with named and decoded images and their key.

    An event is read by the columns that its table had at its place in the log: one branch of a union for each version,
    each a filter on table and place. Rows of tables that no statement has described are an error.
    """
    by_table: dict[str, list[SchemaVersion]] = {}
    for v in versions:
        by_table.setdefault(v.tbl, []).append(v)
    name, place = F.concat_ws(".", "db", "tbl"), F.struct("file", "position")
    at = lambda p: F.struct(F.lit(p[0]).alias("file"), F.lit(p[1]).cast("long").alias("position"))
    parts, known = [], []
    for tbl, changes in by_table.items():
        for v, after in zip(changes, [*changes[1:], None]):
            here = (name == tbl) & (place > at(v.place)) & (F.lit(True) if after is None else place <= at(after.place))
            if v.columns:
                pk = [F.coalesce(F.try_element_at("after", F.lit(c.name)), F.try_element_at("before", F.lit(c.name))) for c in v.columns if c.key == "PRI"]
                images = typed_images(rows.filter(here), [(c.name, c.column_type, c.collation) for c in v.columns])
                parts.append(images.withColumn("pk", F.array(*pk) if pk else F.array().cast("array<string>")))
                known.append(here)
    unknown = rows.filter(~reduce(lambda a, b: a | b, known, F.lit(False)))
    missing = F.raise_error(F.concat(F.lit("no schema is known for rows of "), name)).cast("array<string>")
    parts.append(augment.extract_rows(unknown).withColumn("pk", missing))
    return reduce(DataFrame.unionByName, parts)


def changes_of(log: DataFrame, settings: dict, versions: Sequence[SchemaVersion]) -> DataFrame:
    """The changes of a raw log, stamped with their commits and their microseconds."""
    kind = (
        F.when(F.col("event_type") == "XID", "XID")
        .when(F.col("rows").isNotNull(), "ROW")
        .when((F.col("event_type") == "QUERY") & ddl.classify(F.col("sql")).isin("BEGIN", "COMMIT"), ddl.classify(F.col("sql")))
    )
    known = augment.current_gtid(log.withColumn("pseudo_gtid", F.lit(None).cast("string")), settings.get("gtid.type", "REAL"))
    events = known.withColumns({"kind": kind, "gtid": F.col("current_gtid"), "op": augment.operation(F.col("event_type"))}).filter("kind IS NOT NULL")
    whole = txn.stamp_commits(txn.assemble(events, transactions=settings.get("transactions.enabled", True)))
    listed = lambda key: [x for x in (settings.get(key) or "").split(",") if x] if isinstance(settings.get(key), str | None) else list(settings[key])
    allowed = augment.table_allowed(F.col("tbl"), listed("tables.include"), listed("tables.exclude"), settings.get("tables.exclude_pattern"))
    rows = whole.filter("kind = 'ROW'").filter(allowed)
    if settings.get("source.schema"):
        rows = rows.filter(augment.in_schema(F.col("db"), settings["source.schema"]))
    typed = augment.event_filter(typed_changes(rows, versions), settings.get("filter.type", "IDENTITY"), {"pattern": settings.get("filter.pattern")})
    ts = F.coalesce("commit_ts_ms", "ts_ms")
    stamped = typed.withColumns(
        {
            "commit_ts_ms": ts, "base_us": txn.commit_micros(ts, F.coalesce("seq", F.lit(0))), "txn_id": F.coalesce("commit_gtid", "gtid"), "xid": F.lit(0).cast("long"),
            "_txn": F.coalesce("txn_no", -1 - F.col("position")),
        }
    )
    return txn.row_micros(stamped, ["server", "file", "_txn"], ["tbl", "pk"], ["position", "row_idx"]).drop("_txn")


def read_source(spark: SparkSession, settings: dict) -> DataFrame:
    start = {k.removeprefix("start."): v for k, v in settings.items() if k.startswith("start.")} or (checkpoints.load(spark, settings["checkpoint.path"]) if settings.get("checkpoint.path") else None)
    if settings.get("source.format", "change_log") == "change_log":
        spark.dataSource.register(ChangeLogSource)
        events = spark.read.format("change_log").load(settings["source.path"])
    else:
        events = binlog.read_log(spark, settings["source.path"])
    return binlog.start_filter(events, start)


def run(spark: SparkSession, settings: dict, start: ddl.SchemaState | None = None) -> DataFrame:
    """Replicate what the source holds: write cells (or messages, for the KAFKA sink) and the checkpoint; returns the changes.

    ``start`` is the schema at the log's beginning, from ``ddl.bootstrap`` or an earlier run. A checkpoint by position
    leaves out statements too, so runs that go on from one need it.
    """
    log = read_source(spark, settings)
    changes = changes_of(log, settings, schema_versions(log, start))
    sink, path = settings.get("sink.type", "CELLS").upper(), settings.get("sink.path")
    if sink == "KAFKA":
        options = {k.removeprefix("kafka."): str(v) for k, v in settings.items() if k.startswith("kafka.")}
        payloads.write(payloads.json_message(changes, F.lit(None).cast("int"), event=["server", "file", "position"]), sink, path, **options)
    elif sink in ("COUNT", "CONSOLE"):
        payloads.write(changes, sink, path)
    else:
        cells = txn.last_at_same_micros(to_cells(changes, settings.get("payload.table")), ["tbl", "row_key", "qualifier", "ts_us"], ["file", "position", "row_idx"])
        options = {"storage": settings.get("sink.storage", "parquet"), "namespace": settings.get("namespace", "")} if sink == "CELLS" else {}
        payloads.write(cells, sink, path, **options)
    if settings.get("checkpoint.path") and (last := checkpoints.last_of(log)):
        checkpoints.save(spark, settings["checkpoint.path"], last)
    return changes


if __name__ == "__main__":
    from chronicell.session import local_session

    given = from_arguments(sys.argv[1:])
    run(SparkSession.getActiveSession() or local_session(given.get("cores", "*")), given)
