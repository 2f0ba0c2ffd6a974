"""Messages and schema documents for sinks; writers by name."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Prefixes of column types, in the order of testing, and the Avro type of each.
AVRO_TYPES = (
    ("boolean", "int"),
    ("tinyint", "int"),
    ("smallint", "int"),
    ("mediumint", "int"),
    ("int", "int"),
    ("bigint", "long"),
    ("float", "float"),
    ("real", "float"),
    ("double", "double"),
)
META_FIELDS = (("__timestamp", "long"), ("__is_deleted", "int"), ("__binlog_position", "long"))


def avro_type(column_type: str) -> str:
    kind = column_type.lower()
    found = next((t for prefix, t in AVRO_TYPES if kind.startswith(prefix)), "string")
    if "unsigned" in kind:
        found = {"int": "long" if kind.startswith("int") else "int", "long": "string"}.get(found, found)
    return found


def avro_schema(db: str, table: str, columns: Sequence[tuple[str, str, str | None]], meta: bool = False) -> str:
    """Schema JSON of (name, column type, default) columns: unions with null, the default's type first."""
    fields = []
    for name, column_type, default in [*columns, *((n, {"long": "bigint", "int": "int"}[t], None) for n, t in (META_FIELDS if meta else ()))]:
        kind = avro_type(column_type)
        if default is None or default.upper() == "NULL":
            fields.append({"name": name, "type": ["null", kind], "default": None})
        else:
            value = int(default) if kind in ("int", "long") else float(default) if kind in ("float", "double") else default
            fields.append({"name": name, "type": [kind, "null"], "default": value})
    return json.dumps({"type": "record", "name": table, "namespace": db, "fields": fields}, separators=(",", ":"))


def schemas_compatible(old: str, new: str) -> bool:
    """Readers of the new schema can read what the old one wrote: same types for kept fields, defaults for new ones."""
    before = {f["name"]: f for f in json.loads(old)["fields"]}
    widens = {("int", "long"), ("int", "float"), ("int", "double"), ("long", "float"), ("long", "double"), ("float", "double")}
    for f in json.loads(new)["fields"]:
        kind = next(t for t in f["type"] if t != "null")
        if f["name"] not in before:
            if "default" not in f:
                return False
            continue
        was = next(t for t in before[f["name"]]["type"] if t != "null")
        if was != kind and (was, kind) not in widens:
            return False
    return True


def _columns_of(text: str) -> list[tuple[str, str, None]]:
    out, depth, start = [], 0, 0
    for i, c in enumerate(text + ","):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            name, _, kind = text[start:i].strip().partition(" ")
            out.append((name, kind, None))
            start = i + 1
    return out


def ddl_records(history: DataFrame, db: str, table: str) -> DataFrame:
    """(query, schema, isCompatibleSchemaChange) of schema changes (query, before, after as ``name type, ...`` text).

    A new table is compatible; a dropped one is not, and has no schema. There are as many rows as DDL statements.
    """

    def run(batches):
        for batch in batches:
            out = []
            for query, before, after in zip(batch["query"], batch["before"], batch["after"]):
                new = avro_schema(db, table, _columns_of(after), meta=True) if after else None
                old = avro_schema(db, table, _columns_of(before), meta=True) if before else None
                out.append((query, new, new is not None and (old is None or schemas_compatible(old, new))))
            yield pd.DataFrame(out, columns=["query", "schema", "isCompatibleSchemaChange"])

    return history.select("query", "before", "after").mapInPandas(run, "query string, schema string, isCompatibleSchemaChange boolean")


class SchemaRegistry:
    """Ids of schemas by subject; registering an equal schema again gives its id."""

    def __init__(self, capacity: int = 1000):
        self._ids: dict[tuple[str, str], int] = {}
        self._capacity = capacity

    def register(self, subject: str, schema: str) -> int:
        key = (subject, schema)
        if key not in self._ids:
            if len(self._ids) >= self._capacity:
                raise ValueError("too many schemas")
            self._ids[key] = len(set(self._ids.values())) + 1
        return self._ids[key]


def schema_key(op: Column, db: Column, tbl: Column, prefix: str = "bigdata") -> Column:
    """Subject of an event's schema."""
    return F.when(op == "QUERY", f"{prefix}-ddl-schema").otherwise(F.concat_ws("-", F.lit(prefix), db, tbl))


def header_text(db: Column, tbl: Column, ts_ms: Column) -> Column:
    return F.concat_ws("-", db, tbl, ts_ms.cast("string"))


_NULLS = {"ignoreNullFields": "false"}


def _column(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def event_header(changes: DataFrame) -> Column:
    """The header of an event: names, time, checkpoint, kind and transaction. What the changes do not carry is null."""
    of = lambda name, kind: _column(changes, name, kind)
    ts, gtid = of("commit_ts_ms", "long"), of("gtid", "string")
    place = F.struct(of("file", "string").alias("filename"), of("position", "long").alias("position"))
    checkpoint = F.struct(ts.alias("timestamp"), of("server_id", "long").alias("serverId"), of("gtid_set", "string").alias("gtidSet"), gtid.alias("gtid"), place.alias("binlog"))
    transaction = F.struct(ts.alias("commitTimestamp"), of("txn_id", "string").alias("identifier"), of("xid", "long").alias("xxid"), of("seq", "long").alias("transactionSequenceNumber"))
    return F.struct(
        of("db", "string").alias("databaseName"), of("tbl", "string").alias("tableName"), ts.alias("timestamp"), checkpoint.alias("checkpoint"), of("op", "string").alias("eventType"),
        F.when(of("txn_id", "string").isNotNull(), transaction).alias("eventTransaction"),
    )


def event_json(changes: DataFrame, pretty: bool = False) -> Column:
    """An event's header and data in one document."""
    data = F.struct(F.col("op").alias("eventType"), F.col("before"), F.col("after"))
    return F.to_json(F.struct(event_header(changes).alias("header"), data.alias("data")), _NULLS | ({"pretty": "true"} if pretty else {}))


def message_key(changes: DataFrame) -> Column:
    """A typed key: table, database, kind and time."""
    return F.struct(F.col("tbl").alias("tableName"), _column(changes, "db", "string").alias("databaseName"), F.col("op").alias("eventType"), F.col("commit_ts_ms").alias("timestamp"))


def opaque_message(events: DataFrame, data: str = "data") -> DataFrame:
    """Events whose bytes are passed on as they are: no key, the bytes as value."""
    return events.select(F.lit(None).cast("string").alias("key"), F.col(data).cast("binary").alias("value"))


def row_values(changes: DataFrame) -> Column:
    """JSON of a row's values: those written, of an update before (b) and after (a) of each column, of a delete the last."""
    both = F.transform_values("after", lambda k, v: F.struct(F.try_element_at("before", k).alias("b"), v.alias("a")))
    return F.coalesce(F.when(F.col("op") == "UPDATE", F.to_json(both, _NULLS)).otherwise(F.to_json(F.coalesce("after", "before"), _NULLS)), F.lit("null"))


def columns_json(columns: Sequence[tuple], fields: Sequence[str] = ("name", "columnType")) -> str:
    """Column metadata (name, type, key, default) as JSON, with only the named fields."""
    every = ("name", "columnType", "key", "valueDefault")
    return json.dumps([{f: v for f, v in zip(every, c) if f in fields} for c in columns], separators=(",", ":"))


def json_message(changes: DataFrame, partition: Column, columns: Sequence[tuple] = (), primary_key: Sequence[str] = (), fields: Sequence[str] = ("name", "columnType"), event: Sequence[str] | None = None) -> DataFrame:
    """(key, value, partition, timestamp) and the event's position: header and data of each event as JSON.

    The data are the table's metadata and the rows: transaction, commit time, microsecond and values of each. Every
    change is an event with one row; ``event`` names the columns that tell events with several rows apart, whose rows
    are then gathered in the order of row_idx.
    """
    head = F.struct(F.struct(_column(changes, "db", "string").alias("db"), F.col("tbl").alias("name")).alias("eventTable"), F.col("op").alias("eventType"))
    known = json.dumps(list(primary_key), separators=(",", ":"))
    metadata = F.concat(F.expr("substring(_head, 1, length(_head) - 1)"), F.lit(f',"columns":{columns_json(columns, fields)},"primaryKeyColumns":{known}}}'))
    row = F.struct(F.col("txn_id").alias("transactionUUID"), F.col("xid").alias("transactionXid"), F.col("commit_ts_ms").alias("commitTimestamp"), F.col("ts_us").alias("rowMicrosecondTimestamp"))
    found = changes.select(
        "*", F.to_json(event_header(changes), _NULLS).alias("key"), F.to_json(head, _NULLS).alias("_head"), F.to_json(row, _NULLS).alias("_row"), row_values(changes).alias("_values"), partition.alias("partition")
    ).withColumn("_row", F.concat(F.expr("substring(_row, 1, length(_row) - 1)"), F.lit(',"values":'), "_values", F.lit("}")))
    if event is not None:
        rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "_row"))), lambda x: x["_row"]), ",").alias("_row")
        found = found.groupBy(*event).agg(*[F.min_by(c, "row_idx").alias(c) for c in ("position", "key", "_head", "partition", "commit_ts_ms") if c not in event], rows)
    value = F.concat(F.lit('{"metadata":'), metadata, F.lit(',"rows":['), "_row", F.lit("]}"))
    return found.select("position", "key", value.alias("value"), "partition", F.col("commit_ts_ms").alias("timestamp"))


def avro_rows(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row records: the newest image of each column and the meta fields."""
    image = F.coalesce("after", "before")
    return changes.select(
        *[F.try_element_at(image, F.lit(c)).alias(c) for c in columns], F.col("commit_ts_ms").alias("__timestamp"), (F.col("op") == "DELETE").cast("int").alias("__is_deleted"), F.col("position").alias("__binlog_position")
    )


def avro_bytes(record: dict, schema: dict) -> bytes:
    """Avro's binary form of a record whose fields are unions of null and one of int, long, float, double and string."""
    import struct

    def number(n: int) -> bytes:
        n = (n << 1) ^ (n >> 63)  # small numbers of either sign are short
        out = bytearray()
        while n & ~0x7F:
            out.append(n & 0x7F | 0x80)
            n >>= 7
        return bytes([*out, n])

    def one(kind: str, value) -> bytes:
        if kind in ("int", "long"):
            return number(int(value))
        if kind in ("float", "double"):
            return struct.pack("<f" if kind == "float" else "<d", float(value))
        data = str(value).encode()
        return number(len(data)) + data

    out = b""
    for f in schema["fields"]:
        value = record[f["name"]]
        branch = f["type"].index("null") if value is None else next(i for i, t in enumerate(f["type"]) if t != "null")
        out += number(branch) + (b"" if value is None else one(f["type"][branch], value))
    return out


def avro_column(record: Column, schema: str) -> Column:
    """Avro's binary form of a struct: by Spark's Avro module where it is installed, else by an Arrow-batched function."""
    from pyspark.sql.functions import pandas_udf

    spark = SparkSession.active()
    if spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader().getResource("org/apache/spark/sql/avro/CatalystDataToAvro.class") is not None:
        from pyspark.sql.avro.functions import to_avro

        return to_avro(record, schema)
    parsed = json.loads(schema)

    @pandas_udf("binary")
    def encode(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([avro_bytes({k: None if pd.isna(v) else v for k, v in r.items()}, parsed) for r in rows.to_dict("records")], dtype=object)

    return encode(record)


_SPARK_TYPES = {"int": "int", "long": "bigint", "float": "float", "double": "double", "string": "string"}


def avro_message(changes: DataFrame, partition: Column, db: str, table: str, columns: Sequence[tuple[str, str, str | None]], registry: SchemaRegistry, prefix: str = "bigdata") -> DataFrame:
    """(position, key, value, partition, headers): one record for each row; the value is a zero byte, the schema's id in
    four bytes and the record in Avro's binary form; the header ``meta`` names table and time.

    The schema is registered under the table's subject. All changes are of one table.
    """
    text = avro_schema(db, table, columns, meta=True)
    wire = b"\0" + registry.register(f"{prefix}-{db}-{table}-value", text).to_bytes(4, "big")
    image = F.coalesce("after", "before")
    own = [F.try_element_at(image, F.lit(n)).cast(_SPARK_TYPES[avro_type(t)]).alias(n) for n, t, _ in columns]
    meta = [F.col("commit_ts_ms").cast("long").alias("__timestamp"), (F.col("op") == "DELETE").cast("int").alias("__is_deleted"), F.col("position").cast("long").alias("__binlog_position")]
    header = F.array(F.struct(F.lit("meta").alias("key"), F.encode(header_text(F.lit(db), F.lit(table), F.col("commit_ts_ms")), "UTF-8").alias("value")))
    value = F.concat(F.lit(wire), avro_column(F.struct(*own, *meta), text))
    return changes.select("position", F.to_json(event_header(changes), _NULLS).alias("key"), value.alias("value"), partition.alias("partition"), header.alias("headers"))


def raw_event_key(ts_ms: Column) -> Column:
    """The time's digits reversed: spreads events of neighbouring times."""
    return F.reverse(ts_ms.cast("string"))


#: Formats of a versioned store, by name.
STORAGES = ("parquet", "orc", "json")


def target_name(tbl: Column, namespace: str = "") -> Column:
    """A table's name in the store: lower case, after its namespace."""
    return F.lower(F.concat(F.lit(f"{namespace}:" if namespace else ""), tbl))


def write_cells(cells: DataFrame, path: str, mode: str = "append", compression: str = "snappy", storage: str = "parquet", namespace: str = "") -> None:
    """Cells by table, rows of a key together and in order. Folders of tables are made as they are first seen."""
    if storage not in STORAGES:
        raise ValueError(f"unknown storage {storage}, known: {', '.join(STORAGES)}")
    out = cells.withColumn("tbl", target_name(F.col("tbl"), namespace))
    out = out.repartition("tbl", "row_key").sortWithinPartitions("tbl", "row_key", "qualifier", "ts_us")
    writer = out.write.mode(mode).format(storage).partitionBy("tbl")
    (writer if storage == "json" else writer.option("compression", compression)).save(path)


def write_messages(messages: DataFrame, path: str | None = None, **options: str) -> None:
    """Messages to a broker's topic, by Spark's Kafka module (options: topic, kafka.bootstrap.servers, ...)."""
    wanted = [c for c in ("key", "value", "partition", "headers", "topic") if c in messages.columns]
    writer = messages.select(*wanted).write.format("kafka")
    for k, v in options.items():
        writer = writer.option(k, v)
    try:
        writer.save()
    except Exception as e:
        if "failed to find" in str(e).lower():
            raise RuntimeError("the KAFKA sink needs Spark's module spark-sql-kafka on the class path") from e
        raise


def dry_run(cells: DataFrame, path: str | None = None, n: int = 20) -> None:
    """Show what would be written: no write."""
    cells.groupBy("tbl", "row_key", "ts_us").agg(F.max(F.when(F.col("qualifier") == "row_status", F.col("value"))).alias("status"), F.count("*").alias("cells")).show(n, truncate=False)


#: Sinks by name; each takes (rows, path or None, options) and writes.
SINKS = {
    "CELLS": write_cells,
    "KAFKA": write_messages,
    "CONSOLE": lambda df, path=None, **options: df.show(truncate=False),
    "COUNT": lambda df, path=None, **options: df.groupBy("op").count().show(),
    "DRY_RUN": dry_run,
    "JSON": lambda df, path, **options: df.write.mode("append").json(path),
}


def write(rows: DataFrame, sink: str = "CELLS", path: str | None = None, **options) -> None:
    """Write by the sink of that name; an unknown name is an error."""
    if sink.upper() not in SINKS:
        raise ValueError(f"unknown sink {sink}, known: {', '.join(SINKS)}")
    SINKS[sink.upper()](rows, path, **options)
