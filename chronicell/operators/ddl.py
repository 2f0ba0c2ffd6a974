"""Statements: classification, keep rules, a small DDL interpreter and the schema history that it builds."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The statement patterns, in the order in which they are tried (the first that is found wins).
_COMMENT = r"^(/\*.*?\*/\s*)?"
PATTERNS = (
    ("BEGIN", _COMMENT + r"(begin)"),
    ("COMMIT", _COMMENT + r"(commit)"),
    ("DDL_DEFINER", _COMMENT + r"(alter|drop|create|rename|truncate|modify)\s+(definer)\s*="),
    ("DDL_TABLE", _COMMENT + r"(alter|drop|create|rename|modify)\s+(table)\s+(?:if (?:not )?exists\s+)?(\S+)"),
    ("DDL_TEMPORARY_TABLE", _COMMENT + r"(alter|drop|create|rename|truncate|modify)\s+(temporary)\s+(table)\s+(\S+)"),
    ("DDL_VIEW", _COMMENT + r"(alter|drop|create|rename|truncate|modify)\s+(view)\s+(\S+)"),
    ("DDL_ANALYZE", _COMMENT + r"(analyze)\s+(table)\s+(\S+)"),
)
_RENAME = r"(`?[^\s`.,]+`?\.)?`?[^\s`.,]+`?\s+to\s+(`?[^\s`.,]+`?\.)?`?[^\s`.,;]+`?"


def classify(sql: Column) -> Column:
    """Kind of a statement, by the first pattern found; UNKNOWN for none (TRUNCATE TABLE among them)."""
    out = F.lit("UNKNOWN")
    for kind, pattern in reversed(PATTERNS):
        out = F.when(sql.rlike(f"(?is){pattern}"), kind).otherwise(out)
    return F.when(sql.isNotNull(), out)


def ddl_operation(sql: Column) -> Column:
    """ALTER, DROP, CREATE, RENAME, MODIFY, TRUNCATE or ANALYZE; null for other statements."""
    found = F.upper(F.regexp_extract(sql, r"(?is)^(?:/\*.*?\*/\s*)?(alter|drop|create|rename|truncate|modify|analyze)\s", 1))
    return F.when(found != "", found)


def ddl_table(sql: Column) -> Column:
    """The table that a DDL_TABLE statement names, as written."""
    return F.regexp_extract(sql, f"(?is){dict(PATTERNS)['DDL_TABLE']}", 4)


def rename_stays_inside(sql: Column, schema: str) -> Column:
    """False when any pair of a rename names a schema other than ``schema``; other statements: true."""
    bare = lambda side: F.transform(F.regexp_extract_all(sql, F.lit(f"(?i){_RENAME}"), F.lit(side)), lambda s: F.regexp_replace(s, "[`.]", ""))
    both = F.concat(bare(1), bare(2))
    return F.forall(both, lambda s: (s == "") | (s == F.lit(schema)))


def ddl_kept(db: Column, sql: Column, schema: str, allowed: Column) -> Column:
    """A DDL_TABLE statement is kept if it runs in the schema, names it or no schema, and its table is allowed."""
    named = F.replace(ddl_table(sql), F.lit("`"), F.lit(""))
    prefix = F.when(named.contains("."), F.substring_index(named, ".", 1))
    return (db == schema) & (prefix.isNull() | (prefix == schema)) & rename_stays_inside(sql, schema) & allowed


@dataclass(frozen=True)
class ColumnInfo:
    name: str
    column_type: str
    nullable: bool = True
    key: str = ""
    default: str | None = None
    collation: str = "utf8"


@dataclass
class SchemaState:
    """Tables as statements leave them; ``apply`` returns (table, before, after) of each change.

    A table is known as ``database.table`` where the log says which database a statement ran in (``db``), so that namesakes
    are kept apart, else by its name alone.
    Knows CREATE TABLE (columns, PRIMARY KEY, LIKE, IF NOT EXISTS), ALTER TABLE (ADD of one or more columns, DROP, MODIFY,
    CHANGE, with FIRST and AFTER, ALTER ... DEFAULT, RENAME COLUMN, RENAME, ADD and DROP PRIMARY KEY), DROP TABLE (several,
    IF EXISTS) and RENAME TABLE (several pairs, in order). A log may begin after its tables were made: what a statement
    says of a table or column that is not known is taken as it stands, and what it cannot say stays unknown.
    """

    tables: dict[str, tuple[ColumnInfo, ...]] = field(default_factory=dict)

    def apply(self, sql: str, db: str | None = None) -> list[tuple[str, tuple | None, tuple | None]]:
        sql = re.sub(r"^/\*.*?\*/\s*", "", sql.strip(), flags=re.S).rstrip("; \n\t")
        named = lambda text: _table(text, db)
        if m := re.match(r"(?is)create\s+table\s+(if\s+not\s+exists\s+)?(\S+?)\s+like\s+(\S+)$", sql):
            return self._set(named(m[2]), self.tables.get(named(m[3]), ()), keep=bool(m[1]))
        if m := re.match(r"(?is)create\s+table\s+(if\s+not\s+exists\s+)?([^\s(]+)\s*\((.*)\)", sql):
            charset = re.search(r"(?i)(?:charset|character\s+set|collate)\s*=?\s*(\w+)", sql[m.end() :])
            return self._set(named(m[2]), _columns(m[3], charset[1].lower() if charset else "utf8"), keep=bool(m[1]))
        if m := re.match(r"(?is)drop\s+table\s+(?:if\s+exists\s+)?(.*)", sql):
            return [x for t in m[1].split(",") for x in self._set(named(t.split()[0]), None)]
        if m := re.match(r"(?is)rename\s+table\s+(.*)", sql):
            pairs = [re.split(r"(?i)\s+to\s+", pair.strip()) for pair in m[1].split(",")]
            return [x for old, new in pairs for x in self._move(named(old), named(new))]
        if m := re.match(r"(?is)alter\s+table\s+(\S+)\s+(.*)", sql):
            return self._alter(named(m[1]), _split(m[2]), named)
        return []

    def load(self, columns: Sequence[tuple[str, int, str, str, bool, str]]) -> SchemaState:
        """Take tables as a catalog lists them: rows (table, ordinal, name, type, nullable, key)."""
        for table in {c[0] for c in columns}:
            own = sorted((c for c in columns if c[0] == table), key=lambda c: c[1])
            self.tables[table] = tuple(ColumnInfo(name, kind, nullable, key) for _, _, name, kind, nullable, key in own)
        return self

    def names(self, db: str | None = None) -> list[str]:
        """The tables, of one database or all."""
        return sorted(t for t in self.tables if db is None or t.startswith(f"{db}."))

    def columns(self, table: str) -> tuple[ColumnInfo, ...]:
        """The columns of a table; a table that is not known is an error, before any of its rows is read."""
        if table not in self.tables:
            raise ValueError(f"no schema is known for {table}")
        return self.tables[table]

    def copy(self) -> SchemaState:
        return SchemaState(dict(self.tables))

    def _alter(self, table: str, parts: list[str], named) -> list:
        columns, target = list(self.tables.get(table, ())), table
        for part in parts:
            if m := re.match(r"(?is)rename\s+(?:to\s+|as\s+)?(?!column\b|index\b|key\b)(\S+)$", part):
                target = named(m[1])
            else:
                columns = _altered(columns, part)
        changed = self._set(table, tuple(columns)) if target == table or tuple(columns) != self.tables.get(table, ()) else []
        return changed + (self._move(table, target) if target != table else [])

    def _set(self, table: str, columns: tuple | None, keep: bool = False) -> list:
        before = self.tables.get(table)
        if keep and before is not None:
            return []
        if columns is None:
            self.tables.pop(table, None)
        else:
            self.tables[table] = columns
        return [(table, before, columns)]

    def _move(self, old: str, new: str) -> list:
        columns = self.tables.get(old, ())
        return [*self._set(old, None), *self._set(new, columns)]


def _name(text: str) -> str:
    return text.replace("`", "").split(".")[-1]


def _table(text: str, db: str | None) -> str:
    if not db:
        return _name(text)
    text = text.replace("`", "")
    return text if "." in text else f"{db}.{text}"


def _split(text: str) -> list[str]:
    """Parts between commas that are outside parentheses and quotes."""
    parts, depth, quote, start = [], 0, "", 0
    for i, c in enumerate(text):
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "," and not depth:
            parts.append(text[start:i].strip())
            start = i + 1
    return [*parts, text[start:].strip()]


def _column(text: str, collation: str = "utf8") -> ColumnInfo:
    m = re.match(r"(?is)`?([^\s`]+)`?\s+([a-z]+(?:\s*\(.*?\))?(?:\s+unsigned)?)", text)
    if m is None:
        raise ValueError(f"no column definition: {text}")
    rest = text[m.end() :]
    default = re.search(r"(?i)default\s+('(?:[^']|'')*'|[^\s,]+)", rest)
    value = default[1].strip("'") if default and default[1].upper() != "NULL" else None
    primary = bool(re.search(r"(?i)primary\s+key", rest))
    # Lower case, but for what is quoted: members of enum and set types keep theirs.
    kind = re.sub(r"'(?:[^']|'')*'|[^']+", lambda x: x[0] if x[0].startswith("'") else x[0].lower(), m[2])
    charset = re.search(r"(?i)(?:charset|character\s+set|collate)\s+(\w+)", rest)
    return ColumnInfo(m[1], kind, not (primary or re.search(r"(?i)not\s+null", rest)), "PRI" if primary else "", value, charset[1].lower() if charset else collation)


_KEYS = r"(?i)(unique|key|index|constraint|foreign|fulltext|spatial|check|partition)\b"
_PRIMARY = r"(?is)(?:constraint\s+\S+\s+)?primary\s+key\s*(?:using\s+\S+\s*)?\((.*)\)"


def _with_primary(columns: Sequence[ColumnInfo], names: str) -> list[ColumnInfo]:
    primary = [re.sub(r"\(.*", "", _name(c.strip())) for c in names.split(",")]
    return [replace(c, key="PRI", nullable=False) if c.name in primary else c for c in columns]


def _columns(body: str, collation: str = "utf8") -> tuple[ColumnInfo, ...]:
    columns, primary = [], ""
    for part in _split(body):
        if m := re.match(_PRIMARY, part):
            primary = m[1]
        elif not re.match(_KEYS, part):
            columns.append(_column(part, collation))
    return tuple(_with_primary(columns, primary))


def _placed(columns: list[ColumnInfo], new: ColumnInfo, at: int, where: re.Match | None) -> list[ColumnInfo]:
    """``new`` at FIRST or AFTER a column, else at ``at``; after a column that is not known, at the end."""
    if where:
        names = [c.name for c in columns]
        at = 0 if where[1].lower() == "first" else names.index(where[2]) + 1 if where[2] in names else len(columns)
    return columns[:at] + [new] + columns[at:]


def _altered(columns: list[ColumnInfo], part: str) -> list[ColumnInfo]:
    if m := re.match(r"(?is)rename\s+column\s+`?([^\s`]+)`?\s+to\s+`?([^\s`]+)`?", part):
        return [replace(c, name=m[2]) if c.name == m[1] else c for c in columns]
    if m := re.match(r"(?is)alter\s+(?:column\s+)?`?([^\s`]+)`?\s+(?:set\s+default\s+('(?:[^']|'')*'|\S+)|drop\s+default)", part):
        value = None if m[2] is None or m[2].upper() == "NULL" else m[2].strip("'")
        return [replace(c, default=value) if c.name == m[1] else c for c in columns]
    if re.match(r"(?is)drop\s+primary\s+key", part):
        return [replace(c, key="") for c in columns]
    if m := re.match(r"(?is)add\s+" + _PRIMARY.removeprefix("(?is)"), part):
        return _with_primary(columns, m[1])
    m = re.match(r"(?is)(add|drop|modify|change)\s+(?:column\s+)?(.*)", part)
    if not m or re.match(_KEYS, m[2]):
        return columns
    what, rest = m[1].lower(), re.sub(r"(?i)^if\s+(not\s+)?exists\s+", "", m[2])
    if what == "drop":
        return [c for c in columns if c.name != _name(rest.split()[0])]
    if what == "add" and rest.startswith("("):
        return columns + list(_columns(rest[1 : rest.rindex(")")]))
    where = re.search(r"(?i)\s+(first|after\s+`?([^\s`]+)`?)\s*$", rest)
    body = rest[: where.start()] if where else rest
    at = len(columns)
    if what in ("modify", "change"):
        old = _name(body.split()[0])
        at = next((i for i, c in enumerate(columns) if c.name == old), at)
        was = columns[at : at + 1]
        columns = columns[:at] + columns[at + 1 :]
        new = _column(body.split(None, 1)[1] if what == "change" else body)
        return _placed(columns, replace(new, key="PRI", nullable=False) if was and was[0].key == "PRI" else new, at, where)
    return _placed(columns, _column(body), at, where)


def create_text(table: str, columns: Sequence[ColumnInfo]) -> str:
    """A CREATE TABLE statement that makes the table as it is known."""
    quoted = lambda c: "" if c.default is None else " DEFAULT '" + c.default.replace("'", "''") + "'"
    lines = [f"  `{c.name}` {c.column_type}{'' if c.nullable else ' NOT NULL'}{quoted(c)}" for c in columns]
    primary = ", ".join(f"`{c.name}`" for c in columns if c.key == "PRI")
    return f"CREATE TABLE `{_name(table)}` (\n" + ",\n".join([*lines, *([f"  PRIMARY KEY ({primary})"] if primary else [])]) + "\n)"


def columns_text(columns: Sequence[ColumnInfo] | None) -> str | None:
    return None if columns is None else ", ".join(f"{c.name} {c.column_type}" for c in columns)


def _interpreted(statements: DataFrame, rows_of, schema: str) -> DataFrame:
    """What ``rows_of`` (state before, state after, statement, its changes) gives for each statement, in log order.

    Statements depend on all earlier ones, so one task interprets them: the number of DDL statements in a log is small by
    nature and does not grow with its rows. The rest of the engine joins the result by position.
    """
    wanted = {"position": "bigint", "ts_ms": "bigint", "db": "string", "sql": "string"}
    own = statements.select(*[F.col(c).cast(t) if c in statements.columns else F.lit(None).cast(t).alias(c) for c, t in wanted.items()])

    def run(batches):
        import pandas as pd

        found = [r for b in batches for r in b.itertuples(index=False)]
        state, out = SchemaState(), []
        for r in sorted(found, key=lambda r: r.position):
            before = dict(state.tables)
            changes = state.apply(r.sql, None if pd.isna(r.db) else r.db)
            out += rows_of(before, state.tables, r, changes)
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return own.filter("sql IS NOT NULL").coalesce(1).mapInPandas(run, schema)


def schema_history(statements: DataFrame) -> DataFrame:
    """(position, sql, tbl, before, after) from (position, sql and, where known, db), columns as ``name type, ...`` text.

    Statements without text are left out; an empty log has no history.
    """
    rows = lambda before, after, r, changes: [(r.position, r.sql, t, columns_text(b), columns_text(a)) for t, b, a in changes]
    return _interpreted(statements, rows, "position bigint, sql string, tbl string, before string, after string")


def _table_json(table: str, columns: Sequence[ColumnInfo] | None) -> dict | None:
    if columns is None:
        return None
    db, _, name = table.rpartition(".")
    own = [{"name": c.name, "columnType": c.column_type, "key": c.key, "valueDefault": c.default, "nullable": c.nullable} for c in columns]
    return {"fullTableName": {"db": db or None, "name": name}, "columnSchemas": own, "create": create_text(table, columns)}


def schema_snapshots(statements: DataFrame) -> DataFrame:
    """(position, ts_ms, ddl, transition, schema_before, schema_after, creates_before, creates_after): for each statement
    that changes a schema, what it changed and all tables and their CREATE statements before and after it, as JSON."""

    def rows(before, after, r, changes):
        import json

        if not changes:
            return []
        text = lambda x: json.dumps(x, separators=(",", ":"), sort_keys=False)
        steps = [{"ddl": r.sql, "schemaTransitionTimestamp": r.ts_ms, "tableName": t, "tableSchemaBefore": _table_json(t, b), "tableSchemaAfter": _table_json(t, a)} for t, b, a in changes]
        whole = [text({t: _table_json(t, c) for t, c in sorted(x.items())}) for x in (before, after)]
        creates = [text({t: create_text(t, c) for t, c in sorted(x.items())}) for x in (before, after)]
        return [(r.position, r.ts_ms, r.sql, text(steps), *whole, *creates)]

    return _interpreted(statements, rows, "position bigint, ts_ms bigint, ddl string, transition string, schema_before string, schema_after string, creates_before string, creates_after string")


def history_cells(snapshots: DataFrame, schema: str, namespace: str = "", initial: bool = False) -> DataFrame:
    """Cells (tbl, row_key, qualifier, ts_us, value) of the schema history table: six for each change, keyed by its time;
    those of an initial snapshot have one key."""
    cells = F.create_map(
        F.lit("ddl"), "ddl", F.lit("schemaTransitionSequence"), "transition", F.lit("schemaPreChange"), "schema_before", F.lit("schemaPostChange"), "schema_after",
        F.lit("createsPreChange"), "creates_before", F.lit("createsPostChange"), "creates_after",
    )
    key = F.lit("initial-snapshot") if initial else F.col("ts_ms").cast("string")
    table = (f"{namespace}:" if namespace else "") + schema.lower() + "_schema_history"
    return snapshots.select(F.lit(table).alias("tbl"), key.alias("row_key"), F.explode(cells).alias("qualifier", "value"), (F.col("ts_ms") * 1000).alias("ts_us")).select("tbl", "row_key", "qualifier", "ts_us", "value")


def bootstrap(columns: DataFrame) -> DataFrame:
    """(position, sql): CREATE statements of the tables that exist at the start, from their columns (tbl, ordinal, name,
    column_type, nullable, key), as an information schema lists them. One row a table comes out, before all positions."""
    own = F.concat(F.lit("`"), F.col("name"), F.lit("` "), F.col("column_type"), F.when(F.col("nullable"), "").otherwise(" NOT NULL"))
    each = F.sort_array(F.collect_list(F.struct("ordinal", own.alias("text"), F.when(F.col("key") == "PRI", F.concat(F.lit("`"), F.col("name"), F.lit("`"))).alias("primary"))))
    tables = columns.groupBy("tbl").agg(each.alias("_c"))
    primary = F.filter(F.col("_c.primary"), lambda x: x.isNotNull())
    closing = F.when(F.size(primary) > 0, F.concat(F.lit(", PRIMARY KEY ("), F.array_join(primary, ", "), F.lit(")"))).otherwise("")
    return tables.select(F.lit(-1).cast("long").alias("position"), F.concat(F.lit("CREATE TABLE "), F.col("tbl"), F.lit(" ("), F.array_join("_c.text", ", "), closing, F.lit(")")).alias("sql"))


def columns_before(history: DataFrame) -> DataFrame:
    """(position, tbl, before, after): the columns that each change found and left; no before for a new table, no after
    for one that goes. The history has them as the interpreter went, also where a statement changes a table twice."""
    return history.select("position", "tbl", "before", "after")
