"""The database's binary log files, read event by event (format version 4, as its documentation lays it out).

Reading keeps one event in memory. Row images are positional: values go by ``@1``, ``@2``, ... until ``typed_images``
names and decodes them by a table's columns.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime
from typing import BinaryIO

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronicell.functions import decode

MAGIC = b"\xfebin"
_HEADER = struct.Struct("<IBIIIH")  # seconds, type, server, length, next position, flags
# Event types.
EVENT_TYPES = {
    2: "QUERY", 3: "STOP", 4: "ROTATE", 5: "INTVAR", 13: "RAND", 14: "USER_VAR", 15: "FORMAT_DESCRIPTION", 16: "XID", 19: "TABLE_MAP",
    23: "WRITE_ROWS", 24: "UPDATE_ROWS", 25: "DELETE_ROWS", 27: "HEARTBEAT", 29: "ROWS_QUERY", 30: "EXT_WRITE_ROWS", 31: "EXT_UPDATE_ROWS", 32: "EXT_DELETE_ROWS",
    33: "GTID", 34: "ANONYMOUS_GTID", 35: "PREVIOUS_GTIDS", 38: "XA_PREPARE",
}
# Column types of table maps.
COLUMN_TYPES = {
    1: "tiny", 2: "short", 3: "long", 4: "float", 5: "double", 7: "timestamp", 8: "longlong", 9: "int24", 10: "date", 11: "time", 12: "datetime", 13: "year", 15: "varchar", 16: "bit",
    17: "timestamp2", 18: "datetime2", 19: "time2", 245: "json", 246: "newdecimal", 247: "enum", 248: "set", 249: "tiny_blob", 250: "medium_blob", 251: "long_blob", 252: "blob",
    253: "var_string", 254: "string", 255: "geometry",
}


class _Bytes:
    """A cursor over an event's body."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        out = self.data[self.at : self.at + n]
        if len(out) < n:
            raise ValueError("the event ends before its last value")
        self.at += n
        return out

    def number(self, n: int, order: str = "little", signed: bool = False) -> int:
        return int.from_bytes(self.take(n), order, signed=signed)

    def packed(self) -> int:
        """A length-encoded number."""
        first = self.number(1)
        return first if first < 251 else self.number({252: 2, 253: 3, 254: 8}[first])

    def bits(self, n: int) -> list[bool]:
        data = self.take((n + 7) // 8)
        return [bool(data[k // 8] >> k % 8 & 1) for k in range(n)]

    def rest(self) -> bytes:
        return self.take(len(self.data) - self.at)


@dataclass
class TableMap:
    db: str
    tbl: str
    types: list[tuple[str, int]]  # kind, metadata


@dataclass
class LogState:
    """What earlier events of a file say about later ones."""

    checksums: bool = False
    tables: dict[int, TableMap] = field(default_factory=dict)
    gtid: str | None = None


def _type(code: int, meta: _Bytes) -> tuple[str, int]:
    kind = COLUMN_TYPES.get(code)
    if kind is None:
        raise ValueError(f"unknown column type {code}")
    if kind in ("string", "var_string", "enum", "set"):
        first, second = meta.number(1), meta.number(1)
        if first & 0x30 != 0x30:  # two bits of the length lie in the type
            return "string", second | ((first & 0x30) ^ 0x30) << 4
        real = COLUMN_TYPES.get(first, "string")
        return (real if real in ("enum", "set") else "string"), second
    if kind == "newdecimal":
        return kind, meta.number(1) << 8 | meta.number(1)
    if kind in ("varchar", "bit"):
        return kind, meta.number(2)
    if kind in ("float", "double", "json", "geometry", "timestamp2", "datetime2", "time2") or kind.endswith("blob"):
        return kind, meta.number(1)
    return kind, 0


def _millis(year: int, month: int, day: int, hour: int = 0, minute: int = 0, second: int = 0, micros: int = 0) -> str | None:
    if not (year and month and day):
        return None  # zero dates
    return str(int(datetime(year, month, day, hour, minute, second, tzinfo=UTC).timestamp()) * 1000 + micros // 1000)


def _fraction(b: _Bytes, digits: int) -> int:
    """Microseconds of a fraction of so many digits."""
    n = (digits + 1) // 2
    return b.number(n, "big") * 10 ** (6 - 2 * n) if n else 0


def _value(kind: str, meta: int, b: _Bytes) -> str | None:
    """A value as text: numbers in decimal, dates and times in milliseconds (UTC), bytes in hex."""
    if kind in ("tiny", "short", "int24", "long", "longlong"):
        return str(b.number({"tiny": 1, "short": 2, "int24": 3, "long": 4, "longlong": 8}[kind], signed=True))
    if kind in ("float", "double"):
        return repr(struct.unpack("<f" if kind == "float" else "<d", b.take(4 if kind == "float" else 8))[0])
    if kind == "year":
        n = b.number(1)
        return str(1900 + n if n else 0)
    if kind == "date":
        n = b.number(3)
        return _millis(n >> 9, n >> 5 & 15, n & 31)
    if kind == "time":
        n = b.number(3, signed=True)
        return str((n // 10000 * 3600 + n // 100 % 100 * 60 + n % 100) * 1000)
    if kind == "datetime":
        n = b.number(8)
        return _millis(n // 10**10, n // 10**8 % 100, n // 10**6 % 100, n // 10**4 % 100, n // 100 % 100, n % 100)
    if kind == "timestamp":
        return str(b.number(4) * 1000)
    if kind == "timestamp2":
        return str(b.number(4, "big") * 1000 + _fraction(b, meta) // 1000)
    if kind == "datetime2":
        n = b.number(5, "big") - (1 << 39)
        months = n >> 22
        return _millis(months // 13, months % 13, n >> 17 & 31, n >> 12 & 31, n >> 6 & 63, n & 63, _fraction(b, meta))
    if kind == "time2":
        n = b.number(3, "big") - (1 << 23)
        return str(((n >> 12 & 1023) * 3600 + (n >> 6 & 63) * 60 + (n & 63)) * 1000 + _fraction(b, meta) // 1000)
    if kind == "newdecimal":
        precision, scale = meta >> 8, meta & 255
        width = lambda digits: digits // 9 * 4 + (0, 1, 1, 2, 2, 3, 3, 4, 4)[digits % 9]
        return decode.packed_decimal(bytes([precision, scale]) + b.take(width(precision - scale) + width(scale)))
    if kind == "bit":
        return str(b.number((meta >> 8) + bool(meta & 255), "big"))
    if kind in ("enum", "set"):
        return str(b.number(meta))
    if kind in ("varchar", "string"):
        return b.take(b.number(1 if meta < 256 else 2)).hex().upper()
    return b.take(b.number(meta)).hex().upper()


def _rows(kind: str, body: _Bytes, state: LogState) -> tuple[int, TableMap, list]:
    table_id = body.number(6)
    body.take(2)
    if kind.startswith("EXT_"):
        body.take(body.number(2) - 2)
    table = state.tables.get(table_id)
    if table is None:
        raise ValueError(f"a row event before the map of its table {table_id}")
    n = body.packed()
    if n != len(table.types):
        raise ValueError("row image and table map differ in width")
    images = 2 if "UPDATE" in kind else 1
    present = [body.bits(n) for _ in range(images)]

    def image(has: list[bool]) -> dict[str, str | None]:
        null = iter(body.bits(sum(has)))
        return {f"@{k + 1}": None if next(null) else _value(*table.types[k], body) for k in range(n) if has[k]}

    rows = []
    while body.at < len(body.data):
        found = [image(has) for has in present]
        rows.append((found[0], found[1]) if images == 2 else (found[0], None) if "DELETE" in kind else (None, found[0]))
    return table_id, table, rows


def headers(file: BinaryIO, at: int = 4) -> Iterator[tuple[int, str, int, int, int]]:
    """(position, type, seconds, length, server id) of each whole event from ``at`` on; the file's size ends it."""
    end = file.seek(0, 2)
    while at + _HEADER.size <= end:
        file.seek(at)
        seconds, code, server, length, _, _ = _HEADER.unpack(file.read(_HEADER.size))
        if length < _HEADER.size or at + length > end:
            return
        yield at, EVENT_TYPES.get(code, f"UNKNOWN_{code}"), seconds, length, server
        at += length


def last_boundary(file: BinaryIO, at: int = 4) -> int:
    """Where the last whole event ends: a file that is being written may end inside of one."""
    for start, _, _, length, _ in headers(file, at):
        at = start + length
    return at


def read_events(file: BinaryIO, name: str, start: int = 4, stop: int | None = None) -> Iterator[dict]:
    """The events of a file that begin at or after ``start`` and before ``stop``, as raw events.

    Only the events before ``start`` that say something about later ones are read, the others are stepped over. Positions
    are those of the next event, as the database counts them.
    """
    file.seek(0)
    if file.read(4) != MAGIC:
        raise ValueError(f"not a binary log: {name}")
    state = LogState()
    for at, kind, seconds, length, server in headers(file):
        if stop is not None and at >= stop:
            return
        known = kind in ("FORMAT_DESCRIPTION", "TABLE_MAP", "GTID")
        if at < start and not known:
            continue
        file.seek(at + _HEADER.size)
        data = file.read(length - _HEADER.size)
        if kind == "FORMAT_DESCRIPTION":
            state.checksums = data[-5] == 1
        body = _Bytes(data[:-4] if state.checksums or kind == "FORMAT_DESCRIPTION" else data)
        event = {"server": str(server), "file": name, "position": at + length, "ts_ms": seconds * 1000, "event_type": kind}
        if kind == "ROTATE":
            event |= {"position": body.number(8), "file": body.rest().decode()}
        elif kind == "QUERY":
            body.take(8)
            db, _, status = body.number(1), body.number(2), body.number(2)
            body.take(status)
            event["db"] = body.take(db).decode()
            body.take(1)
            event["sql"] = body.rest().decode("utf-8", "replace")
        elif kind == "XID":
            event["xid"] = body.number(8)
        elif kind == "GTID":
            body.take(1)
            state.gtid = f"{uuid.UUID(bytes=body.take(16))}:{body.number(8)}"
        elif kind == "TABLE_MAP":
            table_id = body.number(6)
            body.take(2)
            db = body.take(body.number(1)).decode()
            body.take(1)
            tbl = body.take(body.number(1)).decode()
            body.take(1)
            codes = body.take(body.packed())
            meta = _Bytes(body.take(body.packed()))
            state.tables[table_id] = TableMap(db, tbl, [_type(c, meta) for c in codes])
            event |= {"table_id": table_id, "db": db, "tbl": tbl}
        elif kind.endswith("_ROWS"):
            table_id, table, rows = _rows(kind, body, state)
            event |= {"table_id": table_id, "db": table.db, "tbl": table.tbl, "rows": rows}
        if at >= start:
            yield event | {"gtid": state.gtid}


def typed_value(raw: Column, column_type: str, collation: str = "utf8") -> Column:
    """A raw value's text by the type that the schema gives its column: what sinks write."""
    kind = column_type.lower()
    base = kind.split("(")[0].split()[0]
    number = raw.cast("long")
    if base == "bigint" and "unsigned" in kind:
        return decode.bigint_unsigned(raw.cast("decimal(20,0)")).cast("string")
    if base in ("tinyint", "smallint", "mediumint", "int", "integer", "bigint", "year"):
        return decode.integer(raw, kind.replace("integer", "int")).cast("string")
    if base in ("char", "varchar", "tinytext", "text", "mediumtext", "longtext"):
        return decode.text(F.unhex(raw), collation)
    if base == "binary":
        return decode.binary_fixed(F.unhex(raw), int(kind.split("(")[1].split(")")[0]))
    if base == "bit":
        return decode.bits(number)
    if base == "enum":
        return decode.enum_member(number, decode.member_list(column_type))
    if base == "set":
        return decode.set_members(number, decode.member_list(column_type))
    if base == "date":
        return decode.date_text(number)
    if base == "time":
        return decode.time_text(number)
    if base == "json":
        return decode.json_column(F.unhex(raw))
    return raw  # decimals and fractions are plain text, blobs hex, datetimes and timestamps milliseconds


def typed_images(events: DataFrame, columns: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Row events of one table, given its columns (name, type, collation) in order, with before and after by name and
    decoded; one row for each changed row (row_idx). An image of another width is an error."""
    from chronicell.operators.augment import extract_rows

    def image(of: str) -> Column:
        entries = [x for k, (name, kind, collation) in enumerate(columns) for x in (F.lit(name), typed_value(F.try_element_at(of, F.lit(f"@{k + 1}")), kind, collation))]
        width = F.raise_error(F.lit("row image and schema differ in width")).cast("map<string,string>")
        return F.when(F.col(of).isNull(), F.lit(None)).when(F.size(of) == len(columns), F.create_map(*entries)).otherwise(width)

    found = extract_rows(events)
    return found.withColumns({"before": image("before"), "after": image("after")})
