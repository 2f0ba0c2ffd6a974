"""Typed decoding of raw cells: one Column in, one Column out, built-in expressions only.

``raw`` is the value as the log carries it (integers, bytes, epoch milliseconds, member indexes, bit masks).
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Text that stands for SQL NULL in every sink.
NULL_TEXT = "NULL"
_MASKS = {"tinyint": 0xFF, "smallint": 0xFFFF, "mediumint": 0xFFFFFF, "int": 0xFFFFFFFF}


def integer(raw: Column, column_type: str) -> Column:
    """BIGINT; an unsigned type reads the raw bits as a number without sign."""
    kind = column_type.lower()
    value = raw.cast("long")
    if "unsigned" not in kind:
        return value
    return value.bitwiseAND(F.lit(_MASKS[kind.split("(")[0].split()[0]]))


def bigint_unsigned(raw: Column) -> Column:
    """DECIMAL(20,0) of the 64 raw bits."""
    wide = raw.cast("decimal(20,0)")
    return F.when(wide < 0, wide + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")


def binary_fixed(raw: Column, length: int) -> Column:
    """Upper-case hex, zero-padded or cut to ``length`` bytes."""
    return F.rpad(F.hex(raw), 2 * length, "0")


def blob(raw: Column) -> Column:
    return F.hex(raw)


def text(raw: Column, collation: str) -> Column:
    """ISO-8859-1 for latin1 collations, else UTF-8."""
    return F.decode(raw, "ISO-8859-1" if "latin1" in collation.lower() else "UTF-8")


def bits(raw: Column) -> Column:
    """Bit string without leading zeros; no bits: 0."""
    return F.bin(raw)


def date_text(millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd")


def time_text(millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(millis), "HH:mm:ss.SSS")


def timestamp(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def enum_member(index: Column, members: Sequence[str]) -> Column:
    """1-based member; 0 and numbers beyond the list: null."""
    return F.get(F.array(*map(F.lit, members)), index.cast("int") - 1)


def set_members(mask: Column, members: Sequence[str]) -> Column:
    """Members of the set bits, joined by commas; a mask of 0 or less (that of a set with its 64th member): null."""
    chosen = [F.when(F.shiftright(mask.cast("long"), k).bitwiseAND(F.lit(1)) != 0, F.lit(m)) for k, m in enumerate(members)]
    return F.when(mask > 0, F.concat_ws(",", *chosen))


def decimal_text(raw: Column, precision: int, scale: int) -> Column:
    return raw.cast(f"decimal({precision},{scale})").cast("string")


def member_list(column_type: str, compat: bool = False) -> list[str]:
    """Members of an enum(...) or set(...) column type, quotes and doubled quotes undone.

    compat=True lower-cases the type and splits at every comma up to the first closing parenthesis, as older readers did.
    """
    if compat:
        inner = column_type.lower().split("(", 1)[1].split(")", 1)[0]
        return [m.strip().strip("'") for m in inner.split(",")]
    inner, out, at = column_type[column_type.index("(") + 1 : column_type.rindex(")")], [], 0
    while (at := inner.find("'", at)) >= 0:
        end = at + 1
        while not (inner[end] == "'" and inner[end + 1 : end + 2] != "'"):
            end += 2 if inner[end] == "'" else 1
        out.append(inner[at + 1 : end].replace("''", "'"))
        at = end + 1
    return out


def value_text(value: Column) -> Column:
    """The value as sinks write it: text, NULL as the word."""
    return F.coalesce(value.cast("string"), F.lit(NULL_TEXT))


def _json_number(kind: str, data: bytes, at: int) -> tuple[int | float, int]:
    import struct

    return struct.unpack_from("<" + kind, data, at)[0], at + struct.calcsize("<" + kind)


def _json_length(data: bytes, at: int) -> tuple[int, int]:
    """A length in groups of 7 bits, the lowest first; the top bit says that another follows."""
    n = shift = 0
    while True:
        b = data[at]
        n |= (b & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if not b & 0x80:
            return n, at


def packed_decimal(data: bytes) -> str:
    """Text of a decimal as the database packs it: precision, scale, then groups of 9 digits in 4 bytes, rests in fewer;
    the first bit is set for numbers of 0 and above, all bits of others are inverted."""
    precision, scale, body = data[0], data[1], bytearray(data[2:])
    negative = not body[0] & 0x80
    body[0] ^= 0x80
    if negative:
        body = bytearray(b ^ 0xFF for b in body)
    width = (0, 1, 1, 2, 2, 3, 3, 4, 4, 4)  # bytes for 0 to 9 digits
    whole = precision - scale
    at, digits = 0, ["", ""]
    for part, groups in ((0, [whole % 9] + [9] * (whole // 9)), (1, [9] * (scale // 9) + [scale % 9])):
        for n in filter(None, groups):
            digits[part] += f"{int.from_bytes(body[at : at + width[n]], 'big'):0{n}d}"
            at += width[n]
    return ("-" if negative else "") + (digits[0].lstrip("0") or "0") + ("." + digits[1] if scale else "")


def _packed_time(kind: int, bits: int) -> str:
    """Text of a date (10), timestamp (7), time (11) or datetime (12) packed in 64 bits: 24 for the microseconds, below
    the clock (5 + 6 + 6 bits), below the day (5) and 13 x year + month."""
    sign, bits = ("-", -bits) if bits < 0 else ("", bits)
    micros, clock = bits & 0xFFFFFF, bits >> 24
    if kind == 11:
        return f"{sign}{clock >> 12 & 0x3FF:02d}:{clock >> 6 & 63:02d}:{clock & 63:02d}.{micros:06d}"
    day, months = clock >> 17 & 31, clock >> 22
    text = f"{months // 13:04d}-{months % 13:02d}-{day:02d}"
    return text if kind == 10 else f"{text} {clock >> 12 & 31:02d}:{clock >> 6 & 63:02d}:{clock & 63:02d}.{micros:06d}"


def _json_opaque(data: bytes, at: int) -> str:
    """Values of other column types: decimals as plain text, times as text, the rest as base64 with its type."""
    import base64

    kind = data[at]
    n, start = _json_length(data, at + 1)
    body = data[start : start + n]
    if kind == 246:
        return packed_decimal(body)
    if kind in (7, 10, 11, 12):
        return _packed_time(kind, int.from_bytes(body[:8], "little", signed=True))
    return f"base64:type{kind}:{base64.b64encode(body).decode()}"


def _json_value(data: bytes, kind: int, at: int):
    # Type bytes of the binary format.
    if kind in (0, 1):
        return _json_container(data, True, kind == 1, at)
    if kind in (2, 3):
        return _json_container(data, False, kind == 3, at)
    if kind == 4:
        return {0: None, 1: True, 2: False}[data[at]]
    if kind == 12:
        n, start = _json_length(data, at)
        return data[start : start + n].decode()
    if kind == 15:
        return _json_opaque(data, at)
    return _json_number({5: "h", 6: "H", 7: "i", 8: "I", 9: "q", 10: "Q", 11: "d"}[kind], data, at)[0]


def _json_container(data: bytes, is_object: bool, large: bool, base: int):
    """An object or array: count, size, entries of keys and of values, whose offsets count from ``base``."""
    wide = "I" if large else "H"
    inline = {4, 5, 6, 7, 8} if large else {4, 5, 6}
    count, at = _json_number(wide, data, base)
    at = _json_number(wide, data, at)[1]
    keys, values = [], []
    for _ in range(count if is_object else 0):
        start, at = _json_number(wide, data, at)
        n, at = _json_number("H", data, at)
        keys.append(data[base + start : base + start + n].decode())
    for _ in range(count):
        kind, where = data[at], at + 1
        offset, at = _json_number(wide, data, where)
        values.append(_json_value(data, kind, where if kind in inline else base + offset))
    return dict(zip(keys, values)) if is_object else values


def json_text(raw: bytes | None) -> str | None:
    """Text of the database's binary JSON; null for null or unreadable bytes.

    Decimals and times inside a document are text.
    """
    import json
    import struct

    try:
        value = _json_value(raw, raw[0], 1) if raw else None
        return None if raw is None else json.dumps(value, separators=(",", ":"), ensure_ascii=False)
    except (IndexError, KeyError, ValueError, struct.error):
        return None


def json_column(raw: Column) -> Column:
    """Binary JSON has no built-in reader: an Arrow-batched function."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else json_text(bytes(v)) for v in values], dtype=object)

    return run(raw)
