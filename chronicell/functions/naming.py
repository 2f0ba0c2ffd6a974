"""Row keys, table names and SQL text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronicell.functions.decode import value_text


def salted_key(pk: Sequence[Column]) -> Column:
    """First 4 bytes of md5 of the first key value as hex, then all key values, joined by semicolons.

    The salt spreads neighbouring keys over the key space; every row of one key keeps one salt.
    """
    values = [value_text(c) for c in pk]
    return F.concat_ws(";", F.substring(F.md5(F.encode(values[0], "US-ASCII")), 1, 8), *values)


def salted_key_of(values: Column) -> Column:
    """The same for an array of text."""
    return F.concat_ws(";", F.substring(F.md5(F.encode(F.get(values, F.lit(0)), "US-ASCII")), 1, 8), values)


def plain_table(name: Column) -> Column:
    """Without backticks and without a leading database name."""
    return F.element_at(F.split(F.replace(name, F.lit("`"), F.lit("")), r"\."), -1)


def merged_table(name: Column, pattern: str) -> Column:
    """Monthly or sharded tables become one: what matches the pattern is cut out of the name."""
    return F.regexp_replace(name, pattern, "")


def without_database(sql: Column, db: str) -> Column:
    """A statement as the shadow schema runs it: names lose the database, a leading ``use`` goes."""
    d = re.escape(db)
    return F.regexp_replace(F.regexp_replace(sql, f" `?{d}`?\\.", " "), f"use\\s+`?{d}`?;\\s+", "")


def url_encoded(value: Column) -> Column:
    return F.url_encode(value)
