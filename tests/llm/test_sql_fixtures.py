"""Operators with SQL against DuckDB, on rows made to be awkward: nulls, ties, repeats, long lines, odd spaces."""

import os
from collections import Counter

import duckdb
import pandas as pd
import pyarrow as pa
import pyarrow.parquet  # noqa: F401
import pytest

from chronicell.llm import registry

LONG = " ".join(f"word{i % 700}" for i in range(9000)) + "."
LINE = "A line that three documents share, with words."
ITEM = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [
    (0, None), (1, ""), (2, "\n\n"), (3, " \t\x0b\x0c\r "), (4, "short text."), (5, LONG), (6, LONG), (7, LONG + "\n" + LONG),
    (8, f"{LINE}\nown line of document eight, long enough\n  {LINE.upper()}\t"), (9, f"\r{LINE}\r\nown"), (10, f"x\n{LINE}\n"), (11, f"{LINE}\n{LINE}"),
    (12, "a | b | c | d | e | f\nHome\nAbout us"), (13, "BUY!! NOW!! CHEAP!! THINGS!! HERE!! " * 12), (14, "la " * 90), (15, "One two. " * 40 + "all rights reserved " * 3),
    (16, f"Before it. {ITEM.title()} and after, in a longer text of many words that go on and on."), (17, "eleven twelve. " + ITEM.replace("twelve", "dozen")), (18, "Éa ß ÑANDÚ ΑΒΓ 日本語 text text"), (19, "z#*$%&|<>!"),
    (20, " ".join(f"clean{i}" for i in range(80)) + ".\nMenu\nmore words follow here, as they should."), (20, "same id, another text that is long"), (21, "twin"), (21, "twin"), (22, " ".join(f"w{i}" for i in range(60)) + ".\nHome     about\nHome \t about\nPolítica de privacidad, aquí y allí."), (None, f"no id\n{LINE}"),
]
ITEMS = [(1, ITEM), (2, "too short"), (3, None), (4, ""), (5, "one two three four five"), (6, ITEM), (7, "nothing of this is found anywhere in there"), (8, "Twin!"), (9, "words that go")]


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    """documents with extra columns whose names operators might use, and benchmark."""
    path = tmp_path_factory.mktemp("tables")
    docs = pd.DataFrame({"doc_id": pd.array([i for i, _ in ROWS], "Int64"), "text": [t for _, t in ROWS], "lang": None, "source": "s", "n_chars": 0, "size": 7, "h": "x", "item": "y", "kept": True, "n_words": "w"})
    docs["lang"] = docs["lang"].astype("string")
    pa.parquet.write_table(pa.Table.from_pandas(docs), path / "documents.parquet")
    pa.parquet.write_table(pa.table({"item_id": pa.array([i for i, _ in ITEMS], pa.int64()), "text": [t for _, t in ITEMS]}), path / "benchmark.parquet")
    return str(path)


def rows(columns, found):
    at = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(r[k] for k in at) for r in found)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
@pytest.mark.parametrize("empty", [False, True])
def test_like_sql(spark, folder, tmp_path, name, empty):
    if empty:
        for t in ("documents", "benchmark"):
            pa.parquet.write_table(pa.parquet.read_table(f"{folder}/{t}.parquet").slice(0, 0), tmp_path / f"{t}.parquet")
        folder = str(tmp_path)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet'")
    want = con.sql(registry.ORACLE_SQL[name])
    df = registry.QUERIES[name](spark, folder)
    assert rows(df.columns, map(tuple, df.collect())) == rows(want.columns, want.fetchall())


def test_every_query_is_named_for_its_operator():
    assert {n.split("_")[0] for n in registry.QUERIES} >= {f"op{k}" for k in range(1, 11)}


def test_sql_only_for_what_it_can_say():
    assert set(registry.ORACLE_SQL) == {n for n in registry.QUERIES if n.split("_")[0] in ("op5", "op6", "op7", "op8")}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_like_sql_on_the_small_tables(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet'")
    want = con.sql(registry.ORACLE_SQL[name])
    df = registry.QUERIES[name](spark, folder)
    assert rows(df.columns, map(tuple, df.collect())) == rows(want.columns, want.fetchall())
