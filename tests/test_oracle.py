"""Every query with SQL gives the SQL's rows on the small tables."""

import os
from collections import Counter

import duckdb
import pytest

from chronicell.plans import registry

DATA = os.environ.get("CHRONICELL_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows(spark, con, name):
    df = registry.QUERIES[name](spark, DATA)
    want = con.sql(registry.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = Counter(map(tuple, df.select(*want.columns).collect()))
    assert got == Counter(want.fetchall())


def test_every_query_is_checked():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_columns_before_follow_the_statements(spark):
    rows = registry.QUERIES["schema_before_after"](spark, DATA).collect()
    seen = {(r.position, r.tbl): (r.before, r.after) for r in rows}
    old = "no int unsigned, total decimal(9,2), state enum('Open','Paid')"
    assert len(rows) == 15 and seen[7, "shop.invoice_past"] == (old, None)
    assert seen[0, "shop.invoice"] == (None, old)
