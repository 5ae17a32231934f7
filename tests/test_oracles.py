"""Every registered query of the link engine against its DuckDB form."""

import os
from collections import Counter

import duckdb
import pytest

from gleaner.plans.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def flat(rows):
    return Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "orders", "part", "customer", "events"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    mine = flat(df.select(*columns).collect())
    assert mine
    if name in ORACLES:
        assert mine == flat(duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall())
