"""Every registered query with SQL against DuckDB on the smallest tables."""

import decimal
import os

import duckdb
import pytest

from siltbed.plans import load_queries, more_queries  # noqa: F401
from siltbed.plans import queries as q

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations")


@pytest.fixture(scope="module")
def db():
    if not os.path.isdir(SF):
        pytest.skip("no tables here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def shown(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v else "0"
    return str(v)


@pytest.mark.parametrize("name", list(q.QUERIES))
def test_query(spark, db, name):
    df = q.QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in q.SQL:
        assert rows
        return
    found = db.execute(q.SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    want = sorted(tuple(shown(r[columns.index(c)]) for c in order) for r in found.fetchall())
    assert sorted(tuple(shown(r[c]) for c in order) for r in rows) == want
