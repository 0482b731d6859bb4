"""Every registered query of the commerce side against its SQL in DuckDB."""

import decimal
import math
import os

import duckdb
import pytest

from saltmarsh.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    return round(v, 6) if isinstance(v, float) else v if isinstance(v, bool | int) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_matches_sql(spark, duck, name):
    df = catalog.queries()[name](spark, DATA)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*sorted(df.columns)).collect()), key=repr)
    sql = catalog.oracle_sql()[name]
    columns = sorted(duck.sql(sql).columns)
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
    assert columns == sorted(df.columns)
    assert got == sorted((tuple(plain(v) for v in r) for r in want), key=repr)


def test_every_query_has_sql():
    assert catalog.queries().keys() == catalog.oracle_sql().keys()
