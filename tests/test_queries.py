"""Every registered query of the library against its SQL, on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__
from holdfast.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 4)
    return v.isoformat() if isinstance(v, datetime.date) else v


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    cur = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    expected = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str) == expected


def test_entry(spark):
    if os.path.isdir(SF):
        assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.queries()) <= set(__spark_entry__.queries())
