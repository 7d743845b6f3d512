"""Every query against its SQL on DuckDB."""

import datetime
import decimal
import math
import os

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from lakeforge.plans import ORACLES, QUERIES


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else f"{float(v):.6g}"
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for n in os.listdir(SF):
        c.execute(f"create view {n.split('.')[0]} as select * from '{SF}/{n}'")
    return c


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, duck, key):
    df = QUERIES[key](spark, SF)
    cols = sorted(df.columns)
    found = duck.execute(ORACLES[key])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in found.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() == 4
    assert set(ORACLES) <= set(entry.queries())
