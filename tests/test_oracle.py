"""Every registered query against its DuckDB twin on the smallest tables."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from newslake.fixtures import TABLES, table_path

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(SF, t)}')")
    return con


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(srows) > 0
        return
    rel = duck.execute(sql)
    dcols = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, srows) == _canon(dcols, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["date", "source", "daily_count", "moving_avg_7d"]
