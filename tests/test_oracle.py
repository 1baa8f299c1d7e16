"""Every registered SQL-checkable query against its DuckDB oracle on the
smallest driver tables (the driver repeats this at sf0.01)."""

import datetime as dt
import decimal
import math

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

SQL = E.oracle_sql()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con(duck):
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    want = cur.fetchall()
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.columns, rows) == _canon(cols, want)


def test_every_query_has_a_registered_callable():
    qs = E.queries()
    assert set(SQL) <= set(qs)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 80
    assert [r.call_rank for r in rows] == list(range(1, 81)) or sorted(r.call_rank for r in rows) == list(range(1, 81))
