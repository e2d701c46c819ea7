"""Every registered query against its DuckDB oracle (order-insensitive,
column order ignored, doubles compared to 9 decimals)."""

import math

import pytest

from conftest import SF_SMALL, duck, query_frame

import __spark_entry__ as entry

from kasir.queries import ORACLES, QUERIES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _canon(rows, cols):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in idx) for r in rows)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = query_frame(spark, name)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(got, df.columns) == _canon(want, ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "previous_sales_net" in df.columns
