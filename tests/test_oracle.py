"""Every core query with SQL gives the rows that another engine gets from that SQL."""

from __future__ import annotations

import datetime
import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from hierarq import queries as core

QUERIES, SQL = {n: entry.queries()[n] for n in core.QUERIES}, core.SQL


def plain(v):  # noqa: ANN001, ANN201
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, datetime.datetime):
        return str(v)
    return v


@pytest.fixture(scope="module")
def duck(small):  # noqa: ANN001, ANN201
    con = duckdb.connect()
    for f in glob.glob(small + "/*.parquet"):
        path = f + "/*.parquet" if os.path.isdir(f) else f
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_sql_has_a_query() -> None:
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, small, name) -> None:  # noqa: ANN001
    df = QUERIES[name](spark, small)
    result = duck.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in result.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name) -> None:  # noqa: ANN001
    df = QUERIES[name](spark, small)
    assert df.columns and df.count() >= 0


def test_entry(spark) -> None:  # noqa: ANN001
    assert entry.entry(spark).count() > 0
