"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from layerflow.plans import registry
from layerflow.plans.fixtures import TABLES

SF = "/root/testdata/sf0.001"
QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "resale_identifier_hash" in df.columns
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    a = Counter(tuple(_norm(r[cols.index(c)]) for c in order) for r in got)
    b = Counter(tuple(_norm(r[ocols.index(c)]) for c in order) for r in want)
    assert a == b
