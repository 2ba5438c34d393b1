"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from regiolake import plans
from regiolake.sources.catalog import DRIVER_TABLES

SF = os.environ.get("REGIOLAKE_TEST_SF", "/root/testdata/sf0.001")
plans.load_all()
QUERIES = plans.QUERIES
ORACLE = plans.ORACLE


def _norm(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def _key(t):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 1
    assert "over_representation_ratio" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    duck.execute(f"CREATE OR REPLACE VIEW checked AS {ORACLE[name]}")     # the SQL must also do as a view
    res = duck.execute("SELECT * FROM checked")
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
    assert got == want
