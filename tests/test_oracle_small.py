"""Every payment key equals its DuckDB oracle on the smallest test tables."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from conftest import SF_SMALL
from __spark_entry__ import entry, oracle_sql, queries
from paylake.plans.catalog import QUERIES
from paylake.sources.tables import TABLES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_key_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["month", "channel_type", "success_rate"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_key_matches_oracle(spark, duck, key):
    df = queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = duck.sql(oracle_sql()[key])
    ocols = rel.columns
    assert sorted(ocols) == cols
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want
