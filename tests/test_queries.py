"""Every query of the core with SQL against DuckDB, and all of them for a stable schema."""

import datetime
import decimal
import importlib
import math
import os

import duckdb
import pytest

from quern.plans import registry

registry.load()


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return "nan" if isinstance(v, float) and math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, con, name):
    df = registry.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    rows = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name in registry.ORACLE:
        cur = con.execute(registry.ORACLE[name])
        names = [c[0] for c in cur.description]
        assert sorted(names) == cols
        want = sorted((tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
        assert rows == want


def test_entry(spark):
    e = importlib.import_module("__spark_entry__")
    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
