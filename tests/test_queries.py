"""Every query with SQL gives the SQL's rows on the smallest tables; the others give rows."""

import glob
import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from textmill.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {Path(p).stem} as select * from '{p}'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return float(f"{float(v):.8g}") + 0.0 if isinstance(v, (int, float)) or v.__class__.__name__ == "Decimal" else v


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    if name not in registry.ORACLE_SQL:
        return
    r = duck.sql(registry.ORACLE_SQL[name])
    at = [r.columns.index(c) for c in sorted(r.columns)]
    assert sorted(r.columns) == cols
    assert got == sorted(repr(tuple(plain(x[i]) for i in at)) for x in r.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
