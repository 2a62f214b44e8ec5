"""The subpackage's queries with SQL give the SQL's rows."""

import glob
import math
from pathlib import Path

import duckdb
import pytest

from textmill.llm import queries

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return float(f"{float(v):.8g}") + 0.0 if isinstance(v, (int, float)) or v.__class__.__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    duck = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        duck.execute(f"create view {Path(p).stem} as select * from '{p}'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    r = duck.sql(queries.ORACLE_SQL[name])
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    assert got == sorted(repr(tuple(plain(x[i]) for i in at)) for x in r.fetchall())
