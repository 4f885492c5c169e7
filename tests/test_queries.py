"""Every query with SQL gives the rows that DuckDB gives."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from tessera.jobs import catalog


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return repr(v)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf_dir, duck, name):
    df = catalog.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert rows == want
