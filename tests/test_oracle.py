"""Every query beside its SQL over the smallest tables; the others must run and give a stable schema."""

import datetime as dt
import math
import os

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

CORE = {name: q for module in entry._MODULES if ".llm." not in module.__name__ for name, q in module.queries().items()}
SQL = {name: s for module in entry._MODULES if ".llm." not in module.__name__ for name, s in module.oracle_sql().items()}


def plain(x):
    if x is None or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, np.integer)):
        return int(x)
    if isinstance(x, float) or type(x).__name__ == "Decimal":
        return round(float(x), 6) + 0.0
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None).isoformat()
    return str(x)


@pytest.fixture(scope="module")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return con


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, duck, sf_dir, name):
    df = CORE[name](spark, sf_dir)
    columns = sorted(df.columns)
    assert len(set(columns)) == len(columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name in SQL:
        found = duck.execute(SQL[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        assert got == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
