"""Every training-data query beside its SQL over the smallest tables; the others must run and give a stable schema."""

import os

import pytest

from fieldreel.llm import queries as llm
from tests.test_oracle import plain

QUERIES, SQL = llm.queries(), llm.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    assert len(set(columns)) == len(columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name in SQL:
        found = duck.execute(SQL[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        assert got == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
