"""The operators' queries against their SQL."""

import collections

import duckdb
import pytest

from matchloom.llm import queries as Q

TABLES = "documents pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", list(Q.ORACLES))
@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_against_sql(spark, name, sf):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = Q.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    want = duck.sql(Q.ORACLES[name])
    assert sorted(want.columns) == cols
    got = collections.Counter(tuple(r) for r in df.select(*cols).collect())
    sql = collections.Counter(duck.sql(f"SELECT {', '.join(cols)} FROM ({Q.ORACLES[name]})").fetchall())
    assert got and got == sql, (list((got - sql).items())[:2], list((sql - got).items())[:2])
