"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def flat(v):
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return tuple(map(flat, v))
    return v


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in ORACLES))
def test_against_sql(spark, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(flat(r[c]) for c in cols) for r in df.collect()), key=repr)
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert got == sorted((tuple(flat(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
