"""Every event-log query against its SQL oracle on the smallest tables."""

import os

import duckdb
import pytest

from eventlake.plans import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_oracle(spark, duck, name):
    got = Q.QUERIES[name](spark, SF)
    if name not in Q.ORACLE_SQL:
        assert got.count() > 0
        return
    want = duck.execute(Q.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert normal([tuple(r) for r in got.collect()], got.columns) == normal(want.fetchall(), names)
