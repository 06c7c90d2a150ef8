"""Every registered reference query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from scholia import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([v[i] for i in order] for v in values), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, name):
    frame = QUERIES[name](spark, data)
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    if name not in ORACLES:
        assert got
        return
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in os.listdir(data):
        con.execute(f"CREATE VIEW {t[:-8]} AS SELECT * FROM '{data}/{t}'")
    cur = con.execute(ORACLES[name])
    assert sorted(frame.columns) == sorted(x[0] for x in cur.description)
    assert got == rows([x[0] for x in cur.description], cur.fetchall())
