"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from geoquill.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: round(float(v), 4) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
    return sorted(tuple(str(norm(r[i])) for i in order) for r in data)


FAST = list(catalog.oracle_sql())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    want = duck.execute(catalog.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(cols)
    g, w = rows(got.columns, [tuple(r) for r in got.collect()]), rows(cols, want.fetchall())
    assert [tuple(x.removesuffix(".0") for x in r) for r in g] == [tuple(x.removesuffix(".0") for x in r) for r in w] or g == w


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
