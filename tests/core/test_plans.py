"""Every query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import sluicework.plans.aggregates
import sluicework.plans.controls
import sluicework.plans.loads
import sluicework.plans.reports
import sluicework.plans.resolution  # noqa: F401
from sluicework.plans.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, con, name):
    want = con.sql(SQL[name]).df()
    columns = sorted(want.columns)
    got = QUERIES[name](spark, sf)
    assert sorted(got.columns) == columns
    key = lambda df: sorted(map(repr, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False, name=None)))
    assert key(got.toPandas()) == key(want)


def test_entry_without_llm(spark, monkeypatch):
    import sys

    import __spark_entry__ as e

    monkeypatch.setitem(sys.modules, "sluicework.llm", None)
    monkeypatch.delitem(sys.modules, "sluicework.llm.queries", raising=False)
    assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) == set(SQL)
    assert e.entry(spark).count() > 0
