"""The driver's contract: every query runs, and those with SQL give its rows."""

import importlib
import os
import sys

import duckdb
import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")
import __spark_entry__ as contract  # noqa: E402

CORE = [n for n in contract.queries() if not n.startswith(("p1_", "p2_", "p3_", "p4_", "p5_", "p8_", "p9_", "p10_"))]


def rows_of(names, tuples):
    order = sorted(range(len(names)), key=names.__getitem__)
    cell = lambda v: None if v is None else f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(cell(t[k]) or "" for k in order) for t in tuples)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in os.listdir(DATA):
        c.execute(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", CORE)
def test_query(spark, con, name):
    df = contract.queries()[name](spark, DATA)
    got = df.collect()
    if sql := contract.oracle_sql().get(name):
        want = con.execute(sql)
        names = [d[0] for d in want.description]
        assert sorted(names) == sorted(df.columns)
        assert rows_of(df.columns, got) == rows_of(names, want.fetchall())


def test_entry_and_names(spark):
    assert contract.entry(spark).count() >= 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_runs_without_the_subpackage(monkeypatch):
    monkeypatch.setitem(sys.modules, "vacantia.llm", None)
    monkeypatch.delitem(sys.modules, "vacantia.llm.queries", raising=False)
    again = importlib.reload(contract)
    assert "p6_found" in again.queries() and "p1_found" not in again.queries()
    monkeypatch.undo()
    importlib.reload(contract)
