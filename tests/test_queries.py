"""Every registered query against its SQL, and rules that all plans keep."""

from __future__ import annotations

import os
import sys

import pytest

from conftest import plan_of
import __spark_entry__ as entry_point
from syncflow.plans.oracles import ORACLES
from syncflow.plans.queries import QUERIES

DATA = os.environ.get("SYNCFLOW_TESTDATA", "/root/testdata/sf0.001")
#: Ten times as many rows: ties and values that do not fit meet there only.
MORE = os.environ.get("SYNCFLOW_MORE_TESTDATA", "/root/testdata/sf0.01")
JOBS = [n for n in sorted(QUERIES) if n.startswith("run_outbound_") or n == "run_inbound_manifest"]

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are absent")


def connected(folder):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    connection.execute("set TimeZone = 'UTC'")
    for name in os.listdir(folder):
        view = name.removesuffix(".parquet")
        connection.execute(f"create view {view} as select * from '{folder}/{name}'")
    return connection


@pytest.fixture(scope="module")
def sql():
    return connected(DATA)


@pytest.fixture(scope="module")
def more_sql():
    if not os.path.isdir(MORE):
        pytest.skip("larger test tables are absent")
    return connected(MORE)


def compared(df, sql, name):
    """Rows of the query, after they were found equal to those of its SQL."""
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    result = sql.execute(entry_point.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(r[i] for i in places)) for r in result.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = entry_point.queries()[name](spark, DATA)
    compared(df, sql, name)
    plan = plan_of(df)
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert banned not in plan


@pytest.mark.parametrize("name", JOBS)
def test_job_on_more_rows(spark, more_sql, name):
    compared(entry_point.queries()[name](spark, MORE), more_sql, name)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_the_corpus_part_may_be_absent(monkeypatch):
    for name in ("syncflow.llm", "corpus_pipeline"):
        with monkeypatch.context() as patched:
            patched.setitem(sys.modules, name, None)
            assert set(entry_point.queries()) == set(QUERIES)
            assert set(entry_point.oracle_sql()) == set(ORACLES)
