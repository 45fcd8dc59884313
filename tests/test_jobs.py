"""Every registered job against its SQL on the smallest supplied tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from armature.plans import catalogue

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="supplied tables are not here")
QUERIES, ORACLES = catalogue.QUERIES, catalogue.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in sorted(Path(FOLDER).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(v, 6) + 0.0 if isinstance(v, float) else v
    return sorted([tuple(plain(r[i]) for i in order) for r in data], key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_job_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    data = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert data
        return
    found = duck.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    want = found.fetchall()
    assert sorted(df.columns) == sorted(columns)
    got, want = rows(df.columns, data), rows(columns, want)
    assert len(got) == len(want)
    close = [all(a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) < 2e-6) for a, b in zip(x, y)) for x, y in zip(got, want)]
    assert all(close)


def test_names():
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
