"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

from usageledger.oracle import ORACLE  # noqa: E402
from usageledger.queries import QUERIES  # noqa: E402


#: All pairs, and rows handed to Python.
AVOIDED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow")


@pytest.fixture(scope="module")
def con():
    from conftest import SMALL

    return compare.duck(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, folder, name):
    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [p for p in AVOIDED if p in plan]
    assert compare.difference(spark, con, folder, name, df) is None


def test_entry_contract(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.columns == ["warehouse_name", "database_name", "schema_name", "usage_date", "credit_used"]
    assert df.count() > 0
    assert set(contract.queries()) >= set(contract.oracle_sql())


def test_access_map_file(spark, tmp_path):
    from usageledger.sources.tables import access_map_csv, empty_like

    path = tmp_path / "map.csv"
    path.write_text("ACCOUNT,ROLE,WAREHOUSE,DATABASE\nmcx,,.+,.+\n,R1,.+,\n")
    got = access_map_csv(spark, str(path))
    assert [tuple(r) for r in got.collect()] == [("mcx", None, ".+", ".+"), (None, "R1", ".+", None)]
    assert empty_like(got).columns == got.columns and empty_like(got).count() == 0
