"""Every registered query against its DuckDB oracle (sf0.001 here; the driver uses sf0.01)."""

import pytest

import __spark_entry__ as entry
from asterism.plans import bindings, oracle
from asterism.plans.compare import compare, duckdb_connection
from tests.conftest import SF_SMALL, plan

NAMES = sorted(bindings.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(oracle.ORACLE_SQL) == set(bindings.QUERIES)
    assert set(bindings.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


CAPS = ("GlobalLimit", "LocalLimit", "CollectLimit", "TakeOrderedAndProject", "Sample",
        "BroadcastNestedLoopJoin", "CartesianProduct")


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    # every registered query runs over whole tables (no limit or sample in its
    # plan) and has no nested-loop or cartesian join
    text = plan(df)
    assert not [c for c in CAPS if c in text], name
    res = compare(df, con, entry.oracle_sql()[name])
    assert res["values_match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "hi", "lo", "big", "n_rows"] and df.count() >= 0
