"""Each registered query with SQL against DuckDB, and the contract's columns of all of them."""

import pytest

import __spark_entry__ as entry
from asterism.llm import oracle, queries
from asterism.plans.compare import compare, duckdb_connection
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    res = compare(queries.QUERIES[name](spark, SF_SMALL), con, oracle.ORACLE_SQL[name])
    assert res["values_match"], res


def test_all_are_registered():
    found = entry.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
