"""Queries of the training-data part that SQL can express, against DuckDB on the small tables."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck
from tidemark.llm import catalog, oracles


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(oracles.ORACLES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, catalog.QUERIES[key], oracles.ORACLES[key], SF_SMALL)
    assert r["names_ok"] and r["types_ok"] and r["values_ok"], r
