"""Every catalogue query against its DuckDB oracle (values, names and types)."""

import pytest

import __spark_entry__ as entry
from tidemark.plans.catalog import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

#: The reporting part; the training-data queries have their tests in tests/llm.
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    fn = entry.queries()[key]
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert fn(spark, SF_SMALL).count() >= 0
        return
    r = compare(spark, con, key, fn, sql, SF_SMALL)
    assert r["names_ok"] and r["types_ok"] and r["values_ok"], r


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 46
    assert df.columns == ["client_id", "provider", "dpd_faixa", "quantidade", "acionado", "sem_ac",
                          "penetration_rate", "total_calls", "paid", "ptp", "cc"]


def test_every_reporting_key_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - set(entry.oracle_sql()) == set()
    assert set(entry.oracle_sql()) <= set(entry.queries())
