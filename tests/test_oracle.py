"""Every registered query against its DuckDB oracle (the driver's correctness gate), at sf0.001."""

from __future__ import annotations

import pytest

from strata.plans.registry import oracle_sql, queries
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

QUERIES = queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(SQL))
    assert missing == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name], con)
    assert r["columns_match"], r
    assert r["types_match"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["CustomerName", "total_talktime_minutes"]
    assert df.count() > 0
