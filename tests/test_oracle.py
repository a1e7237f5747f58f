"""Every registered query against its DuckDB oracle on the driver's sf0.001 tables."""

import pytest

from conftest import SF_SMALL
from oracle_check import compare, duck, type_diffs

import __spark_entry__ as E

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, SF_SMALL, QUERIES[key], ORACLE[key])
    assert r["ok"], r.get("detail")


@pytest.mark.parametrize("key", ["region_country_monthly", "overall_kpi", "customer_segments", "regional_grouping_sets"])
def test_types_match_oracle(spark, con, key):
    assert type_diffs(QUERIES[key](spark, SF_SMALL), con, ORACLE[key]) == []


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, key):
    assert QUERIES[key](spark, SF_SMALL).count() >= 1


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
