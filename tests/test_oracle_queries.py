"""Every deterministic query equals its SQL oracle (DuckDB) on sf0.001."""

import pytest

import __spark_entry__ as entry
from oracle import SF_SMALL, compare, duck

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()
# the manifest oracle spells out the four languages of the driver tables
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert compare(df, con, ORACLE[name]) is None


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["state", "n_rows", "n_first", "state_median", "above_pct"]
    assert df.count() > 0
