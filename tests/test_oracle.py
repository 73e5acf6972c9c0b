"""Every registered query against its DuckDB oracle on the smallest fixture
(the driver repeats this at sf0.01); rows-only queries must run."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def test_every_query_registered_with_oracle_or_rows_only():
    assert len(QUERIES) >= 60
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 195
    assert df.columns == ["patient_id", "seq", "ts_ms", "previous_tier", "new_tier",
                          "news2_score"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF_SMALL)
    assert r["status"] in ("ok", "rows-only"), r
