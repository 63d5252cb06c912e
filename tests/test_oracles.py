"""Every query with an oracle statement equals DuckDB on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duck

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.sql(ORACLES[name]).df()
    rep = compare(got, want)
    assert rep["columns_match"], rep
    assert rep["rows_spark"] == rep["rows_oracle"], rep
    assert rep["close"], rep


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "HelpfulnessNumeratorRollingAverage" in df.columns
