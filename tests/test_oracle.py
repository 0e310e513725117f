"""Every registered query against its DuckDB twin on the driver's tables (sf0.001)."""

import pytest
from conftest import SF0001
from oracle_harness import compare, duck

import __spark_entry__ as E
from listenkpi import queries as Q
from listenkpi.plans import oracle as O

QUERIES = Q.REGISTRY
SQL = O.oracle_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF0001, name, QUERIES[name], SQL[name], con, verbose=False)
    assert res["status"] == "match", res


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["date", "track_genre"]
