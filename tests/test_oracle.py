"""Every registered query against its DuckDB oracle on the driver tables."""

import pytest

import __spark_entry__ as E
from riskspark.plans import QUERIES
from riskspark.testing.compare import compare, duck_connection

from .conftest import SF_ORACLE

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    c = compare(name, E.queries()[name](spark, SF_ORACLE), con, E.oracle_sql()[name])
    assert c.ok, c.detail
    assert c.spark_rows > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
