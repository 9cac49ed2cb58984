"""Differential test on random tables with the driver's schemas, NULLs in
keys, dates and statuses, and some customers and orders listed twice (the driver's
tables have neither): every registered query must still equal its DuckDB
oracle exactly."""

import tempfile

import pytest

import __spark_entry__ as E
from riskspark.plans import QUERIES
from riskspark.testing.compare import compare, duck_connection
from riskspark.testing.random_tables import write_random_tables


@pytest.fixture(scope="module")
def random_dir():
    d = tempfile.mkdtemp(prefix="rs-rand-", dir="/tmp")
    write_random_tables(d, seed=11, null_rate=0.15, duplicate_customers=0.05, duplicate_orders=0.05)
    return d


def test_all_queries_match_oracle_with_nulls(spark, random_dir):
    con = duck_connection(random_dir, tables=("region", "nation", "customer", "supplier", "part",
                                              "orders", "lineitem", "events"))
    failures = []
    for name in QUERIES:
        q = E.queries()[name]
        c = compare(name, q(spark, random_dir), con, E.oracle_sql()[name])
        if not c.ok:
            failures.append((name, c.spark_rows, c.oracle_rows, c.detail[:200]))
    assert not failures
