"""Every plan against the oracle on perturbed logical tables (overlapping
segments, repeated enrolments, calendar holes, users listed twice with
different attributes, duplicate list and rate rows), read directly."""

import tempfile

import duckdb

import __spark_entry__ as E
from riskspark.plans import QUERIES
from riskspark.sources import Tables
from riskspark.sources.driver_adapter import driver_tables
from riskspark.testing.compare import compare
from riskspark.testing.oracle_queries import oracle_queries
from riskspark.testing.perturb import perturbed_tables

from .conftest import SF_ORACLE


def test_plans_match_oracle_on_perturbed_logical_tables(spark):
    root = tempfile.mkdtemp(prefix="rs-logical-", dir="/tmp")
    paths = {}
    for name, df in perturbed_tables(driver_tables(spark, SF_ORACLE, fresh=True)).items():
        paths[name] = f"{root}/{name}.parquet"
        df.write.mode("overwrite").parquet(paths[name])
    t = Tables.from_parquet(spark, paths)
    con = duckdb.connect()
    for name, path in paths.items():
        con.execute(f"create view {name} as select * from read_parquet('{path}/*.parquet')")
    sql = oracle_queries(E.PARAMS, recipes=False)
    failures = []
    for name, plan in QUERIES.items():
        c = compare(name, plan(t, E.PARAMS), con, sql[name])
        if not c.ok:
            failures.append((name, c.spark_rows, c.oracle_rows, c.detail[:300]))
    assert not failures, failures
