"""The production path: logical tables as metastore tables, resolved by name."""

import __spark_entry__ as E
from riskspark.plans import QUERIES
from riskspark.sources import LOGICAL_TABLES, Tables
from riskspark.sources.driver_adapter import driver_tables

from .conftest import SF_SMALL


def test_from_names_matches_driver_catalog(spark):
    src = driver_tables(spark, SF_SMALL, fresh=True)
    spark.sql("CREATE DATABASE IF NOT EXISTS rs_dw")
    for n in LOGICAL_TABLES:
        src[n].write.mode("overwrite").saveAsTable(f"rs_dw.{n}")
    t = Tables.from_names(spark, {n: f"rs_dw.{n}" for n in LOGICAL_TABLES})
    for name in ("payment_dormancy", "segment_moved", "loss_bps_month", "paid_adoption_week",
                 "payment_risk_mart"):
        got = sorted(map(repr, QUERIES[name](t, E.PARAMS).collect()))
        want = sorted(map(repr, QUERIES[name](src, E.PARAMS).collect()))
        assert got == want, name
    spark.sql("DROP DATABASE rs_dw CASCADE")
