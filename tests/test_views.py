"""Analyses are reachable from Spark SQL."""

import __spark_entry__ as E
from riskspark.sources.driver_adapter import driver_tables
from riskspark.views import register_views

from .conftest import SF_SMALL


def test_register_views(spark):
    t = driver_tables(spark, SF_SMALL)
    names = register_views(t, E.PARAMS, ["segment_distribution", "loss_bps_month"])
    assert "dim_user" in names and "segment_distribution" in names
    n = spark.sql("select sum(all_users) as n from segment_distribution").first().n
    assert n == E.queries()["risk_segmentation"](spark, SF_SMALL).count()
    assert spark.sql("select count(*) from dispute where reason_code = 'FRAUD'").first()[0] > 0
